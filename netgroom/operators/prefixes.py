"""Addresses and prefixes as integers: the longest prefix of an address, and the fewest prefixes of many."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netgroom.operators.skew import salted_lookup

#: Shorter prefixes are cut into blocks of this length, so a block has at most 65,536 addresses.
BLOCK = 16

_QUAD = r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:[.](?!\z)|\z)){4}\z"


def address_number(text: Column) -> Column:
    """An IPv4 address as a long; NULL for any other text."""
    parts = F.split(text, "[.]")
    return F.when(text.rlike(_QUAD), sum((F.get(parts, F.lit(k)).try_cast("long") * (1 << (24 - 8 * k)) for k in range(4)), F.lit(0)))


def address_text(number: Column) -> Column:
    octet = lambda k: F.shiftright(number, 24 - 8 * k).bitwiseAND(F.lit(255)).cast("string")
    return F.concat_ws(".", *(octet(k) for k in range(4)))


def prefix_table(prefixes: DataFrame, prefix: str) -> DataFrame:
    """``prefixes`` with ``length`` and ``net`` (the network as a long, host bits cut off); what is no prefix is left out."""
    text = F.col(prefix)
    good = prefixes.where(text.rlike(r"^[0-9.]+/(?:3[0-2]|[12]?[0-9])\z"))
    length = F.substring_index(text, "/", -1).try_cast("int")
    number = address_number(F.substring_index(text, "/", 1))
    host = F.expr("shiftleft(1L, 32 - length)")
    return good.withColumns({"length": length, "_number": number}).where("_number IS NOT NULL").withColumn("net", F.col("_number") - F.col("_number") % host).drop("_number")


def longest_prefix(rows: DataFrame, prefixes: DataFrame, ip: str = "ip", prefix: str = "prefix") -> DataFrame:
    """``rows`` with the columns of the longest prefix that holds their address, all NULL where there is none.

    Prefixes and addresses meet by equal keys, the length and the leading bits, once for each
    length in the list.  Prefixes shorter than ``BLOCK`` are cut into blocks of that length, of which each
    keeps its longest, so no key has more than 65,536 addresses.  Every address is looked up once,
    however many rows have it.  Texts that are no address have no prefix; of equal prefixes the one whose
    columns sort first counts.
    """
    columns = prefixes.columns
    table = prefix_table(prefixes, prefix)
    one = F.struct(*columns)
    table = table.groupBy("length", "net").agg(F.min(one).alias("p"))
    lengths = sorted(r.length for r in table.select("length").distinct().collect())
    width = F.expr("shiftleft(1L, 32 - length)")
    cut = F.explode(F.sequence(F.shiftright("net", 32 - BLOCK), F.shiftright(F.col("net") + width - 1, 32 - BLOCK)))
    short = table.where(F.col("length") < BLOCK).withColumn("bits", cut).groupBy("bits")
    short = short.agg(F.max_by(F.struct("length", "p"), "length").alias("s")).select(F.lit(BLOCK).alias("at"), "bits", "s.length", "s.p")
    long = table.where(F.col("length") >= BLOCK).select(F.col("length").alias("at"), F.expr("shiftright(net, 32 - length)").alias("bits"), "length", "p")
    keys = long.unionByName(short)
    places = sorted({max(n, BLOCK) for n in lengths})

    counted = rows.where(F.col(ip).isNotNull()).groupBy(ip).agg(F.count(F.lit(1)).alias("n"))
    known = counted.select(F.col(ip).alias("_ip"), address_number(F.col(ip)).alias("_number")).where("_number IS NOT NULL")
    if places:
        tried = F.explode(F.array(*(F.struct(F.lit(n).alias("at"), F.shiftright("_number", 32 - n).alias("bits")) for n in places))).alias("t")
        met = known.select("_ip", tried).select("_ip", "t.*").join(keys, ["at", "bits"])
        best = met.groupBy("_ip").agg(F.max_by("p", "length").alias("_p"))
    else:
        best = known.select("_ip", F.lit(None).cast(table.schema["p"].dataType).alias("_p"))
    answers = counted.join(best, F.col(ip) == F.col("_ip"), "left").select(ip, "n", "_p")
    found = salted_lookup(rows, answers, ip).unionByName(rows.where(F.col(ip).isNull()), allowMissingColumns=True)
    return found.select(*rows.columns, *(F.col(f"_p.`{c}`").alias(c) for c in columns))


def cidr_cover(rows: DataFrame, ip: str = "ip") -> DataFrame:
    """(prefix, length, addresses): the fewest prefixes that hold just the addresses of the rows.

    Neighbouring addresses make intervals, first within blocks of 65,536, so no task sees more of
    them; intervals that reach the border of their block are then joined over borders (there are at most two for
    each of 65,536 blocks).  An interval is cut into the aligned blocks of the binary tree over
    all addresses.  Texts that are no address do not count; an empty table has no prefix.
    """
    numbers = rows.select(address_number(F.col(ip)).alias("a")).where("a IS NOT NULL").distinct()
    block = F.shiftright("a", 16)
    place = F.row_number().over(Window.partitionBy("block").orderBy("a"))
    spans = numbers.withColumn("block", block).withColumn("island", F.col("a") - place).groupBy("block", "island").agg(F.min("a").alias("lo"), F.max("a").alias("hi"))
    at_border = (F.col("lo") % 65536 == 0) | (F.col("hi") % 65536 == 65535)
    border = spans.where(at_border)
    # a step begins where the interval before does not end just in front
    order = Window.partitionBy(F.lit(0)).orderBy("lo")
    new = F.coalesce(F.col("lo") != F.lag("hi").over(order) + 1, F.lit(True)).cast("long")
    runs = border.withColumn("new", new).withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = runs.groupBy("run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select("lo", "hi")
    whole = spans.where(~at_border).select("lo", "hi").unionByName(joined)

    level = whole.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(32))).alias("k"))
    level = level.withColumns({"left": F.expr("shiftright(lo + shiftleft(1L, k) - 1, k)"), "right": F.expr("shiftright(hi + 1, k)")}).where("left < right")
    ends = F.array(F.when(F.col("left") % 2 == 1, F.col("left")), F.when(F.col("right") % 2 == 1, F.col("right") - 1))
    cut = level.select("k", F.explode(F.array_compact(ends)).alias("at"))
    net = F.expr("shiftleft(at, k)")
    length = (F.lit(32) - F.col("k")).cast("int")
    return cut.select(F.concat(address_text(net), F.lit("/"), length.cast("string")).alias("prefix"), length.alias("length"), F.expr("shiftleft(1L, k)").alias("addresses"))
