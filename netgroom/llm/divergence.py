"""Source divergence audit: sets of terms by count as bitmaps, crossed by AND and popcount."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netgroom.llm.common import stored, table
from netgroom.llm.ranking import numbered
from netgroom.llm.text import LOWER, buffers, chunks, text_of, word_spans

#: Documents that a kept term stands in at least, and the scale of shares.
DOCS, SCALE = 10, 1_000_000_000
#: Terms of a bitmap, sources of a tile, counts that a task gathers before it passes them on, and bytes counted at a time.
BITS, TILE, GATHER, CHUNK = 4096, 8, 1_000_000, 2 << 20
#: Bits of a task's number of a term, below that of its group.
_TERM_BITS = 40

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


class _Tally:
    """Counts of one task: arrays of (group and term) numbers, occurrences and documents."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.terms: dict[bytes, int] = {}
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.rows = self.merged = 0

    def add(self, batch: pa.RecordBatch) -> None:
        """Count the texts of a batch (lang, source, text)."""
        langs, sources = (batch.column(c).to_pylist() for c in (0, 1))
        group = np.array([self.groups.setdefault(key, len(self.groups)) for key in zip(langs, sources)], np.int64)
        raw, at = buffers(batch.column(2))
        starts, ends = word_spans(raw, at, _LETTER)
        offsets = np.concatenate(([0], np.cumsum(ends - starts)))
        letters = LOWER[raw[_LETTER[raw]]]
        found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
        number = np.array([self.terms.setdefault(t, len(self.terms)) for t in found.dictionary.to_pylist()], np.int64)
        size = max(len(number), 1)
        # each term once for each document, then once for each group
        own, n = np.unique(text_of(starts, at) * size + found.indices.to_numpy(), return_counts=True)
        self._hold((group[own // size] << _TERM_BITS) + number[own % size], n, np.ones(len(own), np.int64))

    def _hold(self, key, n, docs) -> None:
        both, place = np.unique(key, return_inverse=True)
        sums = [np.bincount(place, w, len(both)).astype(np.int64) for w in (n, docs)]
        self.held.append((both, *sums))
        self.rows += len(both)

    def merge(self) -> int:
        """Bring all counts together; their number."""
        parts, self.held, self.rows = [np.concatenate(c) for c in zip(*self.held)], [], 0
        self._hold(*parts)
        self.merged = self.rows
        return self.rows

    def emit(self) -> Iterator[pa.RecordBatch]:
        """All counts as rows (lang, term, source, n, docs), and forget them."""
        if not self.held:
            return
        self.merge()
        key, n, docs = self.held[0]
        langs, sources = (pa.array([g[k] for g in self.groups], pa.string()) for k in (0, 1))
        terms = pa.array(self.terms, pa.binary()).cast(pa.string())
        for at in range(0, len(key), 50_000):
            part = slice(at, at + 50_000)
            group, term = pa.array(key[part] >> _TERM_BITS), pa.array(key[part] & ((1 << _TERM_BITS) - 1))
            columns = [langs.take(group), terms.take(term), sources.take(group), pa.array(n[part]), pa.array(docs[part])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "term", "source", "n", "docs"])
        self.__init__()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, term, source, n, docs): occurrences, and documents that hold the term, of ``docs`` (lang, source, text).

    Terms are runs of ASCII letters, taken in lower case, and of characters beyond ASCII.  Counts
    are summed up in tasks over many documents, so a term has few rows for each task.
    """

    def run(batches):
        tally = _Tally()
        for batch in batches:
            for part in chunks(batch, "text", CHUNK):
                tally.add(part)
                if tally.rows >= tally.merged + GATHER and tally.merge() >= GATHER:
                    yield from tally.emit()
        yield from tally.emit()

    return docs.select("lang", "source", "text").mapInArrow(run, "lang string, term string, source string, n long, docs long")


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), exact for counts of any size."""
    wide = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    return F.expr("1").cast("long") + F.call_function("div", wide, (total + 2 * kept).cast("decimal(20,0)"))


def _bitmaps(cells: DataFrame) -> DataFrame:
    """(lang, block, s, p, bits): the terms of a block with equal share p in source s, as a bitmap."""
    level = cells.groupBy("lang", "block", "s", "p").agg(F.collect_list("place").alias("places"))
    names = ["lang", "block", "s", "p", "bits"]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                lists = part.column(4)
                sizes = np.asarray(lists.value_lengths())
                marks = np.zeros((len(lists), BITS), np.uint8)
                marks[np.repeat(np.arange(len(lists)), sizes), lists.flatten().to_numpy(zero_copy_only=False)] = 1
                packed = np.packbits(marks, axis=1, bitorder="little").tobytes()
                width = BITS // 8
                bits = pa.array([packed[k * width : (k + 1) * width] for k in range(len(lists))], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(4)), bits], names)

    return level.select("lang", "block", "s", "p", "places").mapInArrow(run, "lang string, block long, s long, p long, bits binary")


class Levels:
    """The bitmaps of one source in one block: a row for each share, its terms as bits."""

    def __init__(self, p: list[int], bits: list[bytes], zero: int):
        self.p = np.array(p, np.int64)
        self.zero = np.int64(zero)
        self.bits = np.frombuffer(b"".join(bits), np.uint64).reshape(len(bits), BITS // 64)
        self.columns = np.ascontiguousarray(self.bits.T)
        self.sizes = np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64)
        # words with any bit: all others are empty in every AND
        self.level, self.word = np.nonzero(self.bits)
        self.value = self.bits[self.level, self.word]


def divergence(p, q):
    return (p - q) * (p - q) // (p + q)


def cross(a: Levels, b: Levels, terms: int) -> int:
    """Sum of the divergence over all ``terms`` of a block.

    The terms with share p in one and q in the other are the popcount of the AND of two
    bitmaps; those that one or both lack are what is left of a bitmap, or of the block.
    """
    total, nb = 0, len(b.p)
    in_a, in_b = a.sizes.copy(), b.sizes.copy()
    step = max(1, (1 << 20) // max(nb, 1))
    for at in range(0, len(a.word) if nb else 0, step):
        word, level, value = a.word[at : at + step], a.level[at : at + step], a.value[at : at + step]
        both = b.columns[word] & value[:, None]
        row, other = np.nonzero(both)
        n = np.bitwise_count(both[row, other]).astype(np.int64)
        total += int((n * divergence(a.p[level[row]], b.p[other])).sum())
        np.subtract.at(in_a, level[row], n)
        np.subtract.at(in_b, other, n)
    total += int((in_a * divergence(a.p, b.zero)).sum()) + int((in_b * divergence(a.zero, b.p)).sum())
    neither = terms - int(a.sizes.sum()) - int(in_b.sum())
    return total + neither * int(divergence(a.zero, b.zero))


def _pairs(levels: DataFrame) -> DataFrame:
    """(lang, a, b, value): parts of the sums of all pairs of sources a < b of a language, a block of terms each.

    ``levels`` are bitmaps (lang, block, terms, tiles, s, p0, p, bits), with a row without bits for each source and block.
    Sources are dealt into tiles; a task crosses two tiles in one block.
    """
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    own = F.floor(F.col("s") / TILE).cast("long")
    dealt = levels.withColumn("own", own).withColumn("other", other)
    dealt = dealt.select("lang", "block", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "terms", "s", "p0", "p", "bits")
    schema = "lang string, a long, b long, value long"

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        lang, _, i, j = (k.as_py() for k in key)
        zero: dict[int, int] = {}
        found: dict[int, tuple[list, list]] = defaultdict(lambda: ([], []))
        terms = 0
        for terms, s, p0, p, bits in zip(*(rows.column(c).to_pylist() for c in ("terms", "s", "p0", "p", "bits"))):
            zero[s] = p0
            if bits is not None:
                found[s][0].append(p)
                found[s][1].append(bits)
        held = {s: Levels(*found[s], zero[s]) for s in sorted(zero)}
        out = [(lang, a, b, cross(held[a], held[b], terms)) for a in held if a // TILE == i for b in held if b // TILE == j and a < b]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
        columns = list(zip(*out)) if out else [[]] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], ["lang", "a", "b", "value"])

    return dealt.groupBy("lang", "block", "i", "j").applyInArrow(run, schema)


def audit_sources(df: DataFrame, min_docs: int = DOCS, top: int = 10, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source of a language lies from the others, and which terms set it apart.

    A term's share p in a group is 1 + floor(10^9 * (count + 2) / (all + 2 * terms)) over the
    terms of at least ``min_docs`` documents of the language; two shares diverge by
    floor((p - q)^2 / (p + q)).  ``pair`` rows have the sum over all kept terms for every other
    source of the language (0 without kept terms), ``term`` rows the ``top`` terms that are more
    frequent in the source than in the language.  Ties go to the smaller item by bytes.  Null
    texts, languages and sources count as empty; repeated rows are documents each; a source
    without terms is compared too; an empty table has no rows.

    The table is read once for the counts and once for its two short columns.  Counts are
    added up by term; then each source has a bitmap of terms for each of its shares, in blocks of
    ``BITS`` terms by falling frequency, so that a block holds few shares.
    """
    blank = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    docs = df.select(blank(lang_col).alias("lang"), blank(source_col).alias("source"), blank(text_col).alias("text"))
    groups = docs.select("lang", "source").distinct()

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # sums by source and over the sources of a term: rows of a term then lie together
    counts = term_counts(docs).repartition(parts, "lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    counts = counts.withColumns({"lang_n": F.sum("n").over(term), "lang_docs": F.sum("docs").over(term)})
    kept = stored(counts.where(F.col("lang_docs") >= min_docs).drop("docs", "lang_docs"))

    terms = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n"))
    terms = numbered(terms, ["lang"], [F.col("lang_n").desc(), F.col("term").asc()])
    terms = stored(terms.select("lang", "term", F.col("idx").alias("id"), F.col("group_rows").alias("kept")))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total")).join(terms.groupBy("lang").agg(F.max("kept").alias("kept")), "lang")

    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sources = numbered(groups, ["lang"], [F.col("source").asc()])
    sources = sources.withColumnRenamed("idx", "s").withColumn("tiles", F.floor((F.col("group_rows") - 1) / TILE).cast("long") + 1)
    sources = sources.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "kept", "lang_total"])
    nothing = F.lit(0).cast("long")
    p0 = F.when(F.col("kept") > 0, share(nothing, F.col("total"), F.col("kept"))).otherwise(F.lit(1).cast("long"))
    sources = stored(sources.select("lang", "source", "s", "tiles", "total", "kept", "lang_total", p0.alias("p0")))

    known = sources.select("lang", "source", "s", "total", "lang_total")
    cells = kept.join(terms, ["lang", "term"]).join(known, ["lang", "source"])
    cells = cells.withColumn("p", share(F.col("n"), F.col("total"), F.col("kept")))
    cells = stored(cells.withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))).select("lang", "source", "term", "id", "s", "p", "q"))

    placed = cells.select("lang", F.floor(F.col("id") / BITS).cast("long").alias("block"), "s", "p", (F.col("id") % BITS).cast("int").alias("place"))
    bitmaps = stored(_bitmaps(placed))
    blocks = F.explode(F.sequence(nothing, F.greatest(F.floor((F.col("kept") - 1) / BITS).cast("long"), nothing)))
    every = sources.select("lang", blocks.alias("block"), "s", "p0", "tiles", "kept")
    size = F.least(F.col("kept") - F.col("block") * BITS, F.lit(BITS).cast("long"))
    empty = every.select("lang", "block", "s", "p0", "tiles", size.alias("terms"), F.lit(None).cast("long").alias("p"), F.lit(None).cast("binary").alias("bits"))
    full = bitmaps.join(sources.select("lang", "s", "p0", "tiles", "kept"), ["lang", "s"])
    full = full.select("lang", "block", "s", "p0", "tiles", size.alias("terms"), "p", "bits")
    half = _pairs(empty.unionByName(full)).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    half = stored(half)
    both = half.unionByName(half.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    name = sources.select("lang", "s", "source")
    pair = both.join(name.withColumnRenamed("s", "a"), ["lang", "a"]).join(
        name.select("lang", F.col("s").alias("b"), F.col("source").alias("item")), ["lang", "b"]
    )
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    pair = pair.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    above = cells.where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    term_rows = above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pair.unionByName(term_rows.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


def op13_divergence(spark, sf_dir):
    return audit_sources(table(spark, sf_dir, "documents"))


OP13_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM d
), kept AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 10
), vocabulary AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), there AS (
  SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
), sources AS (
  SELECT DISTINCT lang, source FROM d
), totals AS (
  SELECT lang, source, coalesce(sum(n), 0) AS total FROM sources LEFT JOIN there USING (lang, source) GROUP BY ALL
), shares AS (
  SELECT lang, source, term, coalesce(t.n, 0) AS n,
    1 + CAST(1000000000 AS HUGEINT) * (coalesce(t.n, 0) + 2) // (CAST(s.total AS HUGEINT) + 2 * v.v) AS p,
    1 + CAST(1000000000 AS HUGEINT) * (k.n + 2) // (CAST(v.total AS HUGEINT) + 2 * v.v) AS q
  FROM totals s JOIN kept k USING (lang) JOIN vocabulary v USING (lang) LEFT JOIN there t USING (lang, source, term)
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value
  FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
