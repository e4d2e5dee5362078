"""Secret scans: fixed patterns and a battery of randomness tests, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netgroom.llm.common import table

# Patterns and least lengths of the base kinds; a shorter match takes its place but does not count.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

#: Runs that the battery tests: 20 or more characters of an encoding's alphabet.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "random")
#: Rate of false rejections of true randomness among the candidates of a text.
LEVEL = 0.05

NO_SPANS = "cast(array() as array<struct<start:int,kind:int,end:int>>)"


def _spans(text: Column, pattern: str, kind: int, least_group: tuple[int, int] | None = None) -> Column:
    """Array of (start, kind, end) of the leftmost non-overlapping matches, in code points.

    The gaps between matches come from split, the matches from extraction; a
    running sum of both lengths gives the positions.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    group = F.regexp_extract_all(text, F.lit(pattern), F.lit(least_group[0] if least_group else 0))
    least = least_group[1] if least_group else 0
    gaps = F.split(text, pattern, -1)
    parts = F.arrays_zip(whole.alias("m"), gaps.alias("g"), group.alias("v"))
    empty = F.expr(NO_SPANS)
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc, x):
        begin = acc["at"] + F.length(x["g"])
        end = begin + F.length(x["m"])
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        out = F.when(F.length(x["v"]) >= least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.when(x["m"].isNotNull(), F.struct(end.alias("at"), out.alias("out"))).otherwise(acc)

    # texts without a match skip the loop
    return F.when(F.size(whole) > 0, F.aggregate(parts, start, step, lambda a: a["out"])).otherwise(empty)


def _two_sided(z: Column) -> Column:
    """P(|Z| > |z|) of a normal variable, by the logistic form accurate to 2e-4."""
    a = F.abs(z)
    return 2.0 / (1.0 + F.exp(1.5976 * a + 0.07056 * a * a * a))


def _p_value(word: Column) -> Column:
    """How well a run passes for random characters of its inferred encoding.

    The encoding is the narrowest alphabet that holds the run: lower or upper hex,
    base32, letters and digits, base64.  The tests: symbol counts against uniform
    (chi-squared, Wilson-Hilferty), the share and the runs of letters against other
    symbols, and serial correlation of neighbouring code values.  The p-value is
    four times the least, at most 1.
    """
    chars = F.filter(F.split(word, ""), lambda c: c != "")
    return _let(F.transform(chars, lambda c: F.ascii(c).cast("double")), lambda codes: _battery(word, codes))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _battery(word: Column, codes: Column) -> Column:
    n = F.size(codes).cast("double")
    sizes = F.when(word.rlike("^([0-9a-f]+|[0-9A-F]+)$"), 16.0).when(word.rlike("^([A-Z2-7]+=*|[a-z2-7]+=*)$"), 32.0)
    counts = F.transform(F.array_distinct(codes), lambda c: F.size(F.filter(codes, lambda d: d == c)).cast("double"))
    squares = F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * c)
    mean = F.aggregate(codes, F.lit(0.0), lambda a, c: a + c) / n
    runs = F.size(F.regexp_extract_all(word, F.lit("[A-Za-z]+|[^A-Za-z]+"), F.lit(0))).cast("double")
    others = F.length(F.regexp_replace(word, "[A-Za-z]", "")).cast("double")
    alphabet = sizes.when(word.rlike("^[A-Za-z0-9]+$"), 62.0).otherwise(64.0)
    pairs = lambda d: F.arrays_zip(
        F.slice(d, F.lit(1), F.size(d) - 1).alias("x"), F.slice(d, F.lit(2), F.size(d) - 1).alias("y")
    )
    correlation = lambda d: F.aggregate(pairs(d), F.lit(0.0), lambda a, p: a + p["x"] * p["y"]) / F.aggregate(
        d, F.lit(0.0), lambda a, x: a + x * x
    )
    lag = _let(mean, lambda m: _let(F.transform(codes, lambda c: c - m), correlation))
    return _let(F.struct(n.alias("n"), alphabet.alias("k"), squares.alias("sq"), runs.alias("runs"), others.alias("others"), lag.alias("lag")), _least_p)


def _least_p(v: Column) -> Column:
    n, k, df = v["n"], v["k"], v["k"] - 1.0
    x2 = F.greatest(v["sq"] * k / n - n, F.lit(0.0))
    z_chi = (F.pow(x2 / df, 1.0 / 3.0) - (1.0 - 2.0 / (9.0 * df))) / F.sqrt(2.0 / (9.0 * df))
    # the share of symbols that are no letters, and the changes between both classes
    share = F.when(k == 16, 10.0 / 16).when(k == 32, 6.0 / 32).when(k == 62, 10.0 / 62).otherwise(12.0 / 64)
    q = 2.0 * share * (1.0 - share)
    z_runs = (v["runs"] - 1.0 - (n - 1.0) * q) / F.sqrt((n - 1.0) * q * (1.0 - q) + 1.0)
    z_share = (v["others"] - n * share) / F.sqrt(n * share * (1.0 - share))
    z_lag = F.coalesce((v["lag"] + 1.0 / n) * F.sqrt(n), F.lit(99.0))
    # counts that are too even are no sign of prose: this test is one-sided
    p_chi = F.when(z_chi <= 0, 1.0).otherwise(_two_sided(z_chi) / 2.0)
    return F.least(F.lit(1.0), 4.0 * F.least(p_chi, _two_sided(z_runs), _two_sided(z_lag), _two_sided(z_share)))


def _random_spans(text: Column) -> Column:
    """Candidates that hold letters and digits and that the step-up procedure does not call non-random.

    Benjamini-Hochberg over the text's candidates, each p-value divided by its length's
    weight (length over mean length): long runs, whose tests have more power, are
    rejected more readily, and the false discovery rate stays at LEVEL.
    """
    cands = F.filter(
        F.transform(
            _spans(text, CANDIDATE, 3),
            lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.substring(text, s["start"] + 1, s["end"] - s["start"]).alias("word")),
        ),
        lambda s: s["word"].rlike("[0-9]") & s["word"].rlike("[A-Za-z]"),
    )
    total = F.aggregate(cands, F.lit(0.0), lambda a, s: a + (s["end"] - s["start"]))
    m = F.size(cands).cast("double")
    weighed = F.transform(
        cands,
        lambda s: F.struct((_p_value(s["word"]) * total / (m * (s["end"] - s["start"]))).alias("p"), s["start"].alias("start"), s["end"].alias("end")),
    )
    return F.array_sort(weighed)


def _detected(rows: DataFrame) -> DataFrame:
    """Rows (row, text) with arrays of spans: a, k, h of the base kinds, ``base`` all three, ``r`` random."""
    text = F.col("text")
    base = rows.select("row", "text", _spans(text, ASSIGN, 0, (2, 6)).alias("a"), _spans(text, ACCESS, 1).alias("k"), _spans(text, HEX, 2).alias("h"))
    base = base.withColumn("base", F.array_sort(F.concat("a", "k", "h")))
    tested = base.withColumn("tested", F.when(text.rlike(CANDIDATE), _random_spans(text)))
    m = F.size("tested").cast("double")
    # the last rank whose p-value is under its line; that rank and all before are called non-random
    ranks = F.transform(F.col("tested"), lambda s, i: F.when(s["p"] <= LEVEL * (i + 1) / m, i + 1).otherwise(0))
    tested = tested.withColumn("cut", F.coalesce(F.array_max(ranks), F.lit(0)))
    kept = F.filter(
        F.filter(F.col("tested"), lambda s, i: i >= F.col("cut")),
        lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    added = F.transform(kept, lambda s: F.struct(s["start"].alias("start"), F.lit(3).alias("kind"), s["end"].alias("end")))
    return tested.withColumn("r", F.coalesce(added, F.expr(NO_SPANS))).drop("tested", "cut")


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, n_random, base_sha256, spans) of every whole text.

    Base kinds as their patterns say; the battery adds spans of kind ``random``
    that overlap no base span.  Positions are code points, ends exclusive.  A null
    or empty text has no spans; repeated rows are answered each; texts of any
    length are scanned whole.
    """
    rows = df.select(F.col(id_col).alias("row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    names = F.array(*map(F.lit, KINDS))
    listed = lambda c: F.array_join(
        F.transform(c, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    return _detected(rows).select(
        F.col("row").alias(id_col),
        *(F.size(c).cast("long").alias(f"n_{name}") for c, name in zip("akhr", KINDS)),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat("base", "r"))).alias("spans"),
    )


def redact_secrets(df: DataFrame, text_col: str = "text", mark: str = "<secret>") -> DataFrame:
    """``df`` with every span of a secret replaced by ``mark``; overlapping spans share one mark."""
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = _detected(rows).withColumn("spans", F.array_sort(F.concat("base", "r")))
    text = F.col("text")

    def step(acc, s):
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        fresh = F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, F.lit(mark)).alias("out"))
        same = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        return F.when((s["start"] >= acc["at"]), fresh).otherwise(same)

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("spans", begin, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    new = F.when(F.size("spans") > 0, clean).otherwise(F.col(f"row.{text_col}"))
    return found.select(*(new.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in df.columns))


def op8_secrets(spark, sf_dir):
    return scan_secrets(table(spark, sf_dir, "documents"))
