"""Text helpers against Python itself."""

import re
import sys

from pyspark.sql import functions as F

from netgroom.functions import text
from netgroom.functions.owner import EMAIL
from netgroom.operators.textscan import QUAD, text_ipv4

SPACES = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]


def _one_column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def test_strip_equals_python(spark):
    values = [s + "a" + s + "b" + s for s in SPACES] + [s for s in SPACES] + ["", " x\x1c", "​x​", "é 　"]
    rows = _one_column(spark, values).select("t", text.strip_column("t").alias("s")).collect()
    assert [(r.t, r.s) for r in rows] == [(v, v.strip()) for v in values]


def test_squeeze_equals_python(spark):
    values = [f"a{s}{s},b_{s}c-d" for s in SPACES] + ["__a", "a, b", "é　_x"]
    rows = _one_column(spark, values).select(text.squeeze_column("t", ",_", "-").alias("s")).collect()
    assert [r.s for r in rows] == [re.sub(r"[\s,_]+", "-", v) for v in values]


def test_digits_of_all_scripts(spark):
    digits = [chr(c) for c in range(0x80, sys.maxunicode + 1) if chr(c).isdigit()]
    rows = _one_column(spark, digits).select(text.stripped_plain_digits("t").alias("s")).collect()
    for char, row in zip(digits, rows):
        assert row.s == (str(int(char)) if char.isdecimal() else "²")


def test_java_regex_word_edges(spark):
    values = ["sw", "sw1", "a sw b", "é sw", "ésw", "sw²", "sw-1", "x_sw", "PA٣", "pa٣", "pa"]
    for pattern in (r"\bsw\b", r"pa\d+"):
        rows = _one_column(spark, values).select(F.col("t").rlike(text.java_regex(pattern)).alias("m")).collect()
        assert [r.m for r in rows] == [bool(re.search(pattern, v)) for v in values]


def test_email_pattern_finds_what_python_finds(spark):
    python = re.compile(r"[\w\.-]+@[\w\.-]+\.\w+")
    parts = ["a", "b.c", "@", ".", "-", " ", "é", "x_1", "@y.zz", "(", "٣", "\n"]
    values = [p + q + r + s for p in parts for q in parts for r in parts for s in parts[2:6]]
    values += ["a@b.cc-x@y.zz.", "a@b@c.d@e.f", "no", "a@b", "x" * 2000, "me@" + "a-" * 2000 + "b.org"]
    rows = _one_column(spark, values).select(
        F.regexp_extract_all("t", F.lit(EMAIL), F.lit(0)).alias("found"), F.regexp_replace("t", EMAIL, "").alias("rest")
    )
    for value, row in zip(values, rows.collect()):
        assert row.found == python.findall(value), value
        assert row.rest == python.sub("", value), value


def test_dotted_numbers_in_long_texts(spark):
    python = re.compile(r"[0-9]+(?:[.][0-9]+){3,}")
    values = ["a1.2.3.4b 5.6.7", "1.2.3.4.5..6.7.8.9.", "7" * 2000, ".1.2.3.4", "1." * 30000 + "1", "v1.22.333.444, x"]
    rows = _one_column(spark, values).select(F.regexp_extract_all("t", F.lit(QUAD), F.lit(0)).alias("found")).collect()
    assert [r.found for r in rows] == [python.findall(v) for v in values]
    long = _one_column(spark, ["7" * 500_000, "x" * 500_000, "1." * 200_000 + "1"])
    found = F.concat(*[F.regexp_extract_all("t", F.lit(p), F.lit(0)) for p in (QUAD, EMAIL)])
    assert sorted(len(r.found) for r in long.select(found.alias("found")).collect()) == [0, 0, 1]
    df = spark.createDataFrame([(1, "at 010.0.0.1 or 1.2.3.256"), (2, "none")], "k long, t string")
    assert [tuple(r) for r in text_ipv4(df, "k", "t").collect()] == [
        (1, 0, "010.0.0.1", "10.0.0.1", True, "ok", "private_rfc1918"),
        (1, 1, "1.2.3.256", None, False, "octet_out_of_range", "invalid"),
    ]
