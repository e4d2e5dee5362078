"""The corpus pipeline: language ID, near duplicates, decontamination, secrets, token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netgroom.llm.bpe import with_tokens
from netgroom.llm.common import stored, table
from netgroom.llm.decontaminate import contaminated
from netgroom.llm.jaccard import jaccard_classes
from netgroom.llm.langid import keep_identified, train
from netgroom.llm.secrets import redact_secrets

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Near duplicates share 80 percent of their shingles of 5 words; op9_jaccard has a contract of its own.
SHINGLE, SHARED = 5, 80
#: Columns of a row's key within a stage, and of what it is made of.
ROW, FILE, PLACE, NUMBER = "netgroom_row", "netgroom_file", "netgroom_place", "netgroom_number"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, in ``lang`` where that was null.

    Texts that are null, empty or without letters go, and longer ones that no language fits
    better than another.
    """
    return keep_identified(docs, train(docs))


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a key of every row: the number of its file and its place there.

    No two rows share a key, however equal they are.  Rows that are not read from files are written first.
    """
    place = [F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(PLACE)]
    try:
        rows = docs.select("*", *place)
    except AnalysisException:
        rows = stored(docs).select("*", *place)
    # one row for each file, of which the driver has a list anyway
    files = rows.select(FILE).distinct().withColumn(NUMBER, F.row_number().over(Window.orderBy(FILE)).cast("long"))
    key = F.shiftleft(NUMBER, 40).bitwiseOR(F.col(PLACE)).alias(ROW)
    return rows.join(F.broadcast(stored(files)), FILE).select(*(F.col(f"`{c}`") for c in docs.columns), key)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each class, rows without an id last and equal ones by place; texts without words stay."""
    rows = keyed(docs)
    classes = jaccard_classes(rows, ROW, size=SHINGLE, percent=SHARED).select(ROW, "component_id")
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW)).alias("least")
    first = rows.select(ROW, "doc_id").join(classes, ROW).groupBy("component_id").agg(least)
    return rows.join(first.select(F.col(f"least.{ROW}")), ROW, "left_semi").drop(ROW)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item; null and empty texts hold none, and equal rows are judged alike."""
    rows = keyed(docs)
    found = contaminated(rows, table(spark, sf_dir, "benchmark"), ROW).select(ROW).distinct()
    return rows.join(found, ROW, "left_anti").drop(ROW)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, secrets replaced by a mark and ``n_chars`` counted anew; null and empty texts have none, equal rows stay equal."""
    out = redact_secrets(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")))
    return out


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with the token ids of their texts, and digests of these and of the text decoded from them; a null text has no ids."""
    return with_tokens(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("secrets", secrets),
    ("tokens", tokens),
]

#: Suffix automata, token tables and tests of randomness have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
