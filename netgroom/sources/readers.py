"""Reading raw and clean inventories, replies and anomaly reports."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netgroom.operators.payload import owner_reply_rows
from netgroom.sources.records import header_of, line_records, lines_of, read_records
from netgroom.sources.schema import ANOMALY, CLEAN, NA_TOKENS, RAW_COLUMNS, STEP

CSV_FILES = "*.[cC][sS][vV]"
CORRUPT = "_corrupt_line"


def _csv_path(path: str | None) -> str:
    if not path:
        raise ValueError("missing path of the inventory")
    ending = os.path.splitext(path)[1].lower()
    if not path.endswith("/") and ending not in ("", ".csv"):
        raise ValueError(f"not a CSV file: {path} (directories may end in /)")
    return path


def csv_options(multiline: bool) -> dict[str, str]:
    return {
        "header": "true",
        "escape": '"',
        "multiLine": str(multiline).lower(),
        "pathGlobFilter": CSV_FILES,
        "enforceSchema": "false",
    }


def _plain_records(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Records of files without quotes, by Spark's own reader; too many values are an error, short lines are filled with NULL."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])
    options = csv_options(False) | {"columnNameOfCorruptRecord": CORRUPT, "columnPruning": "false"}
    lines = spark.read.options(**options).schema(schema).csv(path)
    n_commas = F.length(CORRUPT) - F.length(F.replace(F.col(CORRUPT), F.lit(","), F.lit("")))
    too_long = F.raise_error(F.concat(F.lit("row "), F.coalesce(F.col(names[0]), F.lit("?")), F.lit(": too many values")))
    return lines.where(F.when(n_commas >= len(names), too_long).isNull()).drop(CORRUPT)


def null_tokens(df: DataFrame) -> DataFrame:
    """Texts that mean "no value" become NULL in every text column."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(NA_TOKENS), F.col(c)) for c in texts})


def typed_row_id(df: DataFrame) -> DataFrame:
    return df.withColumn("source_row_id", F.trim("source_row_id").try_cast("long"))


def read_raw(spark: SparkSession, path: str, na: bool = True, multiline: bool | None = None) -> DataFrame:
    """A raw inventory: a CSV file or a directory of them, all columns text but the row id.

    Only ``*.csv`` files are read, split over tasks.  A line break inside quotes belongs to its value:
    files with quotes are read by :func:`read_records`, in two passes.  ``multiline=False`` spares the first pass
    and makes such a line break an error; with ``multiline=True`` a file is one task.
    ``na=False`` keeps all texts as they are and missing ones as ``""``.
    """
    lines = lines_of(spark, _csv_path(path), CSV_FILES)
    names = header_of(spark, path, CSV_FILES)
    missing = [c for c in RAW_COLUMNS if c not in names and c != "notes"]
    if missing:
        raise ValueError(f"columns missing in {path}: {missing}")
    if multiline:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
        df = spark.read.options(**csv_options(True)).schema(schema).csv(path)
    elif lines.where(F.col("value").contains('"')).isEmpty():
        df = _plain_records(spark, path, names)
    else:
        df = line_records(lines, names) if multiline is False else read_records(spark, path, CSV_FILES, names)
    if na:
        return typed_row_id(null_tokens(df))
    return df.fillna("", subset=names)


def _steps_json(text: Column) -> Column:
    """Step lists as JSON; lists written in Python notation get ``null`` for ``nan`` and ``None``."""
    return F.regexp_replace(text, r"('(?:from|to)': )(?:nan|None)(?=[,}])", "$1null")


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """A clean inventory stored as CSV, split over tasks; unnamed index columns are dropped."""
    names = header_of(spark, _csv_path(path), CSV_FILES)
    df = null_tokens(read_records(spark, path, CSV_FILES, names).drop(*(c for c in names if c == "" or c.startswith("Unnamed:"))))
    steps = F.from_json(
        _steps_json(F.col("normalization_steps")),
        T.ArrayType(STEP),
        {"allowBackslashEscapingAnyCharacter": "true"},
    )
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in CLEAN.fields[:-1]}
    return df.select(*[c.alias(n) for n, c in typed.items()], steps.alias("normalization_steps"))


def read_owner_reply(spark: SparkSession, path: str, first_row_id: int = 0) -> DataFrame:
    """Owner proposals from files that each hold one reply ``{column: {row: value}}``."""
    replies = spark.read.text(path, wholetext=True)
    return owner_reply_rows(replies, "value", first_row_id)


def read_proposals(spark: SparkSession, path: str) -> DataFrame:
    """Proposals written by ``write_json``, one object for each row."""
    fields = "source_row_id long, owner string, owner_team string, owner_email string, confidence_percentage double"
    return spark.read.schema(fields).json(path)


def read_anomalies(spark: SparkSession, path: str, as_list: bool = True) -> DataFrame:
    """Anomaly records: files that each hold a list, or one object for each line."""
    return spark.read.schema(ANOMALY).option("multiLine", as_list).json(path)
