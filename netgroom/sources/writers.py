"""Writing stage tables, proposals, anomalies and the published inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def run_path(base: str, run_date: str, part: str | None = None) -> str:
    """Directory of one run, named so that readers see ``run_date`` as a partition column."""
    path = f"{base.rstrip('/')}/run_date={run_date}"
    return path if part is None else f"{path}/{part}"


def write_stage(df: DataFrame, base: str, run_date: str, part: str | None = None) -> str:
    """A stage table as Parquet, replacing an earlier run of the same date."""
    path = run_path(base, run_date, part)
    df.write.mode("overwrite").parquet(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder, if there, from whatever store it lies in."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def csv_columns(df: DataFrame) -> DataFrame:
    """The table with nested columns as JSON text, which CSV can hold."""
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
    return df.withColumns({c: F.to_json(c, {"ignoreNullFields": "false"}) for c in nested})


def write_csv(df: DataFrame, path: str) -> int:
    """Publish a table as CSV and return its number of rows, counted while writing.

    Empty texts and NULL are both written as nothing.
    """
    counted = Observation()
    (
        csv_columns(df)
        .observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .options(header="true", escape='"', emptyValue="")
        .csv(path)
    )
    return counted.get["rows"]
