"""Spark session for tests and measurements on one machine; on a cluster use the session you have."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR = "spark.checkpoint.dir"


def local_session(name: str = "netgroom", cores: int | str = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores) if cores != "*" else "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_HUGE = "spark.sql.codegen.hugeMethodLimit"


def tune(spark: SparkSession) -> SparkSession:
    """Set the one option the cleaning plans profit from.

    Cleaning all fields in one pass makes a generated method larger than the
    8000 bytes up to which HotSpot compiles methods.  With this limit Spark
    then runs the projections one by one, each in compiled pieces, which takes
    about half the time.
    """
    spark.conf.set(_HUGE, "8000")
    return spark


@contextmanager
def tuned(spark: SparkSession) -> Iterator[SparkSession]:
    """:func:`tune` for a while; afterwards the option is what it was."""
    before = spark.conf.get(_HUGE)
    try:
        yield tune(spark)
    finally:
        spark.conf.set(_HUGE, before)


def as_now(spark: SparkSession) -> SparkSession:
    """A session with the present options of ``spark`` that later changes do not reach.

    Files read through it are split alike each time, also when the options change or more executors come.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    cores = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or spark.sparkContext.defaultParallelism
    least = "spark.sql.files.minPartitionNum"
    own.conf.set(least, spark.conf.get(least, None) or str(cores))
    return own


def shared_dir(spark: SparkSession) -> str:
    """The folder shared by all executors that the cluster names for intermediate tables."""
    folder = spark.conf.get(SHARED_DIR, None) or spark.sparkContext.getConf().get(SHARED_DIR, None)
    if not folder:
        raise ValueError(f"set {SHARED_DIR} or give a folder that all executors share")
    return folder.rstrip("/")


def own_dir(spark: SparkSession, kind: str, out: str) -> str:
    """A folder for intermediate tables of what is published in ``out``: one for each, so that two never meet."""
    return f"{shared_dir(spark)}/netgroom/{kind}-{hashlib.sha256(out.rstrip('/').encode()).hexdigest()[:16]}"


def scratch_dir(spark: SparkSession) -> str:
    """:func:`shared_dir`; where none is named and one machine runs all, a temporary folder."""
    master = spark.sparkContext.master
    if master.startswith("local") and not master.startswith("local-cluster"):
        try:
            return shared_dir(spark)
        except ValueError:
            return tempfile.mkdtemp(prefix="netgroom-")
    return shared_dir(spark)


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """A table written to the shared folder and read back: cut off from its plan, and no lost executor undoes it."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
