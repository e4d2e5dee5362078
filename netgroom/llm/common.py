"""Shared helpers: typed per-text maps, written intermediate tables, connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from netgroom.llm.text import chunks
from netgroom.session import shared_dir


#: Folder of a session on one machine for which none is named.
_own: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only where none is named and one machine runs all (as in tests)."""
    try:
        return shared_dir(spark)
    except ValueError:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="shared-"))
    return _own[0]


def stored(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back; a lost executor cannot undo it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator needs, so that other columns' names cannot clash."""
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))


def map_texts(rows: DataFrame, schema: str, make: Callable[[], Callable]) -> DataFrame:
    """Map ``texts`` rows in tasks: ``make()`` once a task, its result turns (id, text) into rows.

    A task holds one chunk of about a megabyte of text, or one longer text, and
    that chunk's rows.
    """
    kind = T._parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(kind)
        work = make()
        for batch in batches:
            for part in chunks(batch, "text"):
                out = [r for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()) for r in work(i, t)]
                columns = list(zip(*out)) if out else [[] for _ in arrow]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow
                )

    return rows.mapInArrow(run, kind)


#: A key is hot if it holds more than this part of all rows; so there are at most so many hot keys.
HOT_PART = 1000


def join_counted(rows: DataFrame, side: DataFrame, key: str, count: str) -> DataFrame:
    """Inner join of ``rows`` with ``side``, which has one row for each ``key`` and its number of ``rows`` in ``count``.

    Keys with more than a thousandth of all counted rows are at most a thousand: their part of
    ``side`` is broadcast and their rows stay where they are.  All other rows are shuffled by key.
    Both tables are read twice, so give stored ones.
    """
    total = side.agg(F.sum(count)).first()[0] or 0
    hot = F.broadcast(side.where(F.col(count) * HOT_PART > total))
    rest = rows.join(hot.select(key), key, "left_anti").join(side.where(F.col(count) * HOT_PART <= total), key)
    return rows.join(hot, key).unionByName(rest)


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of ``links`` (a, b): rows (node, component).

    Large-star and small-star rounds; each round groups by node with partial
    aggregation of minima, so the size of a component never meets one task.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _digest(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("n"), F.least("a", "b").alias("m"))
        # every larger neighbour and the node itself point to the node's minimum
        star = both.join(low, both.a == low.n).where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = low.where("n > m").select(F.col("n").alias("a"), F.col("m").alias("b"))
        edges = stored(star.unionByName(own).distinct())
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _digest(edges: DataFrame) -> tuple:
    """Number of edges and two sums of their hashes: equal for equal sets."""
    wide = [F.sum(F.xxhash64("a", "b", F.lit(k)).cast("decimal(38,0)")) for k in (0, 1)]
    return tuple(edges.agg(F.count("*"), *wide).first())
