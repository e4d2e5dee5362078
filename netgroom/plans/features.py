"""Registered queries of the features beyond row-wise cleaning."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netgroom.functions.device import clean_device_type
from netgroom.operators.clean import clean_inventory
from netgroom.operators.entities import device_classes
from netgroom.operators.history import as_of, extend_history, history, snapshot_diff, tasks_for
from netgroom.operators.learned import learn_owner
from netgroom.operators.mined import dependency_violations, mine_dependencies
from netgroom.operators.owners import merge_owner
from netgroom.operators.payload import audit_anomaly_replies
from netgroom.operators.prefixes import cidr_cover, longest_prefix
from netgroom.operators.spelling import guess_device_type
from netgroom.plans.derived import (
    LOOKUPS_SQL,
    MISSPELT_SQL,
    NOTED_SQL,
    PREFIXES_SQL,
    REPEATED_SQL,
    REPLIES_SQL,
    SHARED_SQL,
    SNAPSHOTS,
    SNAPSHOTS_SQL,
    TEAMS_SQL,
)
from netgroom.plans.fixture import inventory, proposals
from netgroom.plans.registry import query
from netgroom.session import scratch_dir
from netgroom.sources.readers import read_raw
from netgroom.sources.schema import OWNER_COLUMNS
from netgroom.streaming.shared import shared_macs, watch_shared_macs


def derived(spark: SparkSession, sf_dir: str, sql: str, **more: DataFrame) -> DataFrame:
    """A table of a text that reads the given ones by name."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "documents", "supplier", "customer") if f"FROM {t}" in sql}
    sql = sql.replace("{", "{{").replace("}", "}}")
    for t in tables:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}")
    return spark.sql(sql, **tables, **more)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder of its own for tables that a query writes and reads again."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query
def q_csv_quoted_breaks(spark, sf_dir):
    """A CSV file whose notes are whole documents, written and read again in splits."""
    path = scratch(spark, "noted")
    noted = derived(spark, sf_dir, NOTED_SQL)
    options = {"header": "true", "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    noted.write.options(**options).csv(path)
    back = read_raw(spark, f"{path}/", na=False)
    read = [F.length("notes").cast("long").alias("n_chars"), F.md5(F.col("notes").cast("binary")).alias("notes_md5")]
    # a document without an id has no address and no name either
    row_id, ip, hostname = (F.nullif(F.col(c), F.lit("")).alias(c) for c in ("source_row_id", "ip", "hostname"))
    return back.select(row_id.cast("long").alias("source_row_id"), ip, hostname, "mac", "owner", "device_type", "site", *read)


@query
def q_owner_merge_repeated(spark, sf_dir):
    """Proposals merged by a key of every row where ids are repeated and missing."""
    table = derived(spark, sf_dir, REPEATED_SQL)
    found = proposals(spark, sf_dir).withColumnRenamed("source_row_id", "row_key")
    return merge_owner(table, found, key="row_key").select("row_key", "source_row_id", *OWNER_COLUMNS)


@query
def q_reply_audit(spark, sf_dir):
    """Replies of a model about anomalies, judged as a whole."""
    return audit_anomaly_replies(derived(spark, sf_dir, REPLIES_SQL)).drop("reply")


@query
def q_stream_duplicate_mac(spark, sf_dir):
    """Shared addresses found by a stream over the inventory, three files in three batches."""
    base = scratch(spark, "stream")
    clean_inventory(inventory(spark, sf_dir)).select("source_row_id", "mac").repartition(3, "source_row_id").write.parquet(f"{base}/in")
    given = spark.readStream.schema("source_row_id long, mac string").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    watch_shared_macs(given, f"{base}/out", "2025-11-04", f"{base}/mark", partitions=4).awaitTermination()
    return shared_macs(spark, f"{base}/out", "2025-11-04")


_TRACKED = ["owner", "site"]


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, SNAPSHOTS_SQL)


@query
def q_history_diff(spark, sf_dir):
    """What the third run changed against the second."""
    old, new = (derived(spark, sf_dir, SNAPSHOTS[d]) for d in ("2025-11-02", "2025-11-03"))
    found = snapshot_diff(old, new, "source_row_id", _TRACKED)
    return found.withColumn("changed_fields", F.array_join("changed_fields", ","))


@query
def q_history_intervals(spark, sf_dir):
    """When each device was in which state, over five runs."""
    return history(_snapshots(spark, sf_dir), "source_row_id", _TRACKED)


@query
def q_history_extended(spark, sf_dir):
    """The same from the first three runs' history, extended by two runs."""
    rows = _snapshots(spark, sf_dir)
    # no more states than rows: the history is not worked out once more to be counted
    tasks = tasks_for(rows)
    known = history(rows.where("run_date <= '2025-11-03'"), "source_row_id", _TRACKED, tasks=tasks)
    for date in ("2025-11-04", "2025-11-05"):
        known = extend_history(known, derived(spark, sf_dir, SNAPSHOTS[date]), date, "source_row_id", _TRACKED, tasks)
    return known


@query
def q_history_asof(spark, sf_dir):
    """The states that devices had at given dates."""
    rows, lookups = _snapshots(spark, sf_dir), derived(spark, sf_dir, LOOKUPS_SQL)
    tasks = tasks_for(rows, lookups)
    known = history(rows, "source_row_id", _TRACKED, tasks=tasks)
    return as_of(known, lookups, "source_row_id", "asked_for", tasks)


@query
def q_device_classes(spark, sf_dir):
    """Rows of one device, by shared addresses and names."""
    return device_classes(derived(spark, sf_dir, SHARED_SQL))


@query
def q_longest_prefix(spark, sf_dir):
    """The most special prefix of a list for each device's address."""
    rows = clean_inventory(inventory(spark, sf_dir)).select("source_row_id", "ip")
    return longest_prefix(rows, derived(spark, sf_dir, PREFIXES_SQL))


@query
def q_cidr_cover(spark, sf_dir):
    """The fewest prefixes that hold just the inventory's addresses."""
    return cidr_cover(clean_inventory(inventory(spark, sf_dir)).select("ip"))


@query
def q_device_spelling(spark, sf_dir):
    """Types of misspelt names, by the nearest name of the list."""
    fields = guess_device_type(clean_device_type(derived(spark, sf_dir, MISSPELT_SQL)))
    return fields.select(
        "source_row_id", F.col("device_type").alias("raw"), F.col("device_type_clean").alias("device_type"), "device_type_confidence", "device_type_reason"
    )


@query
def q_owner_learned(spark, sf_dir):
    """Teams proposed for the rows without one, from what the others show."""
    return learn_owner(derived(spark, sf_dir, TEAMS_SQL))


@query
def q_mined_dependencies(spark, sf_dir):
    """How far fields follow from each other."""
    return mine_dependencies(derived(spark, sf_dir, TEAMS_SQL))


@query
def q_mined_anomalies(spark, sf_dir):
    """Rows that break what nearly all rows with the same value show."""
    found = dependency_violations(derived(spark, sf_dir, TEAMS_SQL), agree=0.7)
    return found.withColumn("affected_fields", F.array_join("affected_fields", ","))
