"""The daily run: clean, correct owners, detect anomalies, publish."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netgroom.operators.anomalies import all_anomalies
from netgroom.operators.clean import clean_inventory
from netgroom.operators.owners import correct_owner, merge_owner, unknown_proposals
from netgroom.operators.payload import (
    anomaly_payloads,
    anomaly_reply_rows,
    ask,
    owner_payloads,
    owner_reply_rows,
    unreadable_anomaly_replies,
    unreadable_owner_replies,
)
from netgroom.operators.starter import starter_anomalies, starter_clean
from netgroom.session import own_dir, tuned
from netgroom.sources.readers import read_raw
from netgroom.sources.schema import ANOMALY
from netgroom.sources.writers import remove, run_path, write_csv, write_json, write_stage


#: Column of a row's key within a run.
ROW_KEY = "row_key"


@dataclass(frozen=True)
class Published:
    inventory: str
    anomalies: str | None
    rows: int
    unknown_proposals: int
    unreadable_replies: int = 0


def _asked(spark: SparkSession, payloads: DataFrame, model, base: str, run_date: str) -> DataFrame:
    """Replies of a model, written once and read back, so that no call is repeated later."""
    return spark.read.parquet(write_stage(ask(payloads, model), base, run_date))


def run_daily(
    spark: SparkSession,
    source: str | DataFrame,
    out: str,
    run_date: str,
    work: str | None = None,
    proposals: DataFrame | None = None,
    owner_model: Callable[[str], str] | None = None,
    anomaly_model: Callable[[str], str] | None = None,
    find_anomalies: Callable[[DataFrame], DataFrame] | None = all_anomalies,
) -> Published:
    """Run all stages for one date and publish below ``out``.

    ``out`` and ``work`` (by default below ``spark.checkpoint.dir``, one for each ``out``) must be
    folders shared by all executors.  Every stage is a
    written table, so a failed run can be repeated and later stages do not
    recompute earlier ones.  The first gives every row a key, by which models are asked and
    answer: row ids may be repeated or missing.  Owners are corrected by given ``proposals``, by
    the replies of ``owner_model``, or by rule.  Failed model calls leave their
    rows as they are.  With ``find_anomalies=None``, or when any call of
    ``anomaly_model`` failed or gave no list of records, only the table is published: a
    part of the anomalies would look like all of them, and those of an earlier run of the date are removed.  ``unreadable_replies`` counts
    the failed and unreadable replies of both models.
    """
    with tuned(spark):
        work = own_dir(spark, "work", out) if work is None else work
        raw = read_raw(spark, source) if isinstance(source, str) else source
        # numbers of rows as they are written; from then on they stand in the table
        keyed = clean_inventory(raw).withColumn(ROW_KEY, F.monotonically_increasing_id())
        cleaned = spark.read.parquet(write_stage(keyed, f"{work}/cleaned", run_date))

        unreadable, key = 0, "source_row_id"
        if proposals is None and owner_model is not None:
            key = ROW_KEY
            replies = _asked(spark, owner_payloads(cleaned, key=key), owner_model, f"{work}/owner_replies", run_date)
            proposals = owner_reply_rows(replies, key=key)
            unreadable += unreadable_owner_replies(replies).count()
        unknown = 0
        if proposals is None:
            corrected = correct_owner(cleaned)
        else:
            proposals = spark.read.schema(proposals.schema).json(
                write_json(proposals, run_path(f"{work}/proposals", run_date))
            )
            corrected = merge_owner(cleaned, proposals, key=key)
            unknown = unknown_proposals(cleaned, proposals, key).count()
        corrected = spark.read.parquet(write_stage(corrected.drop(ROW_KEY), f"{work}/corrected", run_date))

        found = None
        if anomaly_model is not None:
            replies = _asked(spark, anomaly_payloads(corrected), anomaly_model, f"{work}/anomaly_replies", run_date)
            bad = unreadable_anomaly_replies(replies).count()
            unreadable += bad
            if not bad:
                found = anomaly_reply_rows(replies)
        elif find_anomalies is not None:
            found = find_anomalies(corrected)
        anomalies = run_path(out, run_date, "anomalies")
        if found is not None:
            write_json(found.select(*ANOMALY.names), anomalies)
        else:
            remove(spark, anomalies)
            anomalies = None
        inventory = run_path(out, run_date, "inventory_clean")
        return Published(inventory, anomalies, write_csv(corrected, inventory), unknown, unreadable)


def run_starter(spark: SparkSession, source: str, out: str, run_date: str) -> Published:
    """The starter variant: addresses checked, everything else passed through, one record for each bad address."""
    raw = read_raw(spark, source, na=False)
    anomalies = write_json(starter_anomalies(raw), run_path(out, run_date, "anomalies"))
    inventory = run_path(out, run_date, "inventory_clean")
    return Published(inventory, anomalies, write_csv(starter_clean(raw), inventory), 0)
