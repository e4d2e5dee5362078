"""Shared MAC addresses of a stream: state for each address, findings that later batches correct.

State holds what an address needs and no more: how many devices have it and the first and last
of their row ids.  An address is dealt over a few salts, so one that a third of all devices
share is no single state.  Each batch adds its rows and the new state of every address that it
touched to a log; the findings of all rows so far are those of the batch job on the same rows,
wherever the batches are cut.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from netgroom.operators.anomalies import with_other
from netgroom.operators.skew import salted_lookup
from netgroom.session import own_dir
from netgroom.sources.writers import run_path, write_stage

# The processor travels to the executors by value: tasks need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: States of one address.
SALTS = 16

_STATE = "n long, first long, last long"
#: A device (its ``source_row_id``), or the state of a part of an address after a batch (no row id, ``n`` set).
_LOG = "mac string, salt int, source_row_id long, n long, first long, last long"
_PROVIDER = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


class SharedMac(StatefulProcessor):
    """Counts the devices of a part of an address and keeps the least and the greatest row id."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.group = handle.getValueState("group", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        mac, salt = key
        n, first, last = self.group.get() if self.group.exists() else (0, None, None)
        for part in rows:
            ids = part["source_row_id"]
            n += len(ids)
            known = [int(i) for i in ids if not pd.isna(i)]
            first, last = (f([x for x in (have, *known) if x is not None], default=None) for f, have in ((min, first), (max, last)))
            yield self._log(mac, salt, [None if pd.isna(i) else int(i) for i in ids], [None] * len(ids), None, None)
        self.group.update((n, first, last))
        yield self._log(mac, salt, [None], [n], first, last)

    @staticmethod
    def _log(mac, salt, ids, n, first, last) -> pd.DataFrame:
        size = len(ids)
        whole = lambda values: pd.array(values, dtype="Int64")
        return pd.DataFrame(
            {
                "mac": [mac] * size, "salt": pd.array([salt] * size, dtype="Int32"), "source_row_id": whole(ids), "n": whole(n),
                "first": whole([first] * size), "last": whole([last] * size),
            }
        )

    def close(self) -> None:
        pass


def watch_shared_macs(
    clean: DataFrame, out: str, run_date: str, checkpoint: str | None = None, salts: int = SALTS, partitions: int | None = None
) -> StreamingQuery:
    """Log the devices and addresses of a cleaned stream (``source_row_id``, ``mac``) below ``out`` and stop when all is read.

    Rows without an address play no part; rows that repeat an id are devices each.  Each batch
    overwrites its own directory when repeated, and ``checkpoint`` (by default below
    ``spark.checkpoint.dir``, one for each ``out`` and date) keeps progress and state, so every row
    counts once.  ``partitions`` is the number of state partitions, fixed by the first run.
    """
    spark = clean.sparkSession
    checkpoint = checkpoint or own_dir(spark, "shared-mac", f"{out}/{run_date}")
    rows = clean.where("mac IS NOT NULL").select("source_row_id", "mac", F.pmod(F.xxhash64("source_row_id"), F.lit(salts)).cast("int").alias("salt"))
    kept = rows.groupBy("mac", "salt").transformWithStateInPandas(SharedMac(), _LOG, "Update", "None")

    def publish(batch: DataFrame, number: int) -> None:
        write_stage(batch, f"{out}/shared_mac", run_date, f"batch={number}")

    options = _PROVIDER | ({"spark.sql.shuffle.partitions": str(partitions)} if partitions else {})
    before = {k: spark.conf.get(k) for k in options}
    for k, v in options.items():
        spark.conf.set(k, v)
    try:
        query = kept.writeStream.foreachBatch(publish).outputMode("update").option("checkpointLocation", checkpoint)
        return query.trigger(availableNow=True).start()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _log(spark: SparkSession, out: str, run_date: str, batch: int | None) -> DataFrame:
    log = spark.read.schema(f"{_LOG}, batch long").parquet(run_path(f"{out}/shared_mac", run_date))
    return log if batch is None else log.where(F.col("batch") <= batch)


def _groups(log: DataFrame) -> DataFrame:
    """The latest state of every address, its parts put together: (mac, n, _first, _last)."""
    latest = log.where("n IS NOT NULL").groupBy("mac", "salt").agg(F.max_by(F.struct("n", "first", "last"), "batch").alias("g"))
    return latest.groupBy("mac").agg(F.sum("g.n").alias("n"), F.min("g.first").alias("_first"), F.max("g.last").alias("_last"))


def shared_macs(spark: SparkSession, out: str, run_date: str, batch: int | None = None) -> DataFrame:
    """Devices that share their address among all rows so far (or up to ``batch``), as :func:`duplicate_mac` finds them."""
    log = _log(spark, out, run_date, batch)
    rows = log.where("n IS NULL").select("source_row_id", "mac")
    return with_other(salted_lookup(rows, _groups(log).where("n > 1"), "mac"))


def corrections(spark: SparkSession, out: str, run_date: str, batch: int) -> DataFrame:
    """Findings that ``batch`` made or changed, also about rows of earlier batches: those of its addresses that differ from before.

    ``late`` marks rows that came before the batch.
    """
    log = _log(spark, out, run_date, batch)
    touched = log.where((F.col("batch") == batch) & F.col("n").isNotNull()).select("mac").distinct()
    near = log.join(touched, "mac", "left_semi")

    def found(part: DataFrame) -> DataFrame:
        rows = part.where("n IS NULL").select("source_row_id", "mac", (F.col("batch") < batch).alias("late"))
        return with_other(salted_lookup(rows, _groups(part).where("n > 1"), "mac"), "late")

    return found(near).exceptAll(found(near.where(F.col("batch") < batch)))
