"""The same cleaning over a directory that new files arrive in."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from netgroom.operators.anomalies import detect_anomalies
from netgroom.operators.clean import clean_inventory
from netgroom.operators.owners import correct_owner
from netgroom.session import own_dir, tuned
from netgroom.sources.readers import CSV_FILES, null_tokens, typed_row_id
from netgroom.sources.records import line_records, placed
from netgroom.sources.schema import RAW_COLUMNS
from netgroom.sources.writers import write_json, write_stage


def raw_stream(
    spark: SparkSession,
    directory: str,
    files_per_batch: int | None = None,
    columns: Sequence[str] = RAW_COLUMNS,
) -> DataFrame:
    """Raw rows of all ``*.csv`` files that are in the directory or arrive later.

    Every file must have these ``columns``; a line break inside quotes is an error.
    """
    reader = spark.readStream.option("lineSep", "\n").option("pathGlobFilter", CSV_FILES)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return typed_row_id(null_tokens(line_records(placed(reader.text(directory)), list(columns))))


def publish_stream(
    raw: DataFrame,
    out: str,
    run_date: str,
    checkpoint: str | None = None,
    correct: Callable[[DataFrame], DataFrame] = correct_owner,
    find: Callable[[DataFrame], DataFrame] = detect_anomalies,
) -> StreamingQuery:
    """Clean what is there now, publish it and stop.

    ``checkpoint`` keeps the progress, by default below ``spark.checkpoint.dir``, one for each ``out`` and date.
    Each batch writes its own directory and overwrites it when repeated, so
    every row is published exactly once.  All steps work row by row; findings
    across rows, such as shared MAC addresses, come from the published table.
    """
    checkpoint = checkpoint or own_dir(raw.sparkSession, "stream", f"{out}/{run_date}")
    cleaned = correct(clean_inventory(raw))

    def publish(batch: DataFrame, number: int) -> None:
        path = write_stage(batch, f"{out}/inventory_clean", run_date, f"batch={number}")
        written = batch.sparkSession.read.parquet(path)
        write_json(find(written), f"{out}/anomalies/run_date={run_date}/batch={number}")

    # the stream runs with the options that hold when it starts
    with tuned(raw.sparkSession):
        return (
            cleaned.writeStream.foreachBatch(publish)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
