"""Shared addresses of a stream against the batch job, for any cut into batches."""

import random

import pytest

from netgroom.operators.anomalies import duplicate_mac
from netgroom.streaming.shared import corrections, shared_macs, watch_shared_macs

SCHEMA = "source_row_id long, mac string"
DAY = "2025-11-04"


def run(spark, base, files):
    """One stream run for each list of files; each file of a run is a batch."""
    for k, batches in enumerate(files):
        for j, rows in enumerate(batches):
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
        given = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        watch_shared_macs(given, f"{base}/out", DAY, f"{base}/mark", partitions=2).awaitTermination()


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_equals_batch_after_any_cut(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(500) if rng.random() < 0.95 else None, rng.choice(["hot", "hot", None, *(f"m{k}" for k in range(60))])) for _ in range(400)]
    cuts = sorted(rng.sample(range(1, 400), 4))
    parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, 400])]
    run(spark, tmp_path, [parts[:2], parts[2:]])
    got = shared_macs(spark, str(tmp_path / "out"), DAY)
    assert found(got) == found(duplicate_mac(spark.createDataFrame(rows, SCHEMA)))
    run(spark, tmp_path, [[]])  # nothing new
    assert found(shared_macs(spark, str(tmp_path / "out"), DAY)) == found(got)


def test_late_rows_correct_earlier_findings(spark, tmp_path):
    first = [(3, "a"), (5, "b"), (6, "b"), (9, "c")]
    second = [(1, "a"), (2, "b"), (7, "d")]
    run(spark, tmp_path, [[first], [second]])
    out = str(tmp_path / "out")
    assert found(shared_macs(spark, out, DAY, batch=0)) == [(5, "b", 2, 6), (6, "b", 2, 5)]
    assert found(corrections(spark, out, DAY, 1)) == [
        (1, "a", 2, 3, False), (2, "b", 3, 6, False), (3, "a", 2, 1, True), (5, "b", 3, 2, True), (6, "b", 3, 2, True),
    ]
    assert found(shared_macs(spark, out, DAY)) == [tuple(r)[:4] for r in found(corrections(spark, out, DAY, 1))]
    assert found(corrections(spark, out, DAY, 0)) == [(5, "b", 2, 6, False), (6, "b", 2, 5, False)]
