"""Physical plans: what is read, what is shuffled, what is broadcast."""

import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

from netgroom.operators.anomalies import detect_anomalies, duplicate_mac
from netgroom.operators.clean import clean_fields, clean_inventory, normalization_log
from netgroom.operators.owners import correct_owner, merge_owner, propose_owner
from netgroom.operators.payload import owner_payloads
from netgroom.operators.reports import preview, quality_report
from netgroom.plans.fixture import inventory, proposals


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The raw and the clean table in files of several splits, as on a cluster."""
    base = str(tmp_path_factory.mktemp("tables"))
    inventory(spark, SF).write.parquet(f"{base}/raw")
    raw = spark.read.parquet(f"{base}/raw")
    clean_inventory(raw).write.parquet(f"{base}/clean")
    return raw, spark.read.parquet(f"{base}/clean")


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def shuffles(df) -> int:
    return len(re.findall(r"\+- Exchange|^Exchange", plan(df).split("\n\n\n")[0], re.M))


def columns_read(df) -> set[str]:
    found = set()
    for schema in re.findall(r"ReadSchema: struct<([^\n]*)>", plan(df)):
        found |= set(re.findall(r"(?:^|,)(\w+):", re.sub(r"array<.*?>>", "array", schema)))
    return found


def test_row_wise_work_needs_no_shuffle(stored):
    raw, clean = stored
    for df in (
        clean_inventory(raw),
        normalization_log(raw),
        correct_owner(clean),
        detect_anomalies(clean),
        detect_anomalies(clean_inventory(raw)),
        owner_payloads(clean),
    ):
        assert shuffles(df) == 0
        assert "BatchEvalPython" not in plan(df) and "ArrowEvalPython" not in plan(df)


def test_only_needed_columns_are_read(stored):
    raw, clean = stored
    assert columns_read(clean_fields(raw).select("mac_clean")) == {"mac"}
    assert columns_read(clean_fields(raw).select("fqdn_consistent")) == {"fqdn", "hostname", "site"}
    assert columns_read(duplicate_mac(clean)) == {"source_row_id", "mac"}
    assert columns_read(detect_anomalies(clean)) == {
        "source_row_id", "ip", "ip_valid", "ip_type", "subnet_cidr", "mac_valid", "device_type",
    }


def test_filters_reach_the_scan(stored):
    raw, clean = stored
    assert "GreaterThan(source_row_id,5)" in plan(clean_inventory(raw).where("source_row_id > 5"))
    assert "IsNotNull(mac)" in plan(duplicate_mac(clean))


def test_work_is_not_repeated(stored):
    """Each pattern stands once in the plan of all fields: nothing was copied into later projections."""
    text = plan(clean_inventory(stored[0]))
    for pattern in ("{2}[:-]){5}", "isconsistent", "@["):
        assert text.count(pattern) <= 2, pattern


def test_reports_count_before_the_shuffle(stored):
    text = plan(quality_report(stored[0]))
    assert "partial_count" in text
    assert "TakeOrderedAndProject" in plan(preview(stored[1]))


def test_no_cross_join(spark, stored):
    clean = stored[1]
    for df in (merge_owner(clean, proposals(spark, SF)), duplicate_mac(clean)):
        assert "CartesianProduct" not in plan(df) and "BroadcastNestedLoopJoin" not in plan(df)


def final_plan(df) -> str:
    df.collect()
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    return text[: text.index("Initial Plan")] if "Initial Plan" in text else text


def test_merge_reads_the_table_once(spark, stored):
    clean = stored[1]
    text = final_plan(merge_owner(clean, proposals(spark, SF)))
    assert len([s for s in re.findall(r"FileScan parquet \[(.*?)\]", text) if "hostname" in s]) == 1
    assert len(re.findall(r"(?:HashJoin|MergeJoin)", text)) == 1


def test_shared_addresses_read_the_table_twice(stored):
    """Once to count the addresses, once to join; the counts are shared by the list of hot ones and the total."""
    text = final_plan(duplicate_mac(stored[1]))
    scans = len(re.findall(r"FileScan parquet", text))
    assert scans - len(re.findall("Reused", text)) <= 3 and "GlobalLimit" not in text


def test_broadcasts_are_bounded(stored):
    """The only hinted broadcast in the join of shared addresses is the list of hot keys, at most a thousand by their share."""
    hinted = duplicate_mac(stored[1])._jdf.queryExecution().logical().toString()
    assert hinted.count("ResolvedHint (strategy=broadcast)") == 1
