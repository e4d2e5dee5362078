"""Daily runs and model replies under repeated ids, half-read records and failed repeats."""

import json
import os

import pytest

from netgroom.operators.clean import clean_inventory
from netgroom.operators.payload import audit_anomaly_replies, owner_payloads, without_key
from netgroom.plans.daily import run_daily
from netgroom.session import own_dir, tuned
from netgroom.sources.readers import read_clean



def _table(spark):
    from netgroom.sources.schema import RAW_COLUMNS

    rows = [("1", "10.0.0.1", "a"), ("1", "10.0.0.2", "b"), (None, "10.0.0.3", "c"), ("2", "10.0.0.4", "d")]
    raw = spark.createDataFrame([(*r, None, None, f"was {r[2]}", None, None, None) for r in rows], ", ".join(f"{c} string" for c in RAW_COLUMNS))
    return raw.withColumn("source_row_id", raw.source_row_id.cast("long"))


def test_repeated_and_missing_ids_are_all_answered(spark, tmp_path):
    def model(payload):
        data = json.loads(payload)
        ids = list(data["owner"])
        return json.dumps({
            "owner": {i: data["owner"][i].replace("was", "now") for i in ids},
            "owner_team": dict.fromkeys(ids, "t"),
            "owner_email": dict.fromkeys(ids),
            "confidence_percentage": dict.fromkeys(ids, 90),
        })

    done = run_daily(spark, _table(spark), str(tmp_path / "o"), "2025-11-04", str(tmp_path / "w"), owner_model=model, find_anomalies=None)
    rows = sorted((r.source_row_id or 0, r.hostname, r.owner, r.owner_team) for r in read_clean(spark, done.inventory).collect())
    assert rows == [(0, "c", "now c", "t"), (1, "a", "now a", "t"), (1, "b", "now b", "t"), (2, "d", "now d", "t")]
    assert (done.rows, done.unknown_proposals, done.unreadable_replies) == (4, 0, 0)
    assert without_key(_table(spark)) == 1
    assert sum(r.n_rows for r in owner_payloads(clean_inventory(_table(spark))).collect()) == 3


def _reply(**changes):
    return json.dumps([{"source_row_id": 3, "affected_fields": ["ip"], "issue_type": "odd", "recommended_action": "drop", "anomaly_confidence": 9} | changes])


@pytest.mark.parametrize(
    "change",
    [
        {"affected_fields": "ip"}, {"anomaly_confidence": "high"}, {"anomaly_confidence": 101}, {"anomaly_confidence": None}, {"recommended_action": "keep"},
        {"recommended_action": None}, {"affected_fields": []}, {"affected_fields": [None]}, {"issue_type": None}, {"source_row_id": "x"},
    ],
)
def test_a_half_read_record_makes_the_reply_unreadable(spark, change):
    replies = spark.createDataFrame([(1, _reply(**change)), (2, _reply())], "reply_id long, reply string")
    got = {r.reply_id: (r.readable, r.records, r.whole) for r in audit_anomaly_replies(replies).collect()}
    assert got == {1: (False, 1, 0), 2: (True, 1, 1)}


def test_a_failed_repeat_leaves_no_old_anomalies(spark, tmp_path):
    out, work = str(tmp_path / "o"), str(tmp_path / "w")
    done = run_daily(spark, _table(spark), out, "2025-11-04", work)
    other = run_daily(spark, _table(spark), out, "2025-11-05", work)
    assert os.path.isdir(done.anomalies)

    def down(payload):
        raise ConnectionError("down")

    half = _reply(affected_fields="ip")
    for given in ({"anomaly_model": down}, {"anomaly_model": lambda p: half}, {"find_anomalies": None}):
        run_daily(spark, _table(spark), out, "2025-11-04", work)
        again = run_daily(spark, _table(spark), out, "2025-11-04", work, **given)
        assert again.anomalies is None and not os.path.exists(done.anomalies)
    assert os.path.isdir(other.anomalies)


def test_folders_of_two_outputs_differ_and_options_are_restored(spark, tmp_path):
    if spark.conf.get("spark.checkpoint.dir", None):
        assert own_dir(spark, "work", "/a") == own_dir(spark, "work", "/a/") != own_dir(spark, "work", "/b")
        assert own_dir(spark, "work", "/a") != own_dir(spark, "stream", "/a")
    option = "spark.sql.codegen.hugeMethodLimit"
    held = spark.conf.get(option)
    spark.conf.set(option, "4321")
    with pytest.raises(KeyError), tuned(spark):
        assert spark.conf.get(option) == "8000"
        raise KeyError
    assert spark.conf.get(option) == "4321"
    spark.conf.set(option, held)
