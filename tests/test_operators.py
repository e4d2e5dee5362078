"""Correction, anomalies, payloads and skewed keys."""

import json

import pytest
from pyspark.sql import functions as F

from netgroom.operators.anomalies import all_anomalies, detect_anomalies, duplicate_mac
from netgroom.operators.clean import clean_inventory
from netgroom.operators.owners import (
    correct_owner,
    high_confidence,
    merge_owner,
    propose_owner,
    unknown_proposals,
)
from netgroom.operators.payload import (
    anomaly_payloads,
    anomaly_reply_rows,
    ask,
    owner_payloads,
    owner_reply_rows,
)
from netgroom.plans import fixture
from netgroom.operators.skew import salted_lookup

RAW = "source_row_id long, ip string, hostname string, fqdn string, mac string, owner string, device_type string, site string"
OWNED = "source_row_id long, owner string, owner_email string, owner_team string, note string"
PROPOSED = "source_row_id long, owner string, owner_team string, owner_email string, confidence_percentage double"

SAMPLE = [
    (1, "172.016.003.009", "GW01", None, "0A-0B-0C-0D-0E-0F", "mia (sec) mia@lab.example", "router", "Main Hall"),
    (2, "10.9.9.999", "gw-02", "gw-02.lan", "0a0b.0c0d.0e0f", "sec", None, "Main Hall"),
    (3, "127.0.0.8", "test", None, None, "tom@lab.example", "switch", None),
    (4, "169.254.3.4", "apipa", None, None, None, None, None),
    (5, "192.168.4.255", "bc", None, None, None, None, None),
    (6, "192.168.4.0", "net", None, None, None, None, None),
    (7, "10.255.255.255", "bc8", None, None, None, None, None),
    (8, "172.20.0.0", "net16", None, None, None, None, None),
    (9, "10.1.2.255", "plain", None, "00:00:00:00:00:09", None, "server", None),
    (10, "10.1.2.3", "nomac", None, None, None, "server", None),
    (11, "1.1.1.1", "rtr", None, "zz", None, "router", None),
    (12, None, "none", None, None, None, None, None),
    (13, "169.254.3.5", "apipa-ok", None, "00:00:00:00:00:13", None, None, None),
]


@pytest.fixture(scope="module")
def clean(spark):
    return clean_inventory(spark.createDataFrame(SAMPLE, RAW)).cache()


def test_log_keeps_order_and_raw_text(clean):
    row = clean.where("source_row_id = 1").first()
    assert [s["field"] for s in row.normalization_steps] == [
        "ip", "hostname", "fqdn", "mac", "owner", "device_type", "site",
    ]
    assert tuple(row.normalization_steps[0]) == ("ip", "172.016.003.009", "172.16.3.9", "ok")
    assert tuple(row.normalization_steps[2]) == ("fqdn", None, None, "missing")


def test_rules(clean):
    got = {r[0]: (",".join(r[1]), r[3], r[4]) for r in detect_anomalies(clean).collect()}
    assert got == {
        2: ("ip,ip_valid,ip_type,subnet_cidr", "drop", 100),
        3: ("ip,ip_type", "modify", 80),
        4: ("ip,ip_type,mac_valid", "modify", 75),
        5: ("ip", "modify", 90),
        6: ("ip", "modify", 90),
        7: ("ip", "modify", 90),
        8: ("ip", "modify", 90),
        10: ("mac_valid", "modify", 80),
        11: ("mac_valid", "modify", 70),
        12: ("ip,ip_valid,ip_type,subnet_cidr", "drop", 100),
    }


def test_shared_mac(clean):
    assert sorted(map(tuple, duplicate_mac(clean).collect())) == [
        (1, "0a:0b:0c:0d:0e:0f", 2, 2),
        (2, "0a:0b:0c:0d:0e:0f", 2, 1),
    ]
    found = all_anomalies(clean).where("array_contains(affected_fields, 'mac')").collect()
    assert {r.issue_type for r in found} == {
        "MAC address is duplicate with another device (source_row_id 1)",
        "MAC address is duplicate with another device (source_row_id 2)",
    }


def test_owner_rule(clean):
    got = {r.source_row_id: tuple(r)[1:] for r in propose_owner(clean).collect()}
    assert got[1] == ("mia", "sec", "mia@lab.example", 100.0)
    assert got[2] == (None, "sec", None, 100.0)
    assert got[3] == ("tom", None, "tom@lab.example", 80.0)
    assert got[4] == (None, None, None, 100.0)
    joined = {tuple(r) for r in merge_owner(clean, propose_owner(clean)).select("source_row_id", "owner", "owner_team").collect()}
    in_place = {tuple(r) for r in correct_owner(clean).select("source_row_id", "owner", "owner_team").collect()}
    assert joined == in_place
    strict = {r.source_row_id: r.owner for r in correct_owner(clean, threshold=90).collect()}
    assert strict[3] is None and strict[2] is None


def _owned(spark, ids):
    return spark.createDataFrame([(i, f"o{i}", f"e{i}", f"t{i}", "n") for i in ids], OWNED)


def test_merge_edges(spark):
    proposals = spark.createDataFrame(
        [
            (1, None, None, None, 70.0),
            (2, "new", "team", "mail", 69.0),
            (3, "new", "team", "mail", None),
            (4, "new", "team", None, 100.0),
            (99, "ghost", None, None, 100.0),
            (None, "nobody", None, None, 100.0),
        ],
        PROPOSED,
    )
    table = _owned(spark, [1, 2, 3, 4, 5]).union(_owned(spark, [None, None]))
    merged = merge_owner(table, proposals)
    assert merged.columns == table.columns
    rows = {r.source_row_id: (r.owner, r.owner_team, r.owner_email, r.note) for r in merged.where("source_row_id is not null").collect()}
    assert rows == {
        1: (None, None, None, "n"),
        2: ("o2", "t2", "e2", "n"),
        3: ("o3", "t3", "e3", "n"),
        4: ("new", "team", None, "n"),
        5: ("o5", "t5", "e5", "n"),
    }
    assert merged.count() == 7
    ghosts = unknown_proposals(table, high_confidence(proposals)).collect()
    assert sorted(r.owner for r in ghosts) == ["ghost", "nobody"]


def test_two_proposals_for_a_row_fail(spark):
    twice = spark.createDataFrame([(1, "a", None, None, 90.0), (1, "b", None, None, 95.0)], PROPOSED)
    with pytest.raises(Exception, match="more than one proposal for row 1"):
        merge_owner(_owned(spark, [1]), twice).collect()
    low = spark.createDataFrame([(1, "a", None, None, 90.0), (1, "b", None, None, 5.0)], PROPOSED)
    assert merge_owner(_owned(spark, [1]), low).first().owner == "a"


def test_hot_and_missing_keys_change_nothing(spark):
    ids = [1] * 500 + [2] * 80 + list(range(3, 200)) + [None] * 40
    proposals = spark.createDataFrame([(i, f"p{i}", None, None, 90.0) for i in range(2, 150)] + [(1, "hot", None, None, 75.0)], PROPOSED)
    merged = merge_owner(_owned(spark, ids), proposals)
    counts = {r.owner: r["count"] for r in merged.groupBy("owner").count().collect()}
    expected = {"hot": 500, "p2": 80, "oNone": 40}
    expected |= {f"p{i}": 1 for i in range(3, 150)} | {f"o{i}": 1 for i in range(150, 200)}
    assert counts == expected

    macs = spark.createDataFrame([(i, f"m{i % 7 if i < 600 else i}") for i in range(700)] + [(900, None)], "source_row_id long, mac string")
    found = sorted(map(tuple, duplicate_mac(macs).collect()))
    sizes = {m: len([i for i in range(600) if i % 7 == m]) for m in range(7)}
    last = {m: max(i for i in range(600) if i % 7 == m) for m in range(7)}
    assert found == [
        (i, f"m{i % 7}", sizes[i % 7], last[i % 7] if i == i % 7 else i % 7) for i in range(600)
    ]


def test_no_task_meets_a_hot_key(spark):
    """One address on a third of the rows: its rows are dealt evenly over the tasks of the join."""
    rows = spark.range(0, 60_000, 1, 4).selectExpr("id AS source_row_id", "if(id % 3 = 0, 'hot', concat('m', id div 6)) AS mac")
    counted = rows.groupBy("mac").count().withColumnRenamed("count", "n").where("n > 1")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "50")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        met = salted_lookup(rows, counted, "mac").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(r["count"] for r in met) == 60_000 - 10_000 * 0
    assert max(r["count"] for r in met) < 0.05 * 60_000


def test_payloads_hold_every_row_once(spark, clean):
    copies = clean.union(clean.where("source_row_id = 1"))
    sent = owner_payloads(copies, rows_per_call=4).collect()
    assert all(r.n_rows <= 4 for r in sent) and sum(r.n_rows for r in sent) == 14
    entries = [(k, v) for r in sent for k, v in json.loads(r.payload)["owner"].items()]
    assert sorted(k for k, _ in entries) == sorted([str(r[0]) for r in SAMPLE] + ["1"])
    assert dict(entries)["1"] == "mia" and dict(entries)["4"] is None
    full = [json.loads(r.payload) for r in anomaly_payloads(clean).collect()]
    assert {k: v for p in full for k, v in p["ip_valid"].items()}["2"] is False


def test_ask_and_fall_back(spark, clean):
    def model(payload):
        data = json.loads(payload)
        if "2" in data["owner"]:
            raise TimeoutError("no answer")
        ids = list(data["owner"])
        return json.dumps({
            "owner": {i: "x" for i in ids},
            "owner_team": data["owner_team"],
            "owner_email": data["owner_email"],
            "confidence_percentage": {i: 71 for i in ids},
        })

    replies = ask(owner_payloads(clean.coalesce(1), rows_per_call=3), model).cache()
    assert replies.where("reply IS NULL AND error LIKE '%no answer%'").count() == 1
    merged = {r.source_row_id: r.owner for r in merge_owner(clean, owner_reply_rows(replies)).collect()}
    assert merged[2] == "sec" and merged[1] == "mia" and merged[5] == "x"


def test_replies_with_gaps_and_rubbish(spark):
    texts = [
        '{"owner": {"0": "a", "1": null}, "owner_team": {"0": "t", "1": "u"}, "owner_email": {"0": null, "1": null},'
        ' "confidence_percentage": {"0": 75, "1": 12.5}}',
        '{"owner": {"7": "b"}, "confidence_percentage": {"8": 90}}',
        "I could not do that",
        None,
    ]
    replies = spark.createDataFrame([(t,) for t in texts], "reply string")
    got = sorted(map(tuple, owner_reply_rows(replies, first_row_id=1).collect()))
    assert got == [
        (1, "a", "t", None, 75.0),
        (2, None, "u", None, 12.5),
        (8, "b", None, None, None),
        (9, None, None, None, 90.0),
    ]
    lists = spark.createDataFrame(
        [('[{"source_row_id": 2, "affected_fields": ["ip"], "issue_type": "i", "recommended_action": "drop",'
          ' "anomaly_confidence": 100}]',), ("no list",)],
        "reply string",
    )
    assert [tuple(r) for r in anomaly_reply_rows(lists).collect()] == [(2, ["ip"], "i", "drop", 100)]


def test_no_rules_no_anomalies(spark):
    clean = clean_inventory(fixture.inventory(spark, "/root/testdata/sf0.001"))
    none = detect_anomalies(clean, [])
    assert none.count() == 0 and none.columns == detect_anomalies(clean).columns
