"""Files in and out, the daily run and the stream."""

import json
import os

import pytest
from pyspark.sql import functions as F

from netgroom.operators.clean import clean_inventory
from netgroom.operators.owners import correct_owner
from netgroom.operators.payload import anomaly_reply_rows, owner_reply_rows, unreadable_anomaly_replies, unreadable_owner_replies
from netgroom.operators.starter import starter_anomalies, starter_clean
from netgroom.plans.daily import run_daily, run_starter
from netgroom.session import shared_dir
from netgroom.sources.readers import (
    read_anomalies,
    read_clean,
    read_owner_reply,
    read_proposals,
    read_raw,
)
from netgroom.sources.writers import write_csv, write_json
from netgroom.streaming.ingest import publish_stream, raw_stream

HEADER = "source_row_id,ip,hostname,fqdn,mac,owner,device_type,site,notes\n"
LINES = [
    "1,172.016.3.9,GW01,,0A-0B-0C-0D-0E-0F,mia (sec) mia@lab.example,router,Main Hall,first\n",
    '2,N/A,"gw,02",gw-02.lan,0a0b.0c0d.0e0f,sec,,"say ""hi""",\n',
    "3, 127.0.0.8 ,test,nan,NULL,tom@lab.example,switch,n/a,None\n",
    "\n",
    "4,10.0.0.300\n",
]


def _file(path, text):
    path.write_text(text)
    return str(path)


@pytest.fixture
def raw_file(tmp_path):
    return _file(tmp_path / "raw.csv", HEADER + "".join(LINES))


@pytest.mark.parametrize("multiline", [None, False, True])
def test_read_raw(spark, raw_file, multiline):
    rows = read_raw(spark, raw_file, multiline=multiline).orderBy("source_row_id").collect()
    assert [r.source_row_id for r in rows] == [1, 2, 3, 4]
    assert (rows[1].ip, rows[1].hostname, rows[1].site, rows[1].notes) == (None, "gw,02", 'say "hi"', None)
    assert (rows[2].ip, rows[2].fqdn, rows[2].mac, rows[2].site, rows[2].notes) == (" 127.0.0.8 ", None, None, None, None)
    assert (rows[3].ip, rows[3].hostname, rows[3].notes) == ("10.0.0.300", None, None)


def test_read_raw_keeps_texts_for_the_starter(spark, raw_file):
    raw = read_raw(spark, raw_file, na=False)
    rows = {r.source_row_id: r for r in starter_clean(raw).collect()}
    assert starter_clean(raw).columns[:6] == ["ip", "ip_valid", "ip_version", "subnet_cidr", "normalization_steps", "source_row_id"]
    assert starter_clean(raw).columns[6:] == ["hostname", "fqdn", "mac", "owner", "device_type", "site", "notes"]
    assert tuple(rows["1"])[:5] == ("172.16.3.9", "true", "4", "172.16.3.0/24", "ip_trim|ip_parse|ip_normalize")
    assert tuple(rows["2"])[:5] == ("N/A", "false", "", "", "ip_trim|ip_invalid_wrong_part_count")
    assert rows["3"].fqdn == "nan" and rows["4"].notes == ""
    found = {r.source_row_id: r for r in starter_anomalies(raw).collect()}
    assert set(found) == {"2", "4"}
    assert tuple(found["4"].issues[0]) == ("ip", "octet_out_of_range", "10.0.0.300")


def test_bad_inputs(spark, tmp_path):
    with pytest.raises(ValueError, match="missing path"):
        read_raw(spark, "")
    with pytest.raises(ValueError, match="not a CSV file"):
        read_raw(spark, "/some/file.json")
    with pytest.raises(ValueError, match="columns missing"):
        read_raw(spark, _file(tmp_path / "few.csv", "source_row_id,ip\n1,2\n"))
    broken = _file(tmp_path / "broken.csv", HEADER + '1,1.1.1.1,a,,,,,,"two\nlines"\n')
    with pytest.raises(Exception, match="quoted line break"):
        read_raw(spark, broken, multiline=False).select("ip").collect()
    for multiline in (None, True):
        assert read_raw(spark, broken, multiline=multiline).first().notes == "two\nlines"
    wide = _file(tmp_path / "wide.csv", HEADER + "1,1.1.1.1,a,,,,,,n,too,many\n")
    with pytest.raises(Exception, match="too many values"):
        read_raw(spark, wide).select("ip").collect()


def test_directory_of_files(spark, tmp_path):
    _file(tmp_path / "a.csv", HEADER + LINES[0])
    _file(tmp_path / "b.CSV", HEADER + LINES[2])
    _file(tmp_path / "c.txt", "not an inventory\n")
    assert read_raw(spark, str(tmp_path)).count() == 2
    _file(tmp_path / "d.csv", "ip,source_row_id,hostname,fqdn,mac,owner,device_type,site,notes\n1.1.1.1,9,,,,,,,\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw(spark, str(tmp_path)).collect()


def test_columns_in_another_order(spark, tmp_path):
    path = _file(tmp_path / "o.csv", "ip,source_row_id,notes,hostname,fqdn,mac,owner,device_type,site,extra\n1.1.1.1,9,,h,,,,,,e\n")
    row = read_raw(spark, path).first()
    assert (row.source_row_id, row.ip, row.hostname, row.extra) == (9, "1.1.1.1", "h", "e")


def test_clean_csv_round_trip(spark, raw_file, tmp_path):
    cleaned = clean_inventory(read_raw(spark, raw_file))
    assert write_csv(cleaned, str(tmp_path / "out")) == 4
    back = read_clean(spark, str(tmp_path / "out"))
    assert back.schema.simpleString() == cleaned.schema.simpleString()
    null_subnet = cleaned.withColumn("subnet_cidr", F.when(F.col("subnet_cidr") != "", F.col("subnet_cidr")))
    key = lambda r: r.source_row_id
    assert sorted(back.collect(), key=key) == sorted(null_subnet.collect(), key=key)


def test_clean_csv_of_other_writers(spark, tmp_path):
    steps = "[{'field': 'ip', 'from': nan, 'to': None, 'reason': 'missing'}, {'field': 'site', 'from': \"it's\", 'to': 'it', 'reason': 'x'}]"
    names = ["ip", "ip_valid", "ip_type", "subnet_cidr", "hostname", "hostname_valid", "fqdn", "fqdn_consistent",
             "reverse_ptr", "mac", "mac_valid", "owner", "owner_email", "owner_team", "device_type",
             "device_type_confidence", "site", "site_normalized", "source_row_id", "normalization_steps"]
    values = ["", "False", "invalid", "", "h", "True", "", "inconsistent", "", "", "False", "", "", "", "unknown", "0", "it's", "it", "7"]
    quoted = '"' + steps.replace('"', '""') + '"'
    path = _file(tmp_path / "c.csv", ",Unnamed: 0," + ",".join(names) + "\n0,0," + ",".join(values) + "," + quoted + "\n")
    row = read_clean(spark, path).first()
    assert (row.source_row_id, row.ip_valid, row.hostname_valid, row.device_type_confidence, row.ip) == (7, False, True, 0, None)
    assert [tuple(s) for s in row.normalization_steps] == [("ip", None, None, "missing"), ("site", "it's", "it", "x")]


def test_reply_and_anomaly_files(spark, tmp_path):
    reply = {"owner": {"0": "a"}, "owner_team": {"0": None}, "owner_email": {"0": "e"}, "confidence_percentage": {"0": 100}}
    rows = read_owner_reply(spark, _file(tmp_path / "r.json", json.dumps(reply, indent=1)), first_row_id=1)
    assert [tuple(r) for r in rows.collect()] == [(1, "a", None, "e", 100.0)]
    write_json(rows, str(tmp_path / "proposals"))
    assert [tuple(r) for r in read_proposals(spark, str(tmp_path / "proposals")).collect()] == [(1, "a", None, "e", 100.0)]
    record = {"source_row_id": 3, "affected_fields": ["ip"], "issue_type": "i", "recommended_action": "drop", "anomaly_confidence": 9}
    listed = read_anomalies(spark, _file(tmp_path / "a.json", json.dumps([record], indent=1)))
    assert [tuple(r) for r in listed.collect()] == [(3, ["ip"], "i", "drop", 9)]


def test_daily_run(spark, raw_file, tmp_path):
    work, out = str(tmp_path / "work"), str(tmp_path / "out")
    for _ in range(2):  # a repeated run replaces the first
        done = run_daily(spark, raw_file, out, "2025-11-04", work)
    assert (done.rows, done.unknown_proposals) == (4, 0)
    assert done.inventory == f"{out}/run_date=2025-11-04/inventory_clean"
    owners = {r.source_row_id: (r.owner, r.owner_team) for r in read_clean(spark, done.inventory).collect()}
    assert owners[2] == (None, "sec") and owners[3] == ("tom", None)
    found = read_anomalies(spark, done.anomalies, as_list=False)
    assert sorted((r.source_row_id, r.recommended_action, r.anomaly_confidence) for r in found.collect()) == [
        (1, "modify", 90), (2, "drop", 100), (2, "modify", 90), (3, "modify", 80), (4, "drop", 100),
    ]


def test_starter_run(spark, raw_file, tmp_path):
    done = run_starter(spark, raw_file, str(tmp_path / "o"), "2025-11-04")
    assert done.rows == 4
    published = spark.read.option("header", True).csv(done.inventory)
    assert published.columns[:6] == ["ip", "ip_valid", "ip_version", "subnet_cidr", "normalization_steps", "source_row_id"]
    records = spark.read.json(done.anomalies).orderBy("source_row_id").collect()
    assert [(r.source_row_id, r.issues[0].type, r.issues[0].value) for r in records] == [
        ("2", "wrong_part_count", "N/A"), ("4", "octet_out_of_range", "10.0.0.300"),
    ]


def test_daily_run_with_models_and_failures(spark, raw_file, tmp_path):
    def down(payload):
        raise ConnectionError("down")

    def finder(payload):
        ids = json.loads(payload)["source_row_id"]
        return json.dumps([
            {"source_row_id": int(i), "affected_fields": ["ip"], "issue_type": "odd", "recommended_action": "drop",
             "anomaly_confidence": 50} for i in ids
        ])

    done = run_daily(spark, raw_file, str(tmp_path / "o"), "2025-11-05", str(tmp_path / "w"), owner_model=down, anomaly_model=finder)
    owners = {r.source_row_id: r.owner for r in read_clean(spark, done.inventory).collect()}
    assert owners[2] == "sec" and done.rows == 4
    assert read_anomalies(spark, done.anomalies, as_list=False).count() == 4
    proposals = spark.createDataFrame(
        [(1, "zoe", None, None, 99.0), (77, "ghost", None, None, 99.0)],
        "source_row_id long, owner string, owner_team string, owner_email string, confidence_percentage double",
    )
    done = run_daily(spark, raw_file, str(tmp_path / "o"), "2025-11-06", str(tmp_path / "w"), proposals=proposals, find_anomalies=None)
    assert (done.anomalies, done.unknown_proposals) == (None, 1)
    assert {r.source_row_id: r.owner for r in read_clean(spark, done.inventory).collect()}[1] == "zoe"
    done = run_daily(spark, raw_file, str(tmp_path / "o"), "2025-11-07", str(tmp_path / "w"), anomaly_model=down)
    assert (done.anomalies, done.rows, done.unreadable_replies) == (None, 4, 1)


def test_unreadable_replies_are_found(spark):
    record = '{"source_row_id": "7", "affected_fields": ["ip"], "issue_type": "odd", "recommended_action": "drop", "anomaly_confidence": %s}'
    good = [f"[{record % c}]" for c in ("95", "95.0", '"95"')] + ["[]"]
    bad = ["all is well", f"[{record % 95}"[:-1], '{"anomalies": [%s]}' % (record % 95), '[{"issue_type": "odd"}]', None]
    replies = spark.createDataFrame([(r,) for r in good + bad], "reply string")
    assert {r.reply for r in unreadable_anomaly_replies(replies).collect()} == set(bad)
    rows = anomaly_reply_rows(spark.createDataFrame([(r,) for r in good], "reply string")).collect()
    assert [(r.source_row_id, r.anomaly_confidence) for r in rows] == [(7, 95)] * 3
    owners = ['{"owner": {"1": "zoe"}, "confidence_percentage": {"1": "90"}}', "no", '{"owner"', None]
    replies = spark.createDataFrame([(r,) for r in owners], "reply string")
    assert {r.reply for r in unreadable_owner_replies(replies).collect()} == set(owners[1:])
    assert [(r.source_row_id, r.owner, r.confidence_percentage) for r in owner_reply_rows(replies).collect()] == [(1, "zoe", 90.0)]


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        assert shared_dir(spark) == folder.rstrip("/")
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(spark)


def test_stream_equals_batch(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    _file(source / "a.csv", HEADER + LINES[0] + LINES[1])
    _file(source / "b.CSV", HEADER + LINES[2])
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")

    def run():
        query = publish_stream(raw_stream(spark, str(source), files_per_batch=1), out, "2025-11-04", mark)
        query.awaitTermination()

    run()
    _file(source / "c.csv", HEADER + LINES[4])
    run()
    run()  # nothing new
    streamed = spark.read.parquet(f"{out}/inventory_clean/run_date=2025-11-04").drop("batch")
    batch = correct_owner(clean_inventory(read_raw(spark, str(source))))
    key = lambda r: r.source_row_id
    assert sorted(streamed.collect(), key=key) == sorted(batch.collect(), key=key)
    assert len([d for d in os.listdir(f"{out}/inventory_clean/run_date=2025-11-04") if d.startswith("batch=")]) == 3
