"""Split CSV files against Python's reader of the whole file."""

import csv
import io
import random

import pytest

from netgroom.sources.readers import read_raw
from netgroom.sources.records import header_of, lines_of, open_after, read_records, split_states

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_splits(spark):
    """Splits of a few bytes, so that one file is many tasks."""
    before = {k: spark.conf.get(k) for k in (SPLIT, "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "0")

    def use(n):
        spark.conf.set(SPLIT, str(n))

    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


def plain(text, width):
    """All records of a file by Python's reader, short ones filled up, blank lines left out."""
    rows = [r for r in csv.reader(io.StringIO(text, newline="")) if len(r) > 1 or (r and r[0].strip(" \t"))]
    return [tuple(r + [None] * (width - len(r))) for r in rows[1:]]


def random_file(rng, rows, ends):
    out = ["a,b,c" + ends]
    for _ in range(rows):
        values = []
        for _ in range(rng.randrange(1, 4)):
            text = "".join(rng.choice(['"', "x", ",", "\n", "\r\n", "é", " ", "y" * 20]) for _ in range(rng.randrange(12)))
            kind = rng.randrange(4)
            if kind == 0:
                values.append('"' + text.replace('"', '""') + '"' + rng.choice(["", "", "z", 'z"']))
            elif kind == 1:
                values.append(rng.choice(["5", "x"]) + text.replace(",", "").replace("\n", "").replace("\r", ""))
            else:
                values.append(rng.choice(["", "plain", "1.2.3.4", " "]))
        out.append(",".join(values) + ends)
        if rng.random() < 0.05:
            out.append(ends)
    return "".join(out)


@pytest.mark.parametrize("seed", range(6))
def test_records_equal_those_of_the_whole_file(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    text = random_file(rng, 150, rng.choice(["\n", "\r\n"]))
    (tmp_path / "f.csv").write_bytes(text.encode())
    size = len(text.encode())
    for parts in (1, 3, 17, 60):
        small_splits(size // parts + 1)
        assert lines_of(spark, str(tmp_path), "*.csv").select("start").distinct().count() >= min(parts, 2)
        got = read_records(spark, str(tmp_path), "*.csv", ["a", "b", "c"])
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain(text, 3), key=repr)


def test_one_value_over_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f'line {k}, with "quotes"' for k in range(400))
    rows = [["1", long, "end"], ["2", "short", ""], ["3", long, long]]
    with open(tmp_path / "f.csv", "w", newline="") as f:
        csv.writer(f).writerows([["a", "b", "c"], *rows])
    small_splits(500)
    states = split_states(lines_of(spark, str(tmp_path), "*.csv")).orderBy("start").collect()
    assert len(states) > 40 and sum(r.inside for r in states) > 30
    got = read_records(spark, str(tmp_path), "*.csv", ["a", "b", "c"])
    assert got.rdd.getNumPartitions() > 4
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows))


def test_several_files_each_with_a_header(spark, tmp_path, small_splits):
    for k in range(4):
        (tmp_path / f"{k}.csv").write_text(f'"a\n{"x" * 30}",b\n{k},"v\nw {k}"\n{k},5" rack\n')
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "head.csv").write_text(f'"a\n{"x" * 30}",b\n')
    small_splits(16)
    names = header_of(spark, str(tmp_path / "1.csv"), "*.csv")
    assert names == ["a\n" + "x" * 30, "b"]
    got = sorted(map(tuple, read_records(spark, str(tmp_path), "*.csv", names).collect()))
    assert got == sorted([(str(k), v) for k in range(4) for v in (f"v\nw {k}", '5" rack')])
    with pytest.raises(Exception, match="header of"):
        read_records(spark, str(tmp_path), "*.csv", ["a", "b"]).collect()


@pytest.mark.parametrize("line", ["", "a,b", 'a,"b', '"a""b"', '5" rack', 'x"', '"a"b"', '","', 'a,"",b', '""', '"', '"""', 'a,"b"",c', '"a"",""b"'])
def test_open_quotes_follow_the_reader(line):
    for inside in (False, True):
        start = '"' if inside else ""
        record = next(csv.reader(io.StringIO(f"{start}{line}\n#end", newline="")), [""])
        assert open_after(line, inside) == any("#end" in v for v in record)


def test_lone_quotes_and_breaks_of_an_inventory(spark, tmp_path):
    head = "source_row_id,ip,hostname,fqdn,mac,owner,device_type,site,notes\n"
    (tmp_path / "a.csv").write_text(head + '2,10.0.0.2,5" rack\n3,10.0.0.3,x,,,,,,"two\nlines, ""here"""\n')
    rows = {r.source_row_id: r for r in read_raw(spark, str(tmp_path)).collect()}
    assert rows[2].hostname == '5" rack' and rows[2].notes is None and rows[3].notes == 'two\nlines, "here"'
    (tmp_path / "a.csv").write_text(head + '2,10.0.0.2,5" rack\n')
    assert read_raw(spark, str(tmp_path), multiline=False).first().hostname == '5" rack'
    (tmp_path / "a.csv").write_text(head + '2,"a",b,c,d,e,f,g,h,too,"many"\n')
    with pytest.raises(Exception, match="too many values"):
        read_raw(spark, str(tmp_path)).collect()


def test_splits_stay_the_same_where_few_files_hold_the_breaks(spark, tmp_path):
    """Splits follow from the sizes of all files: the passes must not see different ones."""
    options = {SPLIT: "1m", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in options}
    names, want = ["a", "b"], []
    for f in range(6):
        text = "".join(f'{f * 1000 + k},"{"broken" + (chr(10) + "x") * 40 if f == 1 else "plain"} ""{k}"",{"y" * (k % 3)}"\n' for k in range(400))
        (tmp_path / f"{f}.csv").write_text("a,b\n" + text)
        want += plain("a,b\n" + text, 2)
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        got = read_records(spark, str(tmp_path), "*.csv", names)
        assert sorted(map(tuple, got.collect())) == sorted(want)
        # nor does a table read later, with other options, see other ones
        spark.conf.set(SPLIT, "700")
        assert sorted(map(tuple, got.collect())) == sorted(want)
        assert got.sparkSession is spark
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
