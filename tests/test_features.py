"""History, entity classes, prefixes and spelling against plain versions."""

import ipaddress
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from netgroom.functions.device import EXACT, clean_device_type
from netgroom.operators.entities import device_classes
from netgroom.operators.history import as_of, extend_history, history, snapshot_at, snapshot_diff
from netgroom.operators.prefixes import cidr_cover, longest_prefix
from netgroom.operators.spelling import deletions, guess_device_type, nearest_names
from netgroom.plans import features

STATE = "run_date string, id long, owner string, site string"


def snapshots(rng, runs):
    out = []
    for k in range(runs):
        for i in range(12):
            if rng.random() < 0.7:
                out += [(f"d{k}", i if i else None, rng.choice(["a", "b"]), rng.choice(["x", None]))] * rng.choice([1, 1, 1, 2])
            if rng.random() < 0.2:
                out.append((f"d{k}", i, "twin", None))
    return out


def plain_history(rows, dates):
    states = defaultdict(dict)
    for date in dates:
        for state, n in Counter(r[1:] for r in rows if r[0] == date).items():
            states[(*state, n)][date] = True
    out = Counter()
    for state, shown in states.items():
        begun = None
        for k, date in enumerate([*dates, None]):
            if date in shown and begun is None:
                begun = k
            elif begun is not None and date not in shown:
                out[(*state, dates[begun], date, k - begun)] += 1
                begun = None
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_history_and_its_extension(spark, seed):
    rng = random.Random(seed)
    rows = snapshots(rng, 6)
    dates = [f"d{k}" for k in range(6)]
    frame = spark.createDataFrame(rows, STATE)
    want = plain_history(rows, dates)
    shape = lambda df: Counter(tuple(r) for r in df.select("id", "owner", "site", "copies", "valid_from", "valid_to", "runs").collect())
    assert shape(history(frame, "id", ["owner", "site"])) == want
    known = history(frame.where("run_date < 'd3'"), "id", ["owner", "site"])
    for date in dates[3:]:
        known = extend_history(known, frame.where(F.col("run_date") == date), date, "id", ["owner", "site"])
    assert shape(known) == want
    shown = snapshot_at(known, "d4").select("id", "owner", "site", "copies").collect()
    assert Counter(map(tuple, shown)) == Counter((*state, n) for state, n in Counter(r[1:] for r in rows if r[0] == "d4").items())
    lookups = [(k, rng.choice([None, 1, 2, 3, 99]), f"d{rng.randrange(8)}") for k in range(80)]
    got = as_of(known, spark.createDataFrame(lookups, "k long, id long, at string"), "id", "at").select("k", "owner", "site", "copies")
    held = Counter()
    for k, i, at in lookups:
        fits = [s for s in want if i is not None and s[0] == i and s[4] <= at and (s[5] is None or at < s[5])]
        for s in fits or [(None,) * 4]:
            held[k, s[1], s[2], s[3]] += 1
    assert Counter(map(tuple, got.collect())) == held


def test_difference_of_two_snapshots(spark):
    rng = random.Random(3)
    old, new = ([r[1:] for r in snapshots(rng, 1)] for _ in range(2))
    old.append((50, "a", "x"))
    new.append((51, "a", "x"))
    old.append((52, "a", "x"))
    new.append((52, "a", None))
    schema = "id long, owner string, site string"
    got = {r.id: (r.change, r.changed_fields, r.rows_old, r.rows_new) for r in snapshot_diff(*(spark.createDataFrame(x, schema) for x in (old, new)), "id", ["owner", "site"]).collect()}
    want = {}
    for key in {r[0] for r in old + new}:
        a, b = (Counter(r[1:] for r in side if r[0] == key) for side in (old, new))
        gone, come = a - b, b - a
        n, m = sum(gone.values()), sum(come.values())
        if n or m:
            fields = None
            if n == m == 1:
                was, now = next(iter(gone)), next(iter(come))
                fields = [c for c, x, y in zip(("owner", "site"), was, now) if x != y]
            want[key] = ("added" if not n else "removed" if not m else "changed", fields, n, m)
    assert got == want and got[50][0] == "removed" and got[51][0] == "added" and got[52] == ("changed", ["site"], 1, 1)
    empty = spark.createDataFrame([], schema)
    assert snapshot_diff(empty, empty, "id", ["owner", "site"]).count() == 0


DEVICE = "source_row_id long, mac string, ip string, ip_valid boolean, ip_type string, fqdn string"


def plain_classes(rows):
    parent = {r[0]: r[0] for r in rows if r[0] is not None}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    seen = {}
    for i, mac, ip, valid, kind, fqdn in rows:
        if i is None:
            continue
        values = [("m", mac)] * (mac is not None) + [("i", ip)] * bool(valid and kind == "private_rfc1918") + [("f", fqdn)] * bool(fqdn and "." in fqdn)
        for value in values:
            a, b = sorted((top(i), top(seen.setdefault(value, i))))
            parent[b] = a
    return {i: top(i) for i in parent}


@pytest.mark.parametrize("kind", ["random", "chain", "hot"])
def test_classes_of_rows_that_share_values(spark, kind):
    rng = random.Random(kind)
    if kind == "chain":  # every row shares one value with the next, in an order without a pattern
        order = rng.sample(range(300), 300)
        rows = [(i, f"m{k // 2}", f"10.{(k + 1) // 2}", True, "private_rfc1918", None) for k, i in enumerate(order)]
    else:
        hot = kind == "hot"
        rows = [
            (rng.choice([None, rng.randrange(400)]) if k % 20 == 0 else k, rng.choice([None, f"m{rng.randrange(250)}"]), f"10.{rng.randrange(200)}", rng.random() < 0.3,
             rng.choice(["private_rfc1918", "loopback"]), "all.lan" if hot and k % 3 == 0 else rng.choice([None, "nolabel", f"h{rng.randrange(300)}.lan"]))
            for k in range(400)
        ]
    got = device_classes(spark.createDataFrame(rows, DEVICE)).collect()
    want = plain_classes(rows)
    assert {r.source_row_id: r.class_id for r in got} == want and len(got) == len(want)
    sizes = Counter(want[r[0]] for r in rows if r[0] is not None)
    assert all(r.class_rows == sizes[r.class_id] for r in got)


def test_rows_that_share_nothing(spark):
    rows = [(k, None, None, False, None, None) for k in range(3)] + [(None, "m", None, False, None, None)]
    assert sorted(map(tuple, device_classes(spark.createDataFrame(rows, DEVICE)).collect())) == [(0, 0, 1), (1, 1, 1), (2, 2, 1)]
    assert device_classes(spark.createDataFrame([], DEVICE)).count() == 0


def test_longest_prefix_of_an_address(spark):
    rng = random.Random(4)
    nets = ["0.0.0.0/0", "10.0.0.0/8", "10.1.0.0/16", "10.1.2.0/23", "10.1.2.3/32", "10.1.2.3/31", "192.0.0.0/3", "172.16.0.0/12", "9.255.0.0/7"]
    nets += [f"{rng.choice([10, 11, 192])}.{rng.randrange(4)}.{rng.randrange(4)}.{rng.randrange(256)}/{rng.randrange(6, 33)}" for _ in range(60)]
    bad = ["10.0.0.0/33", "10.0.0/8", "x", None, "256.0.0.0/8", "10.0.0.0/", "/8", "10.0.0.0/08"]
    for given in (nets, nets[1:]):
        table = spark.createDataFrame([(n, f"z{k}") for k, n in enumerate([*given, *bad])], "prefix string, zone string")
        ips = ["10.1.2.3"] * 50 + [f"{rng.choice([9, 10, 11, 172, 192, 250])}.{rng.randrange(32)}.{rng.randrange(5)}.{rng.randrange(256)}" for _ in range(300)] + [None, "x", "1.2.3", "10.1.2.300"]
        got = longest_prefix(spark.createDataFrame(list(enumerate(ips)), "id long, ip string"), table).collect()
        assert len(got) == len(ips)
        parsed = [(ipaddress.ip_network(n, strict=False), n, f"z{k}") for k, n in enumerate(given)]
        for r in got:
            try:
                a = ipaddress.ip_address(r.ip or "")
                fits = [(-net.prefixlen, n, z) for net, n, z in parsed if a in net]
            except ValueError:
                fits = []
            assert (r.prefix, r.zone) == (min(fits)[1:] if fits else (None, None)), r
    nothing = longest_prefix(spark.createDataFrame([(1, "10.0.0.1")], "id long, ip string"), table.where("false"))
    assert tuple(nothing.first()) == (1, "10.0.0.1", None, None)


def test_cover_equals_collapsed_networks(spark):
    rng = random.Random(5)
    numbers = {rng.randrange(1 << 12) + (10 << 24) for _ in range(3000)} | set(range((10 << 24) + 65_000, (10 << 24) + 200_000)) | {0, 1, (1 << 32) - 1}
    numbers |= set(range((11 << 24) - 70_000, (11 << 24) + 3))
    texts = [str(ipaddress.ip_address(n)) for n in numbers] + ["x", None, "1.1.1.1", "1.1.1.1"]
    got = cidr_cover(spark.createDataFrame([(t,) for t in texts], "ip string")).collect()
    want = {str(n) for n in ipaddress.collapse_addresses([ipaddress.ip_network(n) for n in numbers] + [ipaddress.ip_network("1.1.1.1")])}
    assert {r.prefix for r in got} == want and len(got) == len(want)
    assert all(r.addresses == ipaddress.ip_network(r.prefix).num_addresses and r.length == ipaddress.ip_network(r.prefix).prefixlen for r in got)
    assert cidr_cover(spark.createDataFrame([], "ip string")).count() == 0


def edits(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def test_nearest_names_equal_all_distances(spark):
    rng = random.Random(6)
    names = list(EXACT)
    texts = set()
    for _ in range(250):
        t = list(rng.choice(names))
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(t) + 1)
            t[k : k + rng.randrange(2)] = rng.choice([[], [rng.choice("aeinrst")]])
        texts.add("".join(t))
    texts |= {"", "a", "ups", "upz", "x" * 200, "ééééé"}
    got = {r.text: (r.name, r.distance) for r in nearest_names(spark.createDataFrame([(t,) for t in texts], "text string"), names).collect()}
    want = {}
    for t in texts:
        near = [(d, k, n) for k, n in enumerate(names) for d in [edits(t, n)] if d == 0 or (d == 1 and len(t) >= 4) or (d == 2 and len(t) >= 6)]
        if near:
            d, _, n = min(near)
            want[t] = (n, d)
    assert got == want


def test_deletions_and_guesses(spark):
    parts = spark.createDataFrame([("abc",), ("",)], "t string").select(deletions(F.col("t")).alias("d")).collect()
    assert set(parts[0].d) == {"abc", "bc", "ac", "ab", "a", "b", "c"} and set(parts[1].d) == {""}
    rows = [(1, "swtich"), (2, None), (3, "Routr "), (4, "switch"), (5, "zzz"), (6, ""), (7, "core sw")]
    fields = clean_device_type(spark.createDataFrame(rows, "source_row_id long, device_type string"))
    got = {r.source_row_id: (r.device_type_clean, r.device_type_confidence, r.device_type_reason) for r in guess_device_type(fields).collect()}
    assert got == {
        1: ("switch", 60, "misspelt_2"), 2: ("unknown", 0, "missing"), 3: ("router", 80, "misspelt_1"), 4: ("switch", 100, "exact_match"),
        5: ("unknown", 0, "no_match"), 6: ("unknown", 0, "empty_string"), 7: ("switch", 90, "fuzzy_match"),
    }
    assert guess_device_type(fields).columns == fields.columns


def test_rules_that_the_table_shows(spark):
    from netgroom.operators.mined import Dependency, dependency_violations, mine_dependencies

    rows = [(k, "a", "x" if k else "y") for k in range(20)] + [(100 + k, "b", "z") for k in range(4)] + [(200 + k, "c", "x" if k % 2 else "y") for k in range(10)]
    rows += [(300, None, "x"), (301, "a", None), (302, "a", ""), (303, "unknown", "x")]
    frame = spark.createDataFrame(rows, "source_row_id long, g string, t string")
    rule = [Dependency("g", "t", "t")]
    assert [tuple(r) for r in mine_dependencies(frame, rule).collect()] == [("g -> t", 2, 30, 24, 6, 80)]
    found = dependency_violations(frame, rule).collect()
    assert [(r.source_row_id, r.affected_fields, r.recommended_action, r.anomaly_confidence) for r in found] == [(0, ["t"], "modify", 95)]
    assert found[0].issue_type == "t is y where 19 of 20 rows with a have x"
    hot = spark.range(5000).selectExpr("id AS source_row_id", "'h' AS g", "if(id = 7, 'odd', 'even') AS t")
    assert [r.source_row_id for r in dependency_violations(hot, rule).collect()] == [7]
    assert mine_dependencies(frame.where("false"), rule).count() == 0 and dependency_violations(frame.where("false"), rule).count() == 0


def test_teams_learned_from_known_rows(spark):
    import math

    from netgroom.operators.learned import HELD_OUT, STEPS, WEIGHT, learn_owner

    rng = random.Random(7)
    rows = []
    for k in range(600):
        t = rng.randrange(4)
        team = f"t{t}" if rng.random() < 0.8 else None
        rows.append((k, team, None, None, f"s{t}" if rng.random() < 0.8 else rng.choice(["s0", "s1", "unknown", None]), rng.choice([f"d{t % 2}", "d9"]), "", f"h{'abcd'[t]}{k}" if rng.random() < 0.5 else None))
    schema = "source_row_id long, owner_team string, owner string, owner_email string, site_normalized string, device_type string, subnet_cidr string, hostname string"
    got = {r.source_row_id: (r.owner_team, r.confidence_percentage) for r in learn_owner(spark.createDataFrame(rows, schema)).collect()}

    def values(r):
        host = "".join(c for c in (r[7] or "") if c.isalpha())
        return [(n, v) for n, v in enumerate((r[4], r[5], r[6], host)) if v and v != "unknown"]

    train = [r for r in rows if r[1] and r[0] % HELD_OUT]
    share = {t: n / len(train) for t, n in Counter(r[1] for r in train).items()}
    beside = Counter((v, r[1]) for r in train for v in values(r))

    def best(r):
        score = defaultdict(float)
        for v in values(r):
            for t in share:
                if beside[v, t]:
                    score[t] += math.log((beside[v, t] + WEIGHT * share[t]) / (WEIGHT * share[t]))
        ranked = sorted((-round(s + math.log(share[t]), 6), t) for t, s in score.items())
        if not ranked:
            return None
        return ranked[0][1], min(int(round(ranked[1][0] - ranked[0][0] if len(ranked) > 1 else STEPS, 6)), STEPS - 1)

    steps = defaultdict(lambda: [0, 0])
    for r in rows:
        if r[1] and r[0] % HELD_OUT == 0 and best(r):
            t, step = best(r)
            steps[step][0] += 1
            steps[step][1] += t == r[1]
    want = {}
    for r in rows:
        if r[1] is None and best(r):
            t, step = best(r)
            n, right = steps.get(step, (0, 0))
            want[r[0]] = (t, float((right + 1) * 100 // (n + 2)))
    assert got == want and len({c for _, c in got.values()}) > 1


def test_csv_of_documents_without_ids(spark, tmp_path):
    """Rows without an id come back from the CSV file without one, as in the SQL."""
    rows = [(None, "a\nb", "en", None), (None, None, None, "web"), (3, 'x "y",\n', "de", "")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = features.q_csv_quoted_breaks(spark, str(tmp_path)).select("source_row_id", "ip", "hostname", "mac", "owner", "site", "n_chars").collect()
    want = [(None, None, None, "", "", "web", 0), (None, None, None, "", "en", "", 3), (3, "10.0.3.7", "doc-3", "", "de", "", 7)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_tasks_of_a_history_grow_with_its_rows(spark, monkeypatch):
    """A task has about ``ROWS`` rows at any number of shuffle partitions, and the results do not depend on it."""
    rows = snapshots(random.Random(3), 5) + [(f"d{k}", None, "hot", None) for k in range(5) for _ in range(200)]
    dates = sorted({r[0] for r in rows})
    frame, want = spark.createDataFrame(rows, STATE), plain_history(rows, dates)

    def shape(df):
        return Counter(tuple(r) for r in df.select("id", "owner", "site", "copies", "valid_from", "valid_to", "runs").collect())

    monkeypatch.setattr("netgroom.operators.history.ROWS", 50)
    known = history(frame, "id", ["owner", "site"])
    assert len(rows) // 50 < known.rdd.getNumPartitions() <= len(rows) // 50 + 1
    assert shape(known) == want
    last = frame.where(F.col("run_date") == dates[-1])
    grown = extend_history(history(frame.where(F.col("run_date") < dates[-1]), "id", ["owner", "site"]), last, dates[-1], "id", ["owner", "site"], tasks=13)
    assert shape(grown) == want
    lookups = spark.createDataFrame([(k, k % 12, f"d{k % 5}") for k in range(60)], "k long, id long, at string")
    few, many = (Counter(map(tuple, as_of(known, lookups, "id", "at", t).collect())) for t in (1, 17))
    assert few == many
