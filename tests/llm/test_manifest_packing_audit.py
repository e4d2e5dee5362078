import array
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from compare import connect, rows_of, rows_of_sql
from netgroom.llm.divergence import Levels, audit_sources, cross
from netgroom.llm.merkle import merkle_proofs, paths
from netgroom.llm.packing import Bins, Encoder, lengths, pack
from netgroom.llm.ranking import numbered
from netgroom.llm.registry import ORACLE_SQL, QUERIES
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, idx long, sources string"


def table_of(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, "x", 7, "y") for r in rows], DOCS)


@pytest.mark.parametrize("name", ["op11_merkle", "op13_divergence"])
def test_query_equals_sql(spark, name):
    _, got = rows_of(QUERIES[name](spark, SMALL))
    _, want, _ = rows_of_sql(connect(SMALL), ORACLE_SQL[name])
    assert got == want


@pytest.mark.parametrize("name", ["op11_merkle", "op12_packing", "op13_divergence"])
def test_empty_table(spark, name, tmp_path):
    spark.read.parquet(f"{SMALL}/documents.parquet").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == 0


def test_numbers_of_rows(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None, ""]) if k % 3 else "hot", rng.randrange(50)) for k in range(3000)] + [("alone", 1)]
    got = numbered(spark.createDataFrame(rows, "g string, x long").repartition(7), ["g"], [F.col("x").desc()]).collect()
    by = defaultdict(list)
    for r in got:
        by[r.g].append(r)
    assert Counter((r.g, r.x) for r in got) == Counter(rows)
    for members in by.values():
        assert sorted(r.idx for r in members) == list(range(len(members))) and {r.group_rows for r in members} == {len(members)}
        assert [r.x for r in sorted(members, key=lambda r: r.idx)] == sorted((r.x for r in members), reverse=True)
    assert numbered(spark.createDataFrame([], "g string, x long"), ["g"], [F.col("x")]).count() == 0


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows, arity=3):
    """Leaves, subroots, root and proofs by plain lists."""

    def leaf(values):
        return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def climb(level):
        ways = [[] for _ in level]
        under = [[k] for k in range(len(level))]
        while len(level) > 1:
            runs = [range(k, min(k + arity, len(level))) for k in range(0, len(level), arity)]
            for run in runs:
                for at in run:
                    for k in under[at]:
                        ways[k].append(([level[x] for x in run if x < at], [level[x] for x in run if x > at]))
            under = [[k for at in run for k in under[at]] for run in runs]
            level = [sha(*(level[at] for at in run)) for run in runs]
        return level[0], ways

    groups = defaultdict(list)
    for doc_id, text, lang, source, n in rows:
        even = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
        changed = text.replace("\n", "") if even and text is not None else text
        groups[source].append((doc_id, leaf((doc_id, source, lang, n, text)), leaf((doc_id, source, lang, n, changed))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[s] = climb([r[1] for r in groups[s]])
    root, tops = climb([trees[s][0] for s in names])
    out = Counter()
    for s, top in zip(names, tops):
        for (doc_id, own, start), way in zip(groups[s], trees[s][1]):
            folded, siblings = start, []
            for left, right in way + top:
                folded = sha(*left, folded, *right)
                siblings += left + right
            out[doc_id, own, trees[s][0], root, sha(*siblings), folded, folded == root] += 1
    return out


@pytest.mark.parametrize("step", [1, 2, 6])
def test_manifest_equals_plain_lists(spark, step):
    rng = random.Random(step)
    sources = ["hot"] * 40 + ["é", "z", None, "", "Z", *(f"s{k}" for k in range(11))]
    rows = [(k, f"line {k}\nnext" if k % 3 else "no line", rng.choice(["en", None]), rng.choice(sources), k * 3) for k in range(300)]
    rows += [(7, "same", "en", "hot", 4)] * 5 + [(7, "other\n", "en", "hot", 4), (None, None, None, None, None), (None, "\n", "x", "hot", -5)]
    rows += [(10**12, "long\n" * 50_000, "en", "lone", 1), (-3, "", "", "z", 0)]
    text = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    got = merkle_proofs(table_of(spark, rows), ["doc_id", "source", "lang", "n_chars", "text"], "source", "doc_id", {"text": text}, step=step).collect()
    shown = Counter(
        (r.doc_id, r.leaf.hex(), r.subroot.hex(), r.root.hex(), sha(bytes(r.siblings).hex()), r.folded_root.hex(), r.verified) for r in got
    )
    assert shown == brute_manifest(rows)


def test_manifest_of_one_leaf_and_of_lone_sources(spark):
    for rows in ([(1, "a\n", "en", "s", 2)], [(k, "a", "en", f"s{k}", 1) for k in range(5)]):
        got = proofs_of(spark, rows)
        assert got == brute_manifest(rows)


def proofs_of(spark, rows):
    text = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    got = merkle_proofs(table_of(spark, rows), ["doc_id", "source", "lang", "n_chars", "text"], "source", "doc_id", {"text": text}).collect()
    return Counter((r.doc_id, r.leaf.hex(), r.subroot.hex(), r.root.hex(), sha(bytes(r.siblings).hex()), r.folded_root.hex(), r.verified) for r in got)


def test_recursion_setting_is_restored(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    QUERIES["op11_merkle"](spark, SMALL).count()
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before


def test_paths_of_a_block():
    ways, top = paths([bytes([k]) for k in range(4)], 2)
    first = hashlib.sha256("".join(f"{k:02x}" for k in range(3)).encode()).digest()
    lone = hashlib.sha256(b"03").digest()
    assert ways[3] == [{"l": b"", "r": b""}, {"l": first, "r": b""}] and ways[1] == [{"l": b"\0", "r": b"\2"}, {"l": b"", "r": lone}]
    assert top == hashlib.sha256((first.hex() + lone.hex()).encode()).digest()


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


def test_segments_have_the_ids_of_the_library():
    rng, model, encoder = random.Random(2), library(), Encoder(WORDS)
    letters = list("abcDEF'st019 \t\n.,!?$%&-_") + ["\x1c", "\x85", "\xa0", "é", "É", "ß", "ẞ", "İ", "Σ", "ς", "ﬁ", "한", "가", "日", "́", "̸", "=", "½", "３", "😀", "ǅ", "'re ", "<|endoftext|>"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(3000)] + ["", " ", "x" * 5000, "word " * 3000]
    for text in texts:
        assert array.array("I", encoder.encode(text)).tolist() == model.encode(text, add_special_tokens=False).ids, text


def check_packing(rows, pieces, capacity, end=2):
    model = library()
    ids = {i: [*model.encode(t or "", add_special_tokens=False).ids, end] for i, t in rows}
    seen, sequences = defaultdict(dict), defaultdict(list)
    for r in pieces:
        own = array.array("I", r.ids).tolist()
        assert own and len(own) == r.length and r.doc_tokens == len(ids[r.doc_id]) and own == ids[r.doc_id][r.start : r.start + r.length]
        seen[r.doc_id][r.start] = r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, parts in seen.items():
        at = 0
        while at in parts:
            at += parts[at]
        assert at == len(ids[i])
    assert set(seen) == set(ids)
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert 0 < at <= capacity
        padding += capacity - at if at & (at - 1) else 0
    return padding / sum(map(len, ids.values()))


@pytest.mark.parametrize("capacity,parts", [(4096, 1), (4096, 5), (64, 3), (1, 1)])
def test_packing_keeps_every_id_once(spark, capacity, parts):
    rng = random.Random(capacity + parts)
    rows = [(k, " ".join(rng.choice(["an", "old", "zebra", "x1", "!?"]) for _ in range(int(rng.paretovariate(0.6)) % 9000))) for k in range(120)]
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "word " * 4095), (1004, "word " * 4096), (1005, "word " * 20_000)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, start long, ids string").repartition(parts)
    share = check_packing(rows, pack(frame, WORDS, capacity).collect(), capacity)
    assert share < 0.001 if capacity == 4096 else share <= 1 / 63


def test_packing_of_repeated_and_absent_ids(spark):
    frame = spark.createDataFrame([(1, "one two"), (1, "one two"), (None, "three"), (None, None)], "doc_id long, text string").coalesce(1)
    got = pack(frame, WORDS).collect()
    assert sorted((r.doc_id or 0, r.doc_tokens) for r in got if r.start == 0) == [(0, 1), (0, 2), (1, 3), (1, 3)]


def test_classes_hold_a_fixed_count():
    cut = lengths()
    assert cut[4096] == 4096 and cut[4095] == 4095 and cut[3000] == 2048 and cut[1] == 1 and all(0 < cut[n] <= n for n in range(1, 4097))
    assert all(4096 % s <= 1 for s in cut[1:])
    bins = Bins(0)
    out = [r for k in range(4) for r in bins.add(k, bytes(4 * 1024))]
    assert [(r[0], r[5], r[6]) for r in out] == [(0, 0, 0), (1, 0, 1024), (2, 0, 2048), (3, 0, 3072)]
    with pytest.raises(ValueError):
        pack(None, WORDS, 1000)


def test_packing_query_returns_checksums(spark):
    got = QUERIES["op12_packing"](spark, SMALL)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    model, texts = library(), {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in got.collect():
        ids = [*model.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def brute_audit(rows, least=10, top=10):
    import re

    words = lambda t: re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    docs, count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        docs[lang].update(set(words(text)))
        count[lang, source].update(words(text))
    out = Counter()
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        v = len(kept)

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * v) for t in kept}

        f = lambda p, q: (p - q) * (p - q) // (p + q)
        p = {s: shares(count[lang, s]) for s in sources}
        q = shares(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pair = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s)
            term = sorted((-f(p[s][t], q[t]), t.encode(), t) for t in kept if count[lang, s][t] and p[s][t] > q[t])[:top]
            for part, found in (("pair", pair), ("term", term)):
                for rank, (value, _, item) in enumerate(found, 1):
                    out[lang, s, part, item, -value, rank] += 1
    return out


def test_audit_equals_plain_counts(spark, monkeypatch):
    import netgroom.llm.divergence as d

    monkeypatch.setattr(d, "BITS", 64)
    monkeypatch.setattr(d, "TILE", 3)
    monkeypatch.setattr(d, "GATHER", 200)
    rng = random.Random(5)
    vocabulary = [f"{a}{b}" for a in "abcdefgh" for b in ["", "x", "é", "Ö", "日本"]] + ["The", "THE", "the"] * 9
    sources = ["hot"] * 20 + [None, "", "é", "Z", "a", *(f"s{k}" for k in range(9))]
    rows = [
        (k, " ".join(rng.choice(vocabulary) + rng.choice(["", "1", "_", "-"]) for _ in range(rng.randrange(60))), rng.choice(["en", "de", None, "rare"] + ["en"] * 5), rng.choice(sources), 0)
        for k in range(700)
    ]
    rows += [(1, None, "en", "silent", 0), (2, "", "en", "silent", 0), (3, "1 2 3", "none", "a", 0), (4, "x", "none", "b", 0), (5, "ab " * 30_000, "en", "long", 0)]
    rows += [(6, "twin same", "en", "s1", 0)] * 12
    got = Counter((r.lang, r.source, r.part, r["item"], r.value, r.rank) for r in audit_sources(table_of(spark, rows)).collect())
    assert got == brute_audit(rows)


def test_crossed_bitmaps_equal_single_terms():
    rng, size = random.Random(6), 4096
    for spread in (1, 3, 40):
        counts = [[rng.choice([0, 0, rng.randrange(spread + 1)]) for _ in range(size)] for _ in range(2)]
        share = lambda c, k: 1 + 10**9 * (c + 2) // (1000 + 77 * k)
        sides = []
        for k, own in enumerate(counts):
            bits = defaultdict(int)
            for place, c in enumerate(own):
                if c:
                    bits[share(c, k)] |= 1 << place
            sides.append(Levels(list(bits), [b.to_bytes(size // 8, "little") for b in bits.values()], share(0, k)))
        f = lambda p, q: (p - q) * (p - q) // (p + q)
        assert cross(*sides, size) == sum(f(share(a, 0), share(b, 1)) for a, b in zip(*counts))
