"""Operators against plain versions of their work."""

import os
import random
import subprocess
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import connect, rows_of, rows_of_sql

import netgroom.llm.common as common
import netgroom.llm.topk as topk
from netgroom.llm.langid import Model, Reader, keep_identified, normal
from netgroom.llm.licenses import _FAMILIES, _NOTICES, _SHORT, Scanner, rules, wordings
from netgroom.llm.registry import ORACLE_SQL, QUERIES
from netgroom.llm.sentences import dedup_sentences, spans, split

SMALL = "/root/testdata/sf0.001"
HERE = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.mark.parametrize("block", [8192, 40])
def test_topk_of_large_components_and_repeated_ids(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(topk, "ROWS", block)
    monkeypatch.setattr(topk, "QUERIES", block)
    rng = random.Random(block)
    rows = [(20, [1e6, 1.0]), (1, [3e5, 1.0]), (2, [4e5, 0.0]), (6, [2.0, 3.0]), (6, [2.0, 3.0]), (6, [-2.0, 1e6])]
    # the SQL multiplies in doubles, which are exact up to these sizes
    rows += [(rng.randrange(150), [rng.choice([0.5, -1.25, 3e4, 1e-9, 300.0]) * rng.randrange(-4, 5) for _ in range(rng.choice([2, 3, 40]))]) for _ in range(300)]
    rows += [(7, None), (8, [float("inf"), 1.0]), (None, [1.0, 1.0]), (9, []), (60, [])]
    spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, id long, r long").coalesce(1).write.parquet(f"{tmp_path}/t")
    part = next(f for f in os.listdir(tmp_path / "t") if f.endswith(".parquet"))
    os.link(tmp_path / "t" / part, tmp_path / "embeddings.parquet")
    _, got = rows_of(QUERIES["op1_topk"](spark, str(tmp_path)))
    _, want, _ = rows_of_sql(connect(str(tmp_path)), ORACLE_SQL["op1_topk"])
    assert got == want and sum(got.values()) > 60


def test_scores_beyond_doubles_are_exact():
    rng = np.random.default_rng(3)
    for scale in (10**3, 10**8, 10**9):
        rows = rng.integers(-scale, scale, (120, 9))
        ids = np.sort(rng.integers(0, 60, 120))
        block = topk.Block(ids, rows)
        for q, (live, score) in zip(range(5), topk.search(block, rows[:5], ids[:5].tolist(), [None] * 5, 10)):
            best = sorted((-sum(int(a) * int(b) for a, b in zip(r, rows[q])), int(i)) for r, i in zip(rows, ids) if i != ids[q])[:10]
            order = np.argsort(-score, kind="stable")[:10]
            assert [(-int(score[k]), int(ids[live[k]])) for k in order] == best


def longest(sample, data, at):
    size = 0
    while at + size < len(data) and data[at : at + size + 1] in sample:
        size += 1
    return size


def plain_phrases(sample, data):
    n, at = 1, longest(sample, data, 0)
    while at < len(data):
        n += 1
        # a byte that the sample never has makes a phrase with the match behind it
        strange = data[at : at + 1] not in sample
        at += strange + longest(sample, data, at + strange)
    return n


def test_phrases_are_longest_matches():
    rng = random.Random(4)
    samples = {lang: normal(" ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) for _ in range(60))) for lang, letters in (("one", "abcde"), ("two", "cdefgé"), ("three", "aàbß"))}
    reader = Reader(Model(samples).arrays)
    for _ in range(200):
        text = "".join(rng.choice("abcdefgéàß xyz") for _ in range(rng.randrange(1, 80)))
        data = normal(text)
        if data:
            got = [reader.phrases(w, data.translate(reader.codes)) for w in reader.walks]
            assert got == [plain_phrases(samples[lang], data) for lang in reader.langs], text


def test_language_stage_rejects_what_it_cannot_tell(spark):
    rng = random.Random(5)
    words = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(n))
    model = Model({"one": normal(words("abcdefg", 900)), "two": normal(words("mnopqrs", 900))})
    rows = [(1, words("abcdefg", 80), "one"), (2, words("mnopqrs", 80), None), (3, words("uvwxyz", 80), "one"), (4, "uv", "one"), (5, "12 . 3", "one"), (6, None, "one"), (7, "", None)]
    frame = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, lang string, lang_score long")
    kept = {r.doc_id: r.lang for r in keep_identified(frame, model).collect()}
    assert kept == {1: "one", 2: "two", 4: "one"}
    assert keep_identified(frame, model).columns == frame.columns
    assert {r.doc_id for r in keep_identified(frame, model, languages=["two"]).collect()} >= {2} and 1 not in {r.doc_id for r in keep_identified(frame, model, languages=["two"]).collect()}
    assert keep_identified(frame.where("false"), model).count() == 0


def test_anchored_rules_equal_all_rules_at_all_places():
    rng, ordered, scanner = random.Random(6), rules(), Scanner()
    vocabulary = [w for name, _, _ in _FAMILIES for w in wordings(name)] + [p for p, _, _ in _NOTICES] + [w for w, _ in _SHORT]
    vocabulary += ["spdx license identifier", "version", "v", "2", "3", "2 0", "1 1", "or later", "or any later", "only", "0", "v3", "gplv3", "the", "4 0"]
    found = 0
    for _ in range(1500):
        words = (" " + " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 9))) + " ").encode()
        starts = [k + 1 for k in range(len(words) - 1) if words[k] == 32]
        hits = sorted(
            (m.start() - m.end(), r.priority, k, m.start(), m.end(), r.label, r.weight) for k, r in enumerate(ordered) for at in starts for m in [r.pattern.match(words, at)] if m
        )
        kept = []
        for *_, start, end, label, weight in hits:
            if all(end <= s or start >= e for s, e, *_ in kept):
                kept.append((start, end, label, weight))
        assert scanner.detect(words) == sorted(kept), words
        found += len(kept)
    assert found > 1000


@pytest.mark.parametrize("part", [1000, 3])
def test_repeated_spans_equal_all_places(spark, monkeypatch, part):
    monkeypatch.setattr(common, "HOT_PART", part)
    rng = random.Random(part)
    sentences = [" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(rng.randrange(3, 25))) + rng.choice([". ", "! ", "\n"]) for _ in range(40)]
    hot = "".join(sentences[:3])
    rows = [(k, (hot if k % 2 else "") + "".join(rng.choice(sentences) for _ in range(rng.randrange(7)))) for k in range(60)] + [(70, None), (71, ""), (None, hot), (None, hot)]
    first, places = {}, defaultdict(list)
    for i, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for at, n, gram in spans(text or ""):
            places[gram].append((i, at, n))
            first[gram] = min(first.get(gram, (i, at)), (i, at))
    gone = defaultdict(set)
    for gram, met in places.items():
        for i, at, n in met:
            if len(met) > 1 and (i, at) != first[gram]:
                gone[i] |= set(range(at, at + n))
    want = Counter((i, t if not gone.get(i) else "".join(s for k, s in enumerate(split(t)) if k not in gone[i])) for i, t in rows)
    got = dedup_sentences(spark.createDataFrame([(*r, 1, 1) for r in rows], "doc_id long, text string, gram long, at long"))
    assert Counter((r.doc_id, r.text) for r in got.collect()) == want and any(gone.values())


def test_row_keys_tell_equal_rows_apart(spark):
    import corpus_pipeline

    rows = spark.createDataFrame([(1, "same"), (1, "same"), (None, None), (None, None), (2, "other")] * 3, "doc_id long, text string").repartition(4)
    keyed = corpus_pipeline.keyed(rows)
    assert keyed.select(corpus_pipeline.ROW).distinct().count() == 15 == keyed.count()
    one = {tuple(r) for r in keyed.collect()}
    assert one == {tuple(r) for r in keyed.collect()}


def test_operators_where_tasks_have_no_copy_of_the_library(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {HERE!r})
from netgroom.session import local_session
import __spark_entry__ as e
spark = local_session("elsewhere", 4)
q = e.queries()
print([q[n](spark, {SMALL!r}).count() for n in ("op2_language", "op5_bpe", "op12_packing", "op13_divergence")][:2], "token_ids" in q["pipeline"](spark, {SMALL!r}).columns)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "[200, 200] True" in done.stdout, done.stderr[-2000:]
