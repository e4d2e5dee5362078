"""The dealt operators against brute force, round trips and held-out labels."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from compare import connect, rows_of, rows_of_sql
from tokenizers import Tokenizer, models, pre_tokenizers

from netgroom.llm.bpe import Bpe, bpe_digests, read_ranks
from netgroom.llm.counts import Counter, count_tokens, read_pieces
from netgroom.llm.decontaminate import contaminated
from netgroom.llm.jaccard import jaccard_classes
from netgroom.llm.langid import fit, identify
from netgroom.llm.licenses import rules, scan_licenses
from netgroom.llm.registry import ORACLE_SQL, QUERIES
from netgroom.llm.secrets import redact_secrets, scan_secrets
from netgroom.llm.sentences import dedup_sentences
from netgroom.llm.topk import quantise, top_k
from netgroom.llm.toxicity import score

SMALL = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, id long, gram long"


def docs(spark, texts):
    """Documents with columns whose names clash with inner ones; None ids for None pairs."""
    return spark.createDataFrame([(i, t, 7, 7) for i, t in texts], DOCS)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))


EDGE = [(1, None), (2, ""), (3, "..."), (None, "one two three four five"), (4, "x " * 50_000), (5, "same words here again now"), (5, "same words here again now")]


@pytest.mark.parametrize(
    "apply",
    [
        lambda d: bpe_digests(d, RANKS, public_tokenizers.PATTERN),
        lambda d: count_tokens(d, PIECES),
        lambda d: jaccard_classes(d),
        lambda d: scan_licenses(d),
        lambda d: scan_secrets(d),
        lambda d: dedup_sentences(d),
        lambda d: score(d, np.zeros(1 << 18)),
        lambda d: identify(d, fit(d.selectExpr("doc_id as id", "text", "'en' as lang"))),
        lambda d: redact_secrets(d),
    ],
)
def test_edge_rows_and_empty_tables(spark, apply):
    assert apply(docs(spark, EDGE)).count() == len(EDGE)
    assert apply(docs(spark, [])).count() == 0


def test_topk_equals_sql(spark):
    _, got = rows_of(QUERIES["op1_topk"](spark, SMALL))
    _, want, _ = rows_of_sql(connect(SMALL), ORACLE_SQL["op1_topk"])
    assert got == want


def test_topk_edges(spark):
    data = [(0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0, None]), (3, None), (4, [float("nan"), 1.0]), (5, [1.0]), (6, [1.0, 0.5]), (6, [1.0, 0.5])]
    rows = quantise(spark.createDataFrame(data, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    got = top_k(rows.where("id = 0"), rows, 5).orderBy("rank").collect()
    assert [(r.rank, r.vec_id, r.score) for r in got] == [(1, 1, 5120), (2, 6, 5120), (3, 6, 5120)]
    assert top_k(rows.where("false"), rows).count() == 0


def test_language_of_held_out_documents(spark):
    got = QUERIES["op2_language"](spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out").collect()
    assert held and sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)


def test_sentences_covered_by_later_places_go(spark):
    rng = random.Random(1)
    passage = ". ".join(words(rng, 12) for _ in range(5)) + ". "
    rows = [(k, f"{words(rng, 30)}. {passage}{words(rng, 30)}. {words(rng, 25)}.") for k in range(40)] + [(99, words(rng, 60))]
    got = {r.doc_id: r for r in dedup_sentences(docs(spark, rows)).collect()}
    assert got[0].n_removed == 0 and got[0].text == rows[0][1] and got[99].text == rows[-1][1]
    for k, text in rows[1:-1]:
        assert got[k].text == text.replace(passage, "") and got[k].n_removed == 5


def test_decontamination_finds_other_numbers_and_leaves_the_rest(spark):
    rng = random.Random(2)
    item = "a farmer from the village sells 12 kg of apples to Anna and keeps 3 kg of apples for the long winter ahead of us"
    other = item.replace("12", "47").replace("Anna", "Bert").replace("3 kg", "9 kg")
    clash = item.replace("3 kg", "12 kg")
    rows = [(1, f"{words(rng, 20)} {item} {words(rng, 20)}"), (2, f"x {other} y"), (3, words(rng, 200)), (4, f"x {clash} y"), (5, None)]
    bench = spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string")
    got = {r.doc_id: r.n_changed for r in contaminated(docs(spark, rows), bench).collect()}
    assert got == {1: 0, 2: 3}


def test_bpe_equals_tiktoken():
    ranks = read_ranks(RANKS)
    want = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    bpe, rng = Bpe(ranks, public_tokenizers.PATTERN), random.Random(3)
    for _ in range(400):
        text = "".join(rng.choice("ab c'\n\x1c 　éß的😀12") for _ in range(rng.randrange(60)))
        assert bpe.encode(text) == want.encode_ordinary(text)
        assert bpe.decode(bpe.encode(text)) == text.encode()


def test_bpe_edits_equal_encoding_anew():
    bpe, rng = Bpe(read_ranks(RANKS), public_tokenizers.PATTERN), random.Random(4)
    data = b"the quick brown fox jumps over" * 6
    last = bpe.append(data, [])
    for _ in range(100):
        start = rng.randrange(len(data))
        data, last = bpe.replace(data, last, start, min(len(data), start + rng.randrange(4)), rng.choice([b"", b"qu", b"over the"]))
        assert last == bpe.append(data, [])


def test_toxicity_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op6_toxicity"](spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic"), "doc_id").collect()
    false = sum(r.predicted and not r.toxic for r in got)
    assert false <= 0.01 * len(got) and sum(r.predicted for r in got if r.toxic) >= 0.5 * sum(r.toxic for r in got)


def test_licences(spark):
    rows = [(1, "GNU General Public License, version 3 or later"), (2, "the CC-BY cc by 4.0; MIT License"), (3, "licence to kill"), (4, "Apache License. apache license")]
    got = {r.doc_id: r for r in scan_licenses(docs(spark, rows)).collect()}
    assert (got[1].labels, got[1].n_base, got[1].first_word) == ("gpl,gpl-3-or-later", 1, 0)
    assert got[2].base_labels == "cc-by,mit" and got[2].n_base == 3 and (got[2].first_word, got[2].last_word) == (1, 7)
    assert got[3].labels == "" and got[3].score == 0
    assert got[4].n_base == 2 and len(rules()) > 100


def test_secrets_equal_brute_force(spark):
    rng = random.Random(5)
    token = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40))
    rows = [(k, "".join(rng.choice(["é😀", "token=", "api_key: ", "AKIA", "deadbeef0123", "secret", " ", "abcdef", '"', "ABCDEFGH12"]) for _ in range(30))) for k in range(200)]
    rows += [(900, f"see {token} there"), (901, "see zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzz1111 there")]
    got = {r.doc_id: r for r in scan_secrets(docs(spark, rows)).collect()}
    for k, text in rows:
        spans = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        listed = ",".join(f"{('assign', 'access', 'hex')[kind]}:{a}:{b}" for a, kind, b in sorted(spans))
        assert got[k].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
    assert got[900].spans == "random:4:44" and got[901].spans == ""
    assert redact_secrets(docs(spark, [(1, f"é {token} b token=abcdefgh"), (2, None)])).orderBy("doc_id").first().text == "é <secret> b <secret>"


def test_jaccard_equals_brute_force(spark):
    rng = random.Random(6)
    bases = [words(rng, 60).split() for _ in range(6)]
    rows = []
    for k in range(160):
        w = list(rng.choice(bases))
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = rng.choice("xyz")
        rows.append((k * 3, " ".join(w)))
    rows += [(1000, "a b"), (1001, "A  b"), (1002, "a"), (1003, "")]
    sets = {}
    for i, t in rows:
        w = t.lower().split()
        sets[i] = {tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} - {()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_classes(docs(spark, rows)).collect()}
    assert got == {i: (len(s), find(i)) for i, s in sets.items()}


def test_counts_equal_the_tokenizer():
    pieces = read_pieces(PIECES)
    rng = random.Random(7)
    # whole scores make ties; without byte pieces unknown characters are fused
    for used in ([(p, float(round(s / 1000))) for p, s in pieces], pieces[256:]):
        tokenizer = Tokenizer(models.Unigram([("<unk>", 0.0), *used], 0, True))
        tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
        counter = Counter(used)
        for _ in range(500):
            text = "".join(rng.choice("abcdé  ing 的\n€😀") for _ in range(rng.randrange(40)))
            assert counter.count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_pipeline_stages(spark):
    import corpus_pipeline

    given = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = corpus_pipeline.run(spark, SMALL).collect()
    assert 0 < len(out) < given.count() and len({r.doc_id for r in out}) == len(out)
    assert all(r.lossless for r in out)


def test_pipeline_drops_near_copies_between_both_thresholds(spark):
    import corpus_pipeline

    rng = random.Random(8)
    bases = [words(rng, n).split() for n in (50, 50, 120, 30)]
    rows = []
    for k in range(40):
        w = list(bases[k % 4])
        for at in rng.sample(range(10, len(w) - 10), k // 4 % 3):
            w[at] = f"other{k}"
        rows.append((k, " ".join(w)))
    near = list(bases[0])
    near[25] = "changed"
    rows += [(100, " ".join(near)), (101, words(rng, 50))]
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    root = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    root[i] = root[j] = min(root[i], root[j])
    four = [{tuple(w[k : k + 4]) for k in range(47)} for w in (bases[0], near)]
    assert 100 * len(four[0] & four[1]) < 85 * len(four[0] | four[1]) and root[100] == 0
    got = corpus_pipeline.near_duplicates(spark, docs(spark, rows), SMALL)
    assert {r.doc_id for r in got.collect()} == {i for i in root if root[i] == i}


def test_decontamination_follows_edits_of_an_item(spark):
    rng = random.Random(9)
    item = "a farmer from the old village sells 2 kg of ripe apples to Anna Smith and keeps 3 kg of sour pears for the long winter ahead of us all"
    starts = "Anna went out to see the sea. Then she told Carl that Anna would stay. Carl did not reply to her question at all."
    texts = {
        1: item.replace("to Anna", "today to Anna"),
        2: item.replace("old ", ""),
        3: item.replace("Anna Smith", "Bert"),
        4: item.replace("2 kg", "4 kg").replace("3 kg", "4 kg"),
        5: "we saw 7 km of road and 8 km of rail near the city in May",
        6: starts.replace("Anna", "Dora").replace("Carl", "Emil"),
        7: "many words stand here, then red green blue and more words",
        8: item[:40] + words(rng, 40) + item[40:],
        9: " ".join(w for k, w in enumerate(item.split()) if k % 4),
        10: "nothing here but 41 of them",
        11: "nothing here but 42 of them",
        12: words(rng, 200),
    }
    bench = [(1, item), (2, "we saw 5 km of road and 5 km of rail near the city in May"), (3, starts), (4, "red green blue"), (5, "42")]
    rows = [(k, f"{words(rng, 9)} {t}\n{words(rng, 9)}") for k, t in texts.items()]
    frame = spark.createDataFrame(bench, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated(docs(spark, rows), frame).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 2), (6, 3), (7, 4), (11, 5)}


def test_sentences_alone_and_at_the_end_of_a_passage_go(spark):
    rng = random.Random(10)
    long, flat = words(rng, 55) + ". ", words(rng, 70)
    tail = f"{words(rng, 30)}. " + " ".join(f"{words(rng, 6)}." for _ in range(2)) + " "
    cjk = "".join("".join(rng.choice("天地玄黄宇宙洪荒日月盈昃") for _ in range(9)) + "。" for _ in range(6))
    rows = []
    for k in range(3):
        rows += [(k, f"{words(rng, 9)}. {long}{words(rng, 9)}."), (10 + k, flat), (20 + k, cjk), (30 + k, f"{words(rng, 25)}. {tail}{words(rng, 25)}.")]
    got = {r.doc_id: r for r in dedup_sentences(docs(spark, rows)).collect()}
    for i, text in rows:
        gone = "" if i % 10 == 0 else {0: long, 1: flat, 2: cjk, 3: tail}[i // 10]
        assert got[i].text == (text.replace(gone, "") if gone else text), i


def test_spans_equal_all_shortest_runs():
    from netgroom.llm.sentences import spans

    rng = random.Random(11)
    for _ in range(300):
        sizes = [rng.choice([1, 3, 8, 19, 20, 30]) for _ in range(rng.randrange(9))]
        total = lambda a, b: sum(sizes[a:b])
        n = len(sizes)
        runs = [(a, b) for a in range(n) for b in range(a + 2, n + 1) if total(a, b) >= 20]
        want = {(a, b) for a, b in runs if (a, b - 1) not in runs or (a + 1, b) not in runs} | {(a, a + 1) for a in range(n) if sizes[a] >= 20}
        got = {(a, a + k) for a, k, _ in spans(" ".join(words(rng, s) + "." for s in sizes))}
        assert got == want


def test_pipeline_decides_by_row(spark):
    import corpus_pipeline

    rng = random.Random(12)
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").orderBy("item_id").first().text
    a, b, c, d = (words(rng, 60) for _ in range(4))
    rows = [(1, a), (1, b), (2, a), (None, b), (None, c), (None, c), (None, d), (None, f"x {item} y"), (1, f"z {item} y"), (3, d)]
    kept = corpus_pipeline.near_duplicates(spark, docs(spark, rows), SMALL)
    left = corpus_pipeline.decontaminate(spark, kept, SMALL)
    assert left.columns == ["doc_id", "text", "id", "gram"]
    assert sorted((r.doc_id or 0, r.text) for r in left.collect()) == sorted([(1, a), (1, b), (0, c), (3, d)])


def test_language_sample_is_no_prefix(spark):
    rng = random.Random(13)
    head = words(rng, 100)
    body = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(n))
    rows = [(k, f"{head} {body('abcdefg', 2000)}", "one") for k in range(64)] + [(100 + k, f"{head} {body('mnopqrs', 2000)}", "two") for k in range(64)]
    model = fit(spark.createDataFrame(rows, "id long, text string, lang string"))
    got = {r.doc_id: r.lang_pred for r in identify(docs(spark, [(1, body("abcdefg", 50)), (2, body("mnopqrs", 50))]), model).collect()}
    assert got == {1: "one", 2: "two"}
    from netgroom.llm.langid import sample

    assert len(sample([(5, b"a"), (6, b"b" * 100), (7, b"c" * 100)], 100)) == 102


def test_licence_ids_and_number_after_name(spark):
    cases = {
        "BSD 3-Clause License": "bsd-3-clause",
        "the BSD 2-Clause License.": "bsd-2-clause",
        "SPDX-License-Identifier: Apache-2.0": "apache-2.0",
        "SPDX-License-Identifier: MIT": "mit",
        "SPDX-License-Identifier: BSD-3-Clause": "bsd-3-clause",
        "SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2-or-later",
        "SPDX-License-Identifier: CC-BY-SA-4.0": "cc-by,cc-by-sa-4.0",
        "under GPLv3 or any later version": "gpl-3-or-later",
        "GPL-3.0-only": "gpl-3",
        "LGPL-2.1": "lgpl-2.1",
        "LGPLv2.1": "lgpl-2.1",
        "MPL-2.0": "mpl-2.0",
        "SPDX-License-Identifier: Other": "spdx",
        "an example of 2 simple apache helicopters": "",
    }
    got = scan_licenses(docs(spark, list(enumerate(cases)))).orderBy("doc_id").collect()
    assert {text: r.labels for text, r in zip(cases, got)} == cases
    assert [r.doc_id for r in got if r.base_labels] == [6]
