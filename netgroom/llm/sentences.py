"""Substring deduplication by sliding sentence spans."""

from __future__ import annotations

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netgroom.llm.common import join_counted, map_texts, stored, table, texts
from netgroom.llm.text import chunks

#: A span has at least so many words, and so many sentences unless one sentence alone has the words.
SENTENCES, WORDS = 2, 20

#: Sentence ends: of Latin and similar scripts, CJK, Devanagari, Arabic, Urdu, Armenian, Ethiopic, Burmese, Khmer, Tibetan.
_ENDS = r".!?\n\u2028\u2029。．｡！？।॥؟۔։።፧။៕།"
_SENTENCE = regex.compile(rf"[^{_ENDS}]+[{_ENDS}]*\s*|[{_ENDS}]+\s*")
#: Scripts without spaces between words: each letter counts as a word.
_DENSE = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}"
_DENSE_LETTER = regex.compile(rf"[{_DENSE}]")
_WORD = regex.compile(rf"[{_DENSE}]|[^\s{_DENSE}]+")


def split(text: str) -> list[str]:
    """Sentences with their ends and the white space behind them; together they are the text."""
    return _SENTENCE.findall(text)


def n_words(part: str) -> int:
    if part.isascii() or not _DENSE_LETTER.search(part):
        return len(part.split())
    return sum(1 for _ in _WORD.finditer(part))


def spans(text: str) -> list[tuple[int, int, int]]:
    """(first sentence, sentences, hash) of each span; words are compared in lower case, spaces do not count.

    Spans are the shortest runs of two sentences or more that start and that end at each sentence,
    and single sentences, all with at least ``WORDS`` words.
    """
    parts = [" ".join(s.lower().split()) for s in split(text)]
    total = [0]
    for p in parts:
        total.append(total[-1] + n_words(p))
    n, end, start, runs = len(parts), 0, 0, set()
    for k in range(n):
        if total[k + 1] - total[k] >= WORDS:
            runs.add((k, k + 1))
        while end <= n and (end < k + SENTENCES or total[end] - total[k] < WORDS):
            end += 1
        if end <= n:
            runs.add((k, end))
        last = k + 1
        # the latest start from which the words up to here suffice
        while start + 1 <= last - SENTENCES and total[last] - total[start + 1] >= WORDS:
            start += 1
        if start <= last - SENTENCES and total[last] - total[start] >= WORDS:
            runs.add((start, last))
    out = []
    for first, end in sorted(runs):
        digest = xxhash.xxh3_64_intdigest("\x1f".join(parts[first:end]))
        out.append((first, end - first, digest - (1 << 64) if digest >> 63 else digest))
    return out


def dedup_sentences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, n_sentences, n_removed, removed): every text without the sentences of repeated spans.

    The first place of a span, by id and then by position, stays; at every other place its
    sentences go.  ``removed`` lists their numbers from 0.  Null and
    empty texts stay as they are with no sentences; texts with less than a span
    stay; a row without an id is returned unchanged; rows that repeat an id
    are treated alike.
    """
    rows = texts(df, id_col, text_col)

    def make():
        return lambda i, text: [(i, *s) for s in spans(text or "")]

    every = stored(map_texts(rows.where("id is not null"), "id long, at int, n int, gram long", make))
    first = stored(every.groupBy("gram").agg(F.min(F.struct("id", "at")).alias("f"), F.count("*").alias("c")).where("c > 1"))
    again = join_counted(every, first, "gram", "c").where((F.col("id") != F.col("f.id")) | (F.col("at") != F.col("f.at")))
    covered = again.select("id", F.explode(F.sequence("at", F.col("at") + F.col("n") - 1)).alias("at")).distinct()
    gone = covered.groupBy("id").agg(F.array_sort(F.collect_list("at")).alias("gone"))

    def cut():
        def work(i, text, gone):
            parts = split(text or "")
            out = set(gone or ())
            kept = "".join(s for k, s in enumerate(parts) if k not in out) if out else text
            return i, kept, len(parts), len(out), sorted(out)

        return work

    def run(batches):
        work = cut()
        for batch in batches:
            for part in chunks(batch, "text"):
                got = [work(*r) for r in zip(*(c.to_pylist() for c in part.columns))]
                types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[k] for g in got], kind) for k, kind in enumerate(types)],
                    ["id", "text", "n_sentences", "n_removed", "removed"],
                )

    schema = "id long, text string, n_sentences long, n_removed long, removed array<int>"
    # rows without an id have nothing to meet
    known = rows.where("id is not null").join(gone, "id", "left").select("id", "text", "gone")
    unknown = rows.where("id is null").select("id", "text", F.lit(None).cast("array<int>").alias("gone"))
    return known.unionByName(unknown).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op3_sentences(spark, sf_dir):
    return dedup_sentences(table(spark, sf_dir, "documents"))
