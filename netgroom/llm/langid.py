"""Language identification by cross-parsing entropy over suffix automata."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netgroom.llm.common import map_texts, table, texts
from netgroom.llm.text import chunks

#: Bounds of the training sample: documents per language and bytes of normalised text per language.
SAMPLE_DOCS = 64
SAMPLE_BYTES = 40_000
#: Bytes over all languages: with more than eight, each has an even part of this.
TOTAL_BYTES = 320_000

#: Least confidence of a kept document with so many letters: 0.5 is as good a match with the next language.
MIN_SCORE, MIN_LETTERS = 0.502, 200
_PRED, _SCORE = "netgroom_lang_pred", "netgroom_lang_score"

_NO_LETTER = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


def normal(text: str) -> bytes:
    return _NO_LETTER.sub(" ", text.lower()).strip().encode()


def automaton(data: bytes) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``data``; state 0 is the root."""
    moves, link, size, tail = [{}], [-1], [0], 0
    for c in data:
        new = len(moves)
        moves.append({})
        link.append(0)
        size.append(size[tail] + 1)
        p = tail
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if size[p] + 1 == size[q]:
                link[new] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                size.append(size[p] + 1)
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        tail = new
    return moves


class Model:
    """One automaton per language over the bytes that occur in any sample, kept as its transitions alone.

    ``arrays`` is all that workers get: plain values and arrays, so a worker needs no copy of this class.
    """

    def __init__(self, samples: dict[str, bytes]):
        used = sorted(set(b"".join(samples.values())))
        codes = np.zeros(256, np.uint8)
        codes[used] = np.arange(1, len(used) + 1)
        self.langs = sorted(samples)
        self.arrays = {"codes": codes.tobytes(), "width": len(used) + 1, "langs": self.langs, "weights": [], "moves": []}
        for lang in self.langs:
            moves = automaton(samples[lang].translate(codes.tobytes()))
            state = np.repeat(np.arange(len(moves), dtype=np.int32), [len(m) for m in moves])
            byte = np.array([c for m in moves for c in m], np.uint8)
            target = np.array([t for m in moves for t in m.values()], np.int32)
            self.arrays["moves"].append((len(moves), state, byte, target))
            self.arrays["weights"].append(math.log2(len(samples[lang]) + 2))


class Reader:
    """Cross-parsing by the automata of a model's arrays."""

    def __init__(self, arrays: dict):
        self.langs, self.codes, self.weights = arrays["langs"], arrays["codes"], arrays["weights"]
        width, self.walks = arrays["width"], []
        for states, state, byte, target in arrays["moves"]:
            dense = np.zeros(states * width, np.int32)
            dense[state.astype(np.int64) * width + byte] = target * width
            self.walks.append(dense.tolist())

    @staticmethod
    def phrases(walk: list[int], data: bytes) -> int:
        """Number of greedy longest matches that make up ``data``; a byte that the sample never has begins one with what follows it."""
        state, n = 0, 1
        for c in data:
            state = walk[state + c]
            if not state:
                n += 1
                state = walk[c]
        return n

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, confidence and bits per byte; ``und`` without letters or languages."""
        if not text or not self.langs or not _LETTER.search(text):
            return "und", 0.0, 0.0
        data = normal(text).translate(self.codes)
        cost = [self.phrases(w, data) * b / len(data) for w, b in zip(self.walks, self.weights)]
        order = sorted(range(len(cost)), key=lambda k: (cost[k], self.langs[k]))
        best = order[0]
        score = 1.0 if len(order) == 1 else cost[order[1]] / (cost[best] + cost[order[1]])
        return self.langs[best], float(score), float(cost[best])


def sample(parts: list[tuple[int, bytes]], size: int) -> bytes:
    """(hash, text) pairs in order, together about ``size`` bytes; a window at a hashed place of each that is too long."""
    share, left = [0] * len(parts), size
    for n, k in enumerate(sorted(range(len(parts)), key=lambda k: len(parts[k][1]))):
        share[k] = min(len(parts[k][1]), max(1, left // (len(parts) - n)))
        left -= share[k]
    out = []
    for (h, text), n in zip(parts, share):
        start = h % (len(text) - n + 1)
        out.append(text[start : start + n])
    return b" ".join(out)


def fit(labelled: DataFrame, docs: int = SAMPLE_DOCS, size: int = SAMPLE_BYTES, total: int = TOTAL_BYTES) -> Model:
    """Train on ``labelled`` (id, text, lang): at most ``docs`` different texts a language, by hash order.

    Texts share ``size`` bytes evenly, and what short ones leave goes to the others; of a
    text longer than its share a window at a hashed place is learned.  All languages together
    have at most ``total`` bytes, which bounds the model whatever their number.
    A sample alone is fitted; nothing else passes the driver.  Rows without a
    language or text do not count.
    """
    rows = labelled.where("lang is not null and text is not null").select("id", "lang", "text")
    keys = rows.groupBy("lang", F.xxhash64("text").alias("h")).agg(F.min("id").alias("id"))
    # 16 parts of a language first, so that no task sees more than a sample of it
    near = Window.partitionBy("lang", F.pmod("h", F.lit(16))).orderBy("h", "id")
    final = Window.partitionBy("lang").orderBy("h", "id")
    few = keys.withColumn("r", F.row_number().over(near)).where(F.col("r") <= docs)
    few = few.withColumn("r", F.row_number().over(final)).where(F.col("r") <= docs)
    chosen = few.select("lang", "id", "h")
    start = F.expr(f"int(pmod(h, greatest(length(text) - {size}, 0) + 1)) + 1")
    found = rows.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen), ["lang", "id", "h"])
    found = found.select("lang", "id", "h", F.substring("text", start, F.lit(size)).alias("text"))
    grouped: dict[str, list[tuple[int, int, str]]] = {}
    for row in found.distinct().toLocalIterator():
        grouped.setdefault(row.lang, []).append((row.id, row.h, row.text))
    samples = {}
    size = min(size, max(1, total // max(len(grouped), 1)))
    for lang, chosen_texts in grouped.items():
        data = sample([(h, normal(t)) for _, h, t in sorted(chosen_texts)], size)
        if data.strip():
            samples[lang] = data
    return Model(samples)


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, bits) of every whole text.

    ``und`` with score 0 for a null, empty or letterless text, or when no
    language was learned; ties go to the language that sorts first; repeated
    rows are answered each.
    """
    shared = df.sparkSession.sparkContext.broadcast(model.arrays)

    def make():
        reader = Reader(shared.value)
        return lambda i, text: [(i, *reader.predict(text))]

    schema = "id long, lang_pred string, score double, bits double"
    return map_texts(texts(df, id_col, text_col), schema, make).withColumnRenamed("id", id_col)


def with_language(df: DataFrame, model: Model, text_col: str = "text", into: str = "lang_pred", score: str = "lang_score") -> DataFrame:
    """``df`` with the language and the confidence of each text in two more columns (replaced if there)."""
    shared = df.sparkSession.sparkContext.broadcast(model.arrays)
    base = df.drop(into, score)
    kept = base.columns

    def run(batches):
        reader = Reader(shared.value)
        for batch in batches:
            for part in chunks(batch, text_col):
                found = [reader.predict(t) for t in part.column(part.schema.get_field_index(text_col)).to_pylist()]
                columns = [*part.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [*kept, into, score])

    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField(into, T.StringType()), T.StructField(score, T.DoubleType())]))


def keep_identified(df: DataFrame, model: Model, min_score: float = MIN_SCORE, languages: list[str] | None = None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``df`` whose text has a language, with all their columns.

    A text is rejected without letters, with ``MIN_LETTERS`` or more and a confidence under
    ``min_score`` (no language fits it better than the next), or, if ``languages`` are given, in another
    language.  A null ``lang_col`` is filled with the language found; other values stay.  Repeated
    rows are judged alike; an empty table stays empty, and without a learned language all rows go.
    """
    found = with_language(df, model, text_col, _PRED, _SCORE)
    letters = F.length(F.regexp_replace(F.col(f"`{text_col}`"), r"\P{L}+", ""))
    good = (F.col(_PRED) != "und") & ((F.col(_SCORE) >= min_score) | (letters < MIN_LETTERS))
    if languages is not None:
        good &= F.col(_PRED).isin(list(languages))
    out = found.where(good)
    if lang_col in df.columns:
        out = out.withColumn(lang_col, F.coalesce(F.col(f"`{lang_col}`"), F.col(_PRED)))
    return out.select(*(F.col(f"`{c}`") for c in df.columns))


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame) -> Model:
    return fit(docs.where(~held_out()).select(F.col("doc_id").alias("id"), "text", "lang"))


def op2_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = identify(docs, train(docs))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "bits")
