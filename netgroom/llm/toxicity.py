"""Toxicity by FTRL-proximal logistic regression over hashed n-grams and skip-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netgroom.llm.common import table, texts
from netgroom.llm.text import ALNUM, LOWER, buffers, chunks, hash_spans, mix, text_of, word_spans

BITS = 18
#: Bound of the training sample: documents of each label, taken by the least hash of their id.
SAMPLE = 3000
ALPHA, BETA, L1, L2, EPOCHS = 1.0, 1.0, 6.0, 1.0, 10
#: Gaps of the word pairs: 1 is a bigram, 2 a skip-gram.
GAPS = (1, 2)


def features(column: pa.Array) -> list[np.ndarray]:
    """Distinct buckets of words, pairs and skip-pairs of each text; bucket 0 is the constant."""
    raw, at = buffers(column)
    raw = LOWER[raw]
    starts, ends = word_spans(raw, at, ALNUM)
    words, owner = hash_spans(raw, starts, ends), text_of(starts, at)
    cut = np.searchsorted(owner, np.arange(len(column) + 1))
    out = []
    for k in range(len(column)):
        w = words[cut[k] : cut[k + 1]]
        grams = [w] + [mix(mix(w[:-g]) + w[g:] + np.uint64(g)) for g in GAPS if len(w) > g]
        hashed = (np.concatenate(grams) >> np.uint64(64 - BITS)).astype(np.int64)
        out.append(np.unique(np.append(hashed, 0)))
    return out


def train(rows: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """Weights after EPOCHS passes, with a rate per coordinate and L1 sparsity."""
    size = 1 << BITS
    z, n = np.zeros(size), np.zeros(size)

    def weights(i):
        zi = z[i]
        return np.where(np.abs(zi) <= L1, 0.0, (np.sign(zi) * L1 - zi) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for i, label in rows:
            w = weights(i)
            p = 1.0 / (1.0 + np.exp(-min(max(w.sum(), -35.0), 35.0)))
            g = p - label
            rate = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - rate * w
            n[i] += g * g
    return weights(np.arange(size))


def _featured(rows: DataFrame, schema: str, make) -> DataFrame:
    def run(batches):
        work = make()
        for batch in batches:
            for part in chunks(batch, "text"):
                yield work(part, features(part.column(part.schema.get_field_index("text"))))

    return rows.mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights learned from at most ``sample`` documents of each label; (id, text) and (id, label) are given.

    Features are made in tasks; the driver sees only the sample's.  Null ids, texts or labels do not count.
    Without both labels all weights are zero and every score is 0.5.
    """
    known = labels.where("id is not null and label is not null").groupBy("id").agg(F.max(F.col("label").cast("int")).alias("label"))
    by_hash = (F.xxhash64("id"), F.col("id"))
    near = Window.partitionBy("label", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(16))).orderBy(*by_hash)
    final = Window.partitionBy("label").orderBy(*by_hash)
    few = known.withColumn("r", F.row_number().over(near)).where(F.col("r") <= sample)
    few = few.withColumn("r", F.row_number().over(final)).where(F.col("r") <= sample).drop("r")
    rows = docs.where("text is not null").join(F.broadcast(few), "id").select("id", "label", "text")

    def make():
        def work(part, found):
            lists = pa.array([f.tolist() for f in found], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists], ["id", "label", "at"])

        return work

    got = _featured(rows, "id long, label int, at array<long>", make).dropDuplicates(["id"])
    pairs = [(r.id, r.label, np.array(r.at, np.int64)) for r in got.toLocalIterator()]
    pairs.sort(key=lambda r: int(mix(np.array([r[0]], np.int64).view(np.uint64))[0]))
    if len({label for _, label, _ in pairs}) < 2:
        return np.zeros(1 << BITS)
    return train([(at, label) for _, label, at in pairs])


def score(df: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every whole text; a null or empty text has the score of the constant alone.

    Only non-zero weights are broadcast, at most 2 ** BITS of them.
    """
    at = np.flatnonzero(weights)
    sparse = df.sparkSession.sparkContext.broadcast((at, weights[at]))

    def make():
        w = np.zeros(1 << BITS)
        w[sparse.value[0]] = sparse.value[1]

        def work(part, found):
            sums = np.clip([w[f].sum() for f in found], -35.0, 35.0)
            return pa.RecordBatch.from_arrays([part.column(0), pa.array(1.0 / (1.0 + np.exp(-sums)))], ["id", "score"])

        return work

    return _featured(texts(df, id_col, text_col), "id long, score double", make).withColumnRenamed("id", id_col)


def op6_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    weights = fit(texts(docs, "doc_id", "text"), labels.where(~held).select(F.col("doc_id").alias("id"), F.col("toxic").alias("label")))
    out = score(docs, weights)
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
