"""N-gram Jaccard join by rare-first prefix filtering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netgroom.llm.common import components, stored, table, texts
from netgroom.llm.text import LOWER, NOT_SPACE, buffers, chunks, hash_spans, mix, signed, text_of, windows, word_spans

SIZE, PERCENT = 4, 85

#: Counters of hashed shingles; their number, and so the broadcast, is fixed.
COUNTERS = 1 << 18
#: Ranges of hashes that the suffix filter counts.
RANGES = 16
#: Earlier shingles of a prefix by which a pair met again is left out.
EARLIER = 8
#: 64-bit words of the parity bitmap of a set.
PARITY_WORDS = 8
#: Rounds that link by a few centres before the remaining pairs are enumerated.
STAR_ROUNDS = 4


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``size`` make one shingle."""
    raw, at = buffers(column)
    raw = LOWER[raw]
    starts, ends = word_spans(raw, at, NOT_SPACE)
    hashes, owner = hash_spans(raw, starts, ends), text_of(starts, at)
    grams, first = windows(hashes, owner, size)
    cut = np.searchsorted(owner[first], np.arange(len(column) + 1))
    words = np.searchsorted(owner, np.arange(len(column) + 1))
    out = []
    for k in range(len(column)):
        g = grams[cut[k] : cut[k + 1]]
        if not len(g) and words[k + 1] > words[k]:
            few = hashes[words[k] : words[k + 1]]
            g, _ = windows(few, np.zeros(len(few), np.int64), len(few))
        out.append(np.unique(g))
    return out


def _map_sets(rows: DataFrame, size: int, schema: str, make) -> DataFrame:
    """``make()`` gives a function from (batch of id, text; its sets) to a batch of columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in chunks(batch, "text"):
                yield work(part, shingle_sets(part.column(part.schema.get_field_index("text")), size))

    return rows.mapInArrow(run, schema)


def parity(sets: list[np.ndarray]) -> pa.Array:
    """Whether the number of a set's shingles in each of 512 classes is odd, as 8 longs.

    Bitmaps of two sets differ in no more bits than the sets differ in shingles.
    """
    size = 64 * PARITY_WORDS
    bits = np.zeros((len(sets), PARITY_WORDS), np.int64)
    for k, s in enumerate(sets):
        odd = np.bincount((mix(s) % np.uint64(size)).astype(np.int64), minlength=size) & 1
        bits[k] = np.packbits(odd.astype(np.uint8)).view(np.int64)
    return pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * PARITY_WORDS, bits.ravel())


def _sets_table(rows: DataFrame, size: int) -> DataFrame:
    """(id, n, h1, h2, bits): size of the set, a 128-bit signature and a parity bitmap of it."""

    def make():
        def work(part, sets):
            n = [len(s) for s in sets]
            h1 = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)
            h2 = np.array([mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets], np.uint64)
            return pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n, pa.int64()), pa.array(signed(h1)), pa.array(signed(h2)), parity(sets)],
                ["id", "n", "h1", "h2", "bits"],
            )

        return work

    return _map_sets(rows, size, "id long, n long, h1 long, h2 long, bits array<long>", make)


def _counters(rows: DataFrame, size: int) -> np.ndarray:
    """How often each hashed shingle occurs, in a fixed number of counters, summed over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for part in chunks(batch, "text"):
                sets = shingle_sets(part.column(part.schema.get_field_index("text")), size)
                total += np.bincount((np.concatenate(sets) % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    sums = rows.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    out = np.zeros(COUNTERS, np.int64)
    arrow = sums.toArrow()
    out[arrow.column("at").to_numpy()] = arrow.column("n").to_numpy()
    return out


def prefix_length(n: int, percent: int) -> int:
    """Two sets with the similarity share one of so many first shingles of any common order."""
    return n - -(-percent * n // 100) + 1


def _prefixes(rows: DataFrame, size: int, percent: int, counts) -> DataFrame:
    def make():
        seen = counts.value

        def work(part, sets):
            ids, grams, at, n = [], [], [], []
            for i, s in zip(part.column(0).to_numpy(), sets):
                if not len(s):
                    continue
                order = np.lexsort((s, seen[(s % np.uint64(COUNTERS)).astype(np.int64)]))
                p = prefix_length(len(s), percent)
                grams.append(s[order[:p]])
                ids.append(np.full(p, i, np.int64))
                at.append(np.arange(p, dtype=np.int32))
                n.append(np.full(p, len(s), np.int32))
            none = [np.zeros(0, np.int64)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(ids or none)),
                    pa.array(signed(np.concatenate(grams or [np.zeros(0, np.uint64)]))),
                    pa.array(np.concatenate(at or none).astype(np.int32)),
                    pa.array(np.concatenate(n or none).astype(np.int32)),
                ],
                ["id", "gram", "at", "n"],
            )

        return work

    return _map_sets(rows, size, "id long, gram long, at int, n int", make)


def _possible(percent: int, n1: str, n2: str, at1: str, at2: str):
    """Length and positional filter: the shingles from here on must suffice for the similarity."""
    need = f"({percent} * ({n1} + {n2}) + {99 + percent}) div {100 + percent}"
    return F.expr(
        f"100 * least({n1}, {n2}) >= {percent} * greatest({n1}, {n2}) "
        f"and 1 + least({n1} - {at1} - 1, {n2} - {at2} - 1) + least({at1}, {at2}) >= {need}"
    )


def _near(percent: int, n1: str, n2: str, bits1: str, bits2: str):
    """Bitmap filter: linked sets differ in at most n1 + n2 - 2 * (least intersection) shingles."""
    differ = " + ".join(f"bit_count({bits1}[{k}] ^ {bits2}[{k}])" for k in range(PARITY_WORDS))
    return F.expr(f"{differ} <= {n1} + {n2} - 2 * (({percent} * ({n1} + {n2}) + {99 + percent}) div {100 + percent})")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact test of two sorted sets, after the suffix filter on counts of hash ranges."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    need = -(-percent * (len(a) + len(b)) // (100 + percent))
    edges = np.arange(1, RANGES, dtype=np.uint64) << np.uint64(60)
    cut_a, cut_b = (np.concatenate(([0], np.searchsorted(s, edges), [len(s)])) for s in (a, b))
    if int(np.minimum(np.diff(cut_a), np.diff(cut_b)).sum()) < need:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verified(pairs: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """Those (a, b) whose texts link; each pair is tested once."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            sizes = np.diff(buffers(batch.column(2))[1]) + np.diff(buffers(batch.column(3))[1])
            total = np.concatenate(([0], np.cumsum(sizes)))
            while start < batch.num_rows:
                end = max(start + 1, int(np.searchsorted(total, total[start] + (1 << 21), side="right")) - 1)
                part = batch.slice(start, end - start)
                start = end
                left, right = shingle_sets(part.column(2), size), shingle_sets(part.column(3), size)
                keep = pa.array([linked(x, y, percent) for x, y in zip(left, right)], pa.bool_())
                yield part.select(["a", "b"]).filter(keep)

    first = rows.select(F.col("id").alias("a"), F.col("text").alias("left"))
    second = rows.select(F.col("id").alias("b"), F.col("text").alias("right"))
    both = pairs.join(second, "b").join(first, "a").select("a", "b", "left", "right")
    return both.mapInArrow(check, "a long, b long")


def jaccard_classes(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, percent: int = PERCENT
) -> DataFrame:
    """(id, n_shingles, component_id) of every row: exact components of the similarity join.

    Documents with equal sets collapse to their smallest id first.  Of the rest,
    each shingle of a prefix (rarest first, by fixed counters over all texts)
    has members.  A few rounds pair every member with one centre only; verified
    links join classes.  Then members of different classes of one shingle are
    paired and verified, so no pair inside a class already found is made, and
    no link between classes is lost.

    A null or empty text, or one without words, has an empty set and is its own
    class.  A row without an id takes part nowhere and has a null class.
    Repeated rows are answered each.
    """
    rows = texts(df, id_col, text_col)
    spark = df.sparkSession
    sets = stored(_sets_table(rows, size))
    reps = sets.where("n > 0 and id is not null").groupBy("n", "h1", "h2").agg(F.min(F.struct("id", "bits")).alias("r"))
    reps = stored(reps.select("n", "h1", "h2", F.col("r.id").alias("rep"), F.col("r.bits").alias("bits")))
    chosen = stored(rows.join(reps.select(F.col("rep").alias("id")), "id").select("id", "text"))
    counts = spark.sparkContext.broadcast(_counters(chosen, size))
    every = stored(_prefixes(chosen, size, percent, counts))
    # most shingles stand in one prefix only and can pair nothing
    common = every.groupBy("gram").agg(F.count("*").alias("members")).where("members > 1").select("gram")
    entries = stored(every.join(common, "gram"))

    node = reps.select(F.col("rep").alias("node"))
    classes = node.withColumn("component", F.col("node"))
    done = None
    for turn in range(STAR_ROUNDS):
        now = entries.join(classes.withColumnRenamed("node", "id"), "id")
        # the centre of a shingle: its member least by a hash of this round
        least = F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("h"), "id", "at", "n", "component"))
        centre = now.groupBy("gram").agg(least.alias("c"), F.count("*").alias("members"), F.min("component").alias("lo"), F.max("component").alias("hi"))
        centre = centre.where("members > 1 and lo <> hi").select(
            "gram", F.col("c.id").alias("cid"), F.col("c.at").alias("cat"), F.col("c.n").alias("cn"), F.col("c.component").alias("cc")
        )
        pairs = now.join(centre, "gram").where("component <> cc").where(_possible(percent, "n", "cn", "at", "cat"))
        pairs = pairs.select(F.least("id", "cid").alias("a"), F.greatest("id", "cid").alias("b")).distinct()
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = stored(pairs)
        done = pairs if done is None else done.unionByName(pairs)
        links = stored(_verified(pairs, chosen, size, percent))
        if links.isEmpty():
            break
        classes = _merged(classes, links)
    now = entries.join(classes.withColumnRenamed("node", "id"), "id")
    mixed = now.groupBy("gram").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("gram")
    bitmaps = reps.select(F.col("rep").alias("id"), "bits")
    before = Window.partitionBy("id").orderBy("at", "gram").rowsBetween(-EARLIER, -1)
    rest = now.join(mixed, "gram").withColumn("earlier", F.collect_list("gram").over(before))
    rest = stored(rest.join(bitmaps, "id"))
    x = rest.select("gram", *(F.col(c).alias(f"{c}1") for c in ("id", "at", "n", "component", "bits", "earlier")))
    y = rest.select("gram", *(F.col(c).alias(f"{c}2") for c in ("id", "at", "n", "component", "bits", "earlier")))
    pairs = x.join(y, "gram").where("id1 < id2 and component1 <> component2")
    pairs = pairs.where(_possible(percent, "n1", "n2", "at1", "at2")).where(_near(percent, "n1", "n2", "bits1", "bits2"))
    # a pair that shares an earlier shingle of both is made there
    pairs = pairs.where(~F.arrays_overlap("earlier1", "earlier2"))
    pairs = pairs.select(F.col("id1").alias("a"), F.col("id2").alias("b")).distinct().join(done, ["a", "b"], "left_anti")
    classes = _merged(classes, _verified(stored(pairs), chosen, size, percent))

    # smallest id of a class is that of its representatives, each being the smallest of its copies
    named = reps.join(classes.withColumnRenamed("node", "rep"), "rep").select("n", "h1", "h2", "component")
    out = sets.join(named, ["n", "h1", "h2"], "left")
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
    )


def _merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """Classes after new links; only links between classes are followed, as edges of class ids."""
    left = classes.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    right = classes.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    edges = links.join(left, "a").join(right, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    new = components(edges).select(F.col("node").alias("component"), F.col("component").alias("lower"))
    joined = classes.join(new, "component", "left")
    return stored(joined.select("node", F.coalesce("lower", "component").alias("component")))


def op9_jaccard(spark, sf_dir):
    return jaccard_classes(table(spark, sf_dir, "documents"))
