"""Exact top-k search by columnar branch-and-bound."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netgroom.llm.common import stored, table

#: Rows and queries of a block, dimensions added at a time, queries that share an order of dimensions.
ROWS, QUERIES, DIMS, BATCH = 8192, 8192, 16, 256
#: Products and sums below this are exact in doubles; beyond it scores are integers of any size.
EXACT = float(1 << 53)


def quantise(df: DataFrame, id_col: str, vec_col: str, scale: int = 64) -> DataFrame:
    """(id, v): floor(scale * x) of each component; rows without an id and those with nulls or non-finite values are left out.

    A component that no long holds after scaling ends the job with an error.
    """
    x = F.col(vec_col)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    most = float(1 << 63)

    def whole(c):
        scaled = F.floor(c.cast("double") * scale)
        large = F.raise_error(F.concat(F.lit("no long holds the component "), c.cast("string"))).cast("long")
        return F.when(F.abs(c.cast("double") * scale) >= most, large).otherwise(scaled.cast("long"))

    return df.where(x.isNotNull() & F.col(id_col).isNotNull()).where(~bad).select(F.col(id_col).cast("long").alias("id"), F.transform(x, whole).alias("v"))


class Block:
    """Rows of one length, column by column, with the norms of what is left from each dimension on."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.x = np.ascontiguousarray(rows.T.astype(np.float64))
        with np.errstate(over="ignore"):
            self.mass = (self.x * self.x).sum(axis=1)


def search(block: Block, queries: np.ndarray, q_ids: list[int], floors: list[int | None], k: int, live_at: list | None = None):
    """For each query (row indexes, scores) of its best rows of a block, at least the ``k`` best of those that reach its floor.

    Dimensions are added by falling mass of the queries and rows together.  After each block of
    them a score lies within the partial sum plus or minus the product of the remaining norms
    and the rounding error; rows whose upper bound is under the k-th lower bound, or under the floor, go,
    and the rest are compacted.  ``live_at`` receives the rows left after each block, query by query.
    """
    dims = queries.shape[1]
    y = queries.astype(np.float64)
    with np.errstate(over="ignore", invalid="ignore"):
        order = np.argsort(-(y * y).sum(axis=0) * block.mass, kind="stable")
        y, x = np.ascontiguousarray(y[:, order]), block.x[order]
        tail = lambda m: np.sqrt(np.cumsum((m * m)[::-1], axis=0)[::-1])
        rest_y, rest_x = tail(y.T), tail(x)
        first = y[:, :DIMS] @ x[:DIMS]
        for j, q_id in enumerate(q_ids):
            live = np.flatnonzero(block.ids != q_id)
            if not dims or not len(live):
                yield live, np.zeros(len(live), np.int64)
                continue
            part, size = first[j, live], rest_y[0, j] * rest_x[0, live]
            exact = size.max() < EXACT
            # sums of integers under 2^53 have no error
            error = np.zeros(len(live)) if exact else size * dims * 4e-16
            floor = -np.inf if floors[j] is None else float(floors[j]) - abs(floors[j]) * 1e-15
            for d in range(DIMS, dims + DIMS, DIMS):
                if len(live) > k or floor > -np.inf:
                    slack = (rest_y[d, j] * rest_x[d, live] * (1 + 1e-9) + 1e-6 if d < dims else 0.0) + 2 * error
                    bound = floor
                    if len(live) > k:
                        bound = max(bound, np.partition(part - slack, len(live) - k)[len(live) - k])
                    keep = ~(part + slack < bound)
                    live, part, error = live[keep], part[keep], error[keep]
                if live_at is not None:
                    live_at.append(len(live))
                if d < dims:
                    part = part + y[j, d : d + DIMS] @ x[d : d + DIMS, live]
            yield live, part.astype(np.int64) if exact else block.rows[live].astype(object) @ queries[j].astype(object)


def _blocks(rows: pa.Table) -> dict[int, Block]:
    """Vectors by their number of dimensions, ids ascending; repeated ids stay."""
    ids = rows.column("id").combine_chunks().to_numpy(zero_copy_only=False)
    flat = rows.column("v").combine_chunks()
    sizes = np.asarray(flat.value_lengths())
    starts = np.concatenate(([0], np.cumsum(sizes)))
    values = flat.flatten().to_numpy(zero_copy_only=False)
    out = {}
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        at = at[np.argsort(ids[at], kind="stable")]
        out[int(n)] = Block(ids[at], values[starts[at][:, None] + np.arange(n)].reshape(len(at), n))
    return out


def _near(queries: DataFrame, rows: DataFrame, nq: int, first: int, end: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): the best rows for each query (id, v, floor) in each of the blocks ``first`` to ``end`` - 1 of rows (id, v, r)."""
    left = rows.where(f"r >= {first} and r < {end}").withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))
    right = queries.withColumn("q", F.pmod(F.xxhash64("id"), F.lit(nq)).cast("int")).withColumn("r", F.explode(F.expr(f"sequence({first}L, {end - 1}L)")))

    def block(x: pa.Table, y: pa.Table) -> pa.Table:
        found = {"query_id": [], "vec_id": [], "score": []}
        if x.num_rows and y.num_rows:
            data = _blocks(x)
            floors = dict(zip(y.column("id").to_pylist(), y.column("floor").to_pylist()))
            for n, asked in _blocks(y).items():
                b = data.get(n)
                for at in range(0, len(asked.ids) if b else 0, BATCH):
                    ids = asked.ids[at : at + BATCH].tolist()
                    for q_id, (live, score) in zip(ids, search(b, asked.rows[at : at + BATCH], ids, [floors[i] for i in ids], k)):
                        # of equal scores the smaller id wins: ids ascend, the sort is stable
                        best = np.argsort(-score, kind="stable")[:k]
                        found["query_id"] += [q_id] * len(best)
                        found["vec_id"] += b.ids[live[best]].tolist()
                        found["score"] += score[best].tolist()
        return pa.table({c: pa.array(v, pa.int64()) for c, v in found.items()})

    return left.groupBy("q", "r").cogroup(right.groupBy("q", "r")).applyInArrow(block, "query_id long, vec_id long, score long")


def top_k(queries: DataFrame, rows: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best other rows by integer inner product, ties to smaller ids.

    Both sides are (id, v) of ``quantise``.  Queries and rows are dealt into blocks of
    a fixed size by a hash of the id, and each pair of blocks is one task's work.  The first block of
    rows is searched first; a query's k-th score there is the floor for all other blocks.
    Vectors of different lengths have no score together.  Rows that repeat an id are candidates
    each; a query has no row of its own id as candidate, and rows of one query id share its ranks.  Scores are exact;
    one beyond a long ends the job with an error.  Empty tables give no rows.
    """
    rows = stored(rows)
    nr, nq = -(-rows.count() // ROWS) or 1, -(-queries.count() // QUERIES) or 1
    rows = rows.withColumn("r", F.pmod(F.xxhash64("id", "v"), F.lit(nr)))
    queries = stored(queries).withColumn("floor", F.lit(None).cast("long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = lambda near: near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    near = _near(queries, rows, nq, 0, 1, k)
    if nr > 1:
        near = stored(best(near))
        floors = near.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
        near = near.drop("rank").unionByName(_near(queries.drop("floor").join(floors, "id", "left"), rows, nq, 1, nr, k))
    return best(near).select("query_id", "rank", "vec_id", "score")


def op1_topk(spark, sf_dir):
    rows = quantise(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return top_k(rows.where("id % 20 = 0"), rows)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, r.vec_id,
         CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(r.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v r ON q.vec_id % 20 = 0 AND q.vec_id <> r.vec_id AND len(q.v) = len(r.v)
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 20
"""
