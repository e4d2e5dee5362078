"""Merkle dataset manifest: trees of digests, and proofs by a recursive query."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netgroom.llm.common import stored, table
from netgroom.llm.ranking import numbered

#: Nodes that make a parent, and levels that one stored link climbs.
ARITY, STEP = 3, 6
#: Leaves that climb through one copy of a stored node; nodes above more leaves are stored in several copies.
COPY_LEAVES = 4096
#: Up to so many node rows (of a kilobyte or less, their siblings being 12 levels at most) are broadcast, more are joined by a shuffle.
SMALL = 16_384
#: Tree of the subroots; the trees of the groups are numbered from 0.
TOP = -1

_LINK = "up_tree long, up_level int, up_idx long, up_copies long"
_NODE = f"tree long, level int, idx long, hash binary, leaves long, path array<struct<l:binary,r:binary>>, {_LINK}, above binary, above_leaves long"
_NAMES = ["tree", "level", "idx", "hash", "leaves", "path", "up_tree", "up_level", "up_idx", "up_copies", "above", "above_leaves"]


def field(c: Column) -> Column:
    """What a field adds to a leaf: ``-`` for a null, else its bytes in UTF-8 behind their number and a colon."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(fields: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, fields)).cast("binary"), 256))


def _parent(children: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(c.hex().encode() for c in children)).digest()


def paths(hashes: list[bytes], levels: int, arity: int = ARITY) -> tuple[list[list[dict]], bytes]:
    """Siblings left and right of each node's way up ``levels`` levels of a block, and the node above the block."""
    ways: list[list[dict]] = [[] for _ in hashes]
    width = 1
    for _ in range(levels):
        runs = [hashes[k : k + arity] for k in range(0, len(hashes), arity)]
        for k, way in enumerate(ways):
            run, at = divmod(k // width, arity)
            way.append({"l": b"".join(runs[run][:at]), "r": b"".join(runs[run][at + 1 :])})
        hashes = [_parent(run) for run in runs]
        width *= arity
    return ways, hashes[0]


def _height(n: int, arity: int) -> int:
    levels = 0
    while n > 1:
        n, levels = -(-n // arity), levels + 1
    return levels


def _climb_blocks(nodes: DataFrame, level: int, extra: dict[str, str], arity: int, step: int) -> DataFrame:
    """``nodes`` (tree, idx, n, hash, leaves and ``extra``) of one stored level, with their links.

    A block is the nodes under one node of the next stored level, at most ``arity ** step``;
    the first of a block also carries the node above it.
    """
    size = arity**step
    packed = F.struct((F.col("idx") % size).alias("at"), "hash", "leaves", *extra)
    block = F.floor(F.col("idx") / size).cast("long")
    blocks = nodes.groupBy("tree", "n", block.alias("block")).agg(F.sort_array(F.collect_list(packed)).alias("items"))
    schema = _NODE + "".join(f", {c} {kind}" for c, kind in extra.items())
    copies = lambda leaves: -(-leaves // COPY_LEAVES)

    def run(batches):
        for batch in batches:
            for tree, n, block, items in zip(*(c.to_pylist() for c in batch.columns)):
                whole = n <= size
                ways, above = paths([i["hash"] for i in items], _height(n, arity) if whole else step, arity)
                leaves = sum(i["leaves"] for i in items)
                if not whole:
                    up = (tree, level + 1, block, copies(leaves))
                elif tree != TOP:
                    up = (TOP, 0, tree, copies(leaves))
                else:
                    up = (None,) * 4
                out = []
                for k, (item, way) in enumerate(zip(items, ways)):
                    first = (above, leaves) if k == 0 else (None, None)
                    own = (tree, level, block * size + item["at"], item["hash"], item["leaves"], way, *up, *first)
                    out.append((*own, *(item[c] for c in extra)))
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    names = [*_NAMES, *extra]
    way = pa.list_(pa.struct([("l", pa.binary()), ("r", pa.binary())]))
    given = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), way, pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
    kinds += [given[kind] for kind in extra.values()]
    return stored(blocks.select("tree", "n", "block", "items").mapInArrow(run, schema))


def _grow(leaves: DataFrame, extra: dict[str, str], arity: int, step: int) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """Stored levels of all trees of ``leaves`` (tree, idx, n, hash, leaves, extra): the lowest, those above, the subroots."""
    size, level = arity**step, 0
    lowest = nodes = _climb_blocks(leaves, 0, extra, arity, step)
    above, roots = [], []
    while True:
        heads = nodes.where("above is not null")
        roots.append(heads.where("not (up_tree <=> tree)").select("tree", F.col("above").alias("hash"), F.col("above_leaves").alias("leaves")))
        inner = heads.where("up_tree = tree").select("tree", F.col("up_idx").alias("idx"), F.col("above").alias("hash"), F.col("above_leaves").alias("leaves"))
        if inner.isEmpty():
            break
        level += 1
        counts = inner.groupBy("tree").agg(F.count("*").alias("n"))
        nodes = _climb_blocks(inner.join(counts, "tree"), level, {}, arity, step)
        above.append(nodes)
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return lowest, above, found


@dataclass
class Manifest:
    """Leaves and upper nodes, each with its link, and the root (None if empty).

    A link holds the siblings on the way and the node reached, and the subroot if the way passes one.
    """

    leaves: DataFrame
    nodes: DataFrame
    root: bytes | None


def manifest(rows: DataFrame, group: str, order: list[str], extra: dict[str, str], arity: int = ARITY, step: int = STEP) -> Manifest:
    """Trees over ``rows`` (``group``, ``order``, ``hash`` and ``extra`` columns of the given types).

    The leaves of a group ascend by ``order`` (nulls first), then by hash; ``arity``
    neighbours make a node until one, the subroot, is left.  Subroots ascend by group (null
    first, bytes of UTF-8) and make the root in the same way.  All levels are built; every
    ``step``-th is stored as node rows, each with a link to its ancestor ``step`` levels up
    and the siblings on that way.
    """
    ordered = [F.col(c).asc_nulls_first() for c in order] + [F.col("hash").asc()]
    places = numbered(rows, [group], ordered).withColumnRenamed("group_rows", "n")
    trees = numbered(places.where("idx = 0").select(F.col(group).alias("_group")), [], [F.col("_group").asc_nulls_first()])
    trees = stored(trees.select("_group", F.col("idx").alias("tree")))
    leaves = places.join(trees, F.col(group).eqNullSafe(F.col("_group"))).withColumn("leaves", F.lit(1).cast("long"))
    lowest, above, subroots = _grow(leaves.select("tree", "idx", "n", "hash", "leaves", *extra), extra, arity, step)
    n = trees.count()
    top = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(n).cast("long").alias("n"), "hash", "leaves")
    top_lowest, top_above, root = _grow(top, {}, arity, step)
    lower = None
    for level in above:
        lower = level if lower is None else lower.unionByName(level)
    upper = None
    for level in top_above:
        upper = level if upper is None else upper.unionByName(level)
    # a way that ends at a subroot goes on by that subroot's own link
    starts = _through(lowest, top_lowest, n)
    links = top_lowest.limit(0).withColumn("subroot", F.col("hash")) if lower is None else _through(lower, top_lowest, n)
    if upper is not None:
        links = links.unionByName(upper.withColumn("subroot", F.lit(None).cast("binary")))
    found = root.first()
    return Manifest(starts, stored(links), bytes(found.hash) if found else None)


def _through(rows: DataFrame, tops: DataFrame, n: int) -> DataFrame:
    """``rows`` whose links reach a subroot are linked to where the subroot's link (one of ``n``) leads; ``subroot`` is its hash."""
    inside = rows.where(f"up_tree <> {TOP}").withColumn("subroot", F.lit(None).cast("binary"))
    ups = [c.split()[0] for c in _LINK.split(", ")]
    own = [F.col("idx").alias("top_idx"), F.col("hash").alias("top_hash"), F.col("path").alias("top_path"), *(F.col(c).alias(f"top_{c}") for c in ups)]
    top = tops.select(*own)
    ending = rows.where(f"up_tree = {TOP}").join(F.broadcast(top) if n <= SMALL else top, F.col("up_idx") == F.col("top_idx"))
    led = {"path": F.concat("path", "top_path"), "subroot": F.col("top_hash")} | {c: F.col(f"top_{c}") for c in ups}
    return inside.unionByName(ending.withColumns(led).select(*inside.columns))


_FOLD = (
    "aggregate({path}, {start}, (h, s) -> unhex(sha2(cast("
    "concat(lower(hex(s.l)), lower(hex(h)), lower(hex(s.r))) as binary), 256)))"
)
_SIBLINGS = "aggregate({path}, {start}, (p, s) -> concat(p, s.l, s.r))"


def prove(built: Manifest, folded: str, carry: list[str]) -> DataFrame:
    """Every leaf's proof by a recursive query: (hash, ``carry``, subroot, siblings, folded).

    From each leaf the query ascends by the links, appends the siblings on the way (left to
    right, level by level) and folds the digest in column ``folded`` with them; it ends at
    the root.  Copies of upper nodes are met by the leaves in turn, so that the nodes that
    many leaves share are not met in one task.  Spark writes the rows of every round, so a
    link climbs several levels.
    """
    spark = built.leaves.sparkSession
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("leaves") - 1) / COPY_LEAVES).cast("long")))
    nodes = built.nodes.withColumn("copy", copies)
    nodes = F.broadcast(nodes) if nodes.count() <= SMALL else nodes
    listed = "".join(f"{c}, " for c in carry)
    passed = "".join(f"c.{c}, " for c in carry)
    empty = "cast('' as binary)"
    query = f"""
        WITH RECURSIVE climb AS (
          SELECT {listed}hash, idx AS leaf_idx, up_tree, up_level, up_idx, pmod(idx, up_copies) AS up_copy, subroot,
                 {_FOLD.format(path="path", start=folded)} AS folded, {_SIBLINGS.format(path="path", start=empty)} AS siblings
          FROM {{leaves}}
          UNION ALL
          SELECT {passed}c.hash, c.leaf_idx, n.up_tree, n.up_level, n.up_idx, pmod(c.leaf_idx, n.up_copies),
                 coalesce(c.subroot, n.subroot),
                 {_FOLD.format(path="n.path", start="c.folded")}, {_SIBLINGS.format(path="n.path", start="c.siblings")}
          FROM climb c JOIN {{nodes}} n ON c.up_tree = n.tree AND c.up_level = n.level AND c.up_idx = n.idx AND c.up_copy = n.copy
        )
        SELECT {listed}hash, subroot, siblings, folded FROM climb WHERE up_tree IS NULL"""
    option = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(option)
    # every leaf makes a row in each round; the query runs here, under this setting
    spark.conf.set(option, "-1")
    try:
        return stored(spark.sql(query, leaves=built.leaves, nodes=nodes))
    finally:
        spark.conf.set(option, before)


def merkle_proofs(
    docs: DataFrame, fields: list[str], group: str, order: str, tampered: dict[str, Column], arity: int = ARITY, step: int = STEP
) -> DataFrame:
    """A row for each row of ``docs``: (order, leaf, subroot, root, siblings, folded_root, verified).

    A leaf is the digest of ``fields``, each with its length; a null is ``-``.  ``tampered``
    replaces fields in the copy whose digest is folded with the proof of the original leaf.
    Rows without a group are a group of their own; equal rows are leaves side by side and
    answered each; an empty table has no rows.  Columns that are not named play no part.
    Digests are binary, ``siblings`` are all digests of the proof one behind the other.
    """
    taken = {c: F.col(f"`{c}`") for c in fields}
    changed = digest([tampered.get(c, taken[c]) for c in fields])
    rows = docs.select(
        F.col(f"`{group}`").alias("_g"), F.col(f"`{order}`").cast("long").alias("_o"), digest(list(taken.values())).alias("hash"), changed.alias("start")
    )
    built = manifest(stored(rows), "_g", ["_o"], {"_o": "long", "start": "binary"}, arity, step)
    proofs = prove(built, "start", ["_o"])
    root = F.lit(built.root).cast("binary")
    return proofs.select(
        F.col("_o").alias(order), F.col("hash").alias("leaf"), "subroot", root.alias("root"), "siblings", F.col("folded").alias("folded_root"),
        (F.col("folded") == root).alias("verified"),
    )


def op11_merkle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    text = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle_proofs(docs, ["doc_id", "source", "lang", "n_chars", "text"], "source", "doc_id", {"text": text})
    plain = lambda c: F.lower(F.hex(c)).alias(c)
    return found.select(
        "doc_id", plain("leaf"), plain("subroot"), plain("root"), F.sha2(F.lower(F.hex("siblings")).cast("binary"), 256).alias("proof_sha256"),
        plain("folded_root"), "verified",
    )


# A bit by bit CRC-32 stands for the function that DuckDB lacks.
OP11_SQL = """
WITH RECURSIVE d AS (
  SELECT *, CASE WHEN doc_id IS NOT NULL AND list_reduce(
      list_concat([CAST(4294967295 AS BIGINT)], [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
      lambda x, b: list_reduce(list_concat([xor(x, b)], CAST(range(8) AS BIGINT[])), lambda y, i: xor(y >> 1, 3988292384 * (y & 1)))) % 2 = 1
    THEN replace(text, chr(10), '') ELSE text END AS changed
  FROM documents
), f AS (
  SELECT doc_id, source,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS original, coalesce(strlen(changed) || ':' || changed, '-') AS tampered
  FROM d
), l AS (
  SELECT doc_id, source, sha256(head || original) AS leaf, sha256(head || tampered) AS start FROM f
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY source) AS n, row_number() OVER () AS k, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
  FROM l
), built(tree, level, idx, h, n) AS (
  SELECT tree, 0, idx, leaf, n FROM ranked
  UNION ALL
  SELECT tree, level + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3
  FROM built WHERE n > 1 GROUP BY tree, level, idx // 3, n
), tops AS (
  SELECT tree AS idx, h, count(*) OVER () AS n FROM built WHERE n = 1
), top(level, idx, h, n) AS (
  SELECT 0, idx, h, n FROM tops
  UNION ALL
  SELECT level + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3
  FROM top WHERE n > 1 GROUP BY level, idx // 3, n
), nodes AS (
  SELECT tree, level, idx, h, n FROM built WHERE n > 1
  UNION ALL SELECT -1, level, idx, h, n FROM top WHERE n > 1
), ways AS (
  SELECT x.tree, x.level, x.idx, x.n,
    coalesce(string_agg(y.h, '' ORDER BY y.idx) FILTER (y.idx < x.idx), '') AS l,
    coalesce(string_agg(y.h, '' ORDER BY y.idx) FILTER (y.idx > x.idx), '') AS r
  FROM nodes x JOIN nodes y ON x.tree = y.tree AND x.level = y.level AND x.idx // 3 = y.idx // 3
  GROUP BY ALL
), climb(k, own, tree, level, idx, n, folded, proof) AS (
  SELECT r.k, r.tree, r.tree, 0, r.idx, r.n, r.start, '' FROM ranked r
  UNION ALL
  SELECT c.k, c.own, CASE WHEN c.n = 1 THEN -1 ELSE c.tree END, CASE WHEN c.n = 1 THEN 0 ELSE c.level + 1 END,
    CASE WHEN c.n = 1 THEN c.own ELSE c.idx // 3 END, CASE WHEN c.n = 1 THEN (SELECT count(*) FROM tops) ELSE (c.n + 2) // 3 END,
    CASE WHEN c.n = 1 THEN c.folded ELSE sha256(w.l || c.folded || w.r) END, CASE WHEN c.n = 1 THEN c.proof ELSE c.proof || w.l || w.r END
  FROM climb c LEFT JOIN ways w ON c.tree = w.tree AND c.level = w.level AND c.idx = w.idx
  WHERE NOT (c.tree = -1 AND c.n = 1)
), ends AS (
  SELECT k, folded, proof FROM climb WHERE tree = -1 AND n = 1
)
SELECT c0.doc_id, c0.leaf, s.h AS subroot, t.h AS root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root, e.folded = t.h AS verified
FROM ranked c0 JOIN ends e ON e.k = c0.k JOIN tops s ON s.idx = c0.tree JOIN (SELECT h FROM top WHERE n = 1) t ON true
"""
