"""Merkle manifest of a dataset: a leaf digest per row, a tree per source, a tree over the sources.

Rows of a source ascend by id; every ``arity`` consecutive nodes hash to their parent until one is
left.  A tree is built by tiers.  The rows of a chunk of arity^levels nodes lie in one window partition; the
node of level l stands on the row of its first leaf, so its siblings stand at fixed distances of
arity^l rows.  Going up, lag and lead columns at those distances, masked by the node's slot and
the length of its run, give the siblings, and the first child's row hashes the parent.  Going
down, lag columns hand a parent's path to the rows of its children.  The chunks' heads are the nodes of
the next tier, so a source of any size is split over many bounded windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailcast.llm.common import numbered, written
from retailcast.operators.ordering import null_safe

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
CHUNK_ROWS = 4_096  # at most so many rows in a window partition
RANGE_ROWS = 50_000  # rows of a sorted range, about
PATH = "array<struct<left:string,right:string>>"


def leaf_digest(fields: list[Column]) -> Column:
    """Digest of a row's fields: "-" for null, else the number of UTF-8 bytes, ":" and the value."""
    parts = []
    for f in fields:
        text = f.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def proof_digest(path: str | Column) -> Column:
    """Digest of all siblings on a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold_path(leaf: str | Column, path: str | Column) -> Column:
    """The root that a leaf digest and the siblings on its path lead to."""
    start = F.col(leaf) if isinstance(leaf, str) else leaf
    return F.aggregate(path, start, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def _levels(arity: int) -> int:
    n = 1
    while arity ** (n + 1) <= CHUNK_ROWS:
        n += 1
    return n


def fold_chunks(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes`` (tree, idx, n, h, ...) with ``path``, the siblings within the chunk, and ``head``, on the first row of a
    chunk the digest of the chunk's top node."""
    levels = _levels(arity)
    chunk = Window.partitionBy("tree", F.floor(F.col("idx") / arity ** levels)).orderBy("idx")
    rows = nodes.withColumn("h0", F.col("h"))

    def shape(level: int) -> tuple[Column, Column, Column, Column]:
        """(row holds a node, its slot, length of its run, nodes of the level)"""
        step = arity ** level
        held = F.ceil(F.col("n") / step)
        at = F.floor(F.col("idx") / step)
        slot = at % arity
        return F.col("idx") % step == 0, slot, F.least(F.lit(arity), held - at + slot), held

    for level in range(levels):
        step, (first, slot, run, held) = arity ** level, shape(level)
        near = {k: f"s{level}_{k}" for k in range(1 - arity, arity) if k}
        rows = rows.select("*", *[(F.lead if k > 0 else F.lag)(f"h{level}", abs(k) * step).over(chunk).alias(c) for k, c in near.items()])
        left = F.concat(F.lit(""), *[F.when(slot >= -k, F.col(near[k])).otherwise("") for k in range(1 - arity, 0)])
        right = F.concat(F.lit(""), *[F.when(slot + k < run, F.col(near[k])).otherwise("") for k in range(1, arity)])
        grows = first & (held > 1)
        rows = rows.select("*", F.when(grows, left).alias(f"l{level}"), F.when(grows, right).alias(f"r{level}")).drop(*near.values())
        parent = F.when(held > 1, F.sha2(F.concat(f"h{level}", f"r{level}"), 256)).otherwise(F.col(f"h{level}"))
        rows = rows.withColumn(f"h{level + 1}", F.when(F.col("idx") % (step * arity) == 0, parent)).drop(f"h{level}")
    rows = rows.withColumnRenamed(f"h{levels}", "head").withColumn("path", F.expr(f"cast(array() as {PATH})"))
    for level in reversed(range(levels)):
        step, (first, slot, _, held) = arity ** level, shape(level)
        above = {k: f"p{k}" for k in range(1, arity)}
        rows = rows.select("*", *[F.lag("path", k * step).over(chunk).alias(c) for k, c in above.items()])
        up = F.col("path")
        for k, c in above.items():
            up = F.when(slot == k, F.col(c)).otherwise(up)
        own = F.array(F.struct(F.col(f"l{level}").alias("left"), F.col(f"r{level}").alias("right")))
        rows = (rows.withColumn("path", F.when(first & (held > 1), F.concat(own, up)).when(first, up))
                .drop(f"l{level}", f"r{level}", *above.values()))
    return rows


def prove(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes`` (tree, idx, n, h, ...) with ``path`` up to their tree's root, and ``root``.

    ``tree`` is a long without null, ``idx`` the position from 0 among the ``n`` nodes of the tree.
    """
    span = arity ** _levels(arity)
    tier = written(fold_chunks(nodes, arity), "tier")
    heads = tier.where(F.col("idx") % span == 0).select(
        "tree", (F.col("idx") / span).cast("long").alias("idx"), F.ceil(F.col("n") / span).alias("n"), F.col("head").alias("h"))
    if (heads.agg(F.max("n")).first()[0] or 0) > 1:
        heads = prove(heads, arity)
    else:
        heads = heads.select("*", F.expr(f"cast(array() as {PATH})").alias("path"), F.col("h").alias("root"))
    heads = heads.select("tree", F.col("idx").alias("chunk"), F.col("path").alias("above"), "root")
    rows = tier.drop("head").withColumn("chunk", F.floor(F.col("idx") / span))
    return rows.join(heads, ["tree", "chunk"]).withColumn("path", F.concat("path", "above")).drop("chunk", "above")


def merkle_manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "source", key: str = "doc_id",
                    arity: int = ARITY, carry: dict[str, Column] | None = None) -> DataFrame:
    """key, group, leaf, path, subroot, root and the columns of ``carry``, for every row of ``docs``.

    ``leaf`` is the digest of ``fields``; ``path`` lists, from the leaf up to the root over all groups, the
    digests of the left and right siblings of each level, joined.  Groups ascend bytewise, null first; rows of
    a group ascend by key, null first, and rows with equal keys by leaf.  Whole copies of a row have equal
    leaves and places of their own.  A group of one row has its leaf as subroot.  An empty table gives no
    row.  ``carry`` names further columns by expressions on ``docs``; other columns are left out, so their names
    don't matter.  Texts are read once and never shuffled.
    """
    named = [F.col(f"`{f}`") for f in fields]
    extra = [c.alias(f"x_{name}") for name, c in (carry or {}).items()]
    leaves = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{group}`").alias("grp"), leaf_digest(named).alias("h"), *extra)
    order = [F.col("grp").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("h")]
    rows = numbered(leaves, order, "leaves", RANGE_ROWS)
    trees = numbered(rows.groupBy("grp").agg(F.min("place").alias("start"), F.count("*").alias("n")), [F.col("grp").asc_nulls_first()], "trees", RANGE_ROWS)
    trees = written(trees.withColumnRenamed("place", "tree"), "trees")
    rows = null_safe(rows, trees, ["grp"]).withColumn("idx", F.col("place") - F.col("start")).drop("place", "start")
    below = prove(rows.withColumn("leaf", F.col("h")), arity)
    # the subroots as one tree over the groups
    subroots = below.where("idx = 0").select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.col("root").alias("h"))
    top = prove(subroots.withColumn("n", F.lit(trees.count()).cast("long")), arity)
    top = written(top.select(F.col("idx").alias("tree"), F.col("path").alias("above"), F.col("root").alias("top")), "top")
    rows = below.join(top, "tree")
    return rows.select(F.col("key").alias(key), F.col("grp").alias(group), "leaf", F.concat("path", "above").alias("path"),
                       F.col("root").alias("subroot"), F.col("top").alias("root"), *[F.col(f"x_{name}").alias(name) for name in (carry or {})])
