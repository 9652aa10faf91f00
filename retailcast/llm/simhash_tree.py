"""SimHash near-duplicates through a vantage-point tree over the fingerprints.

A tree node holds a vantage fingerprint v and a radius m: fingerprints within distance m of v
go to the inner branch, the rest to the outer one.  By the triangle inequality a partner
within r of x lies in the inner branch only if d(x, v) - r <= m, and in the outer one only if
d(x, v) + r > m; all other branches are pruned.  The leaves are the shards: a fingerprint is
stored in one, and is sent as a query to those later shards that its ball overlaps.  Within a
shard the same bounds prune again, on further vantage points, before pairs are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailcast.llm.common import Forest, batch_of, columns_of, slices, text_bytes, written
from retailcast.llm.components import connected_components

SHINGLE, MAX_BITS, SEED = 3, 3, 42
LEAF_ROWS = 4096  # fingerprints stored in a shard, at least about
SHARDS, LEAF_MOST = 64, 1 << 20  # shards grow before their number does, up to 8 MB of fingerprints
SAMPLE_PER_LEAF, SAMPLE_MOST = 64, 1 << 17  # of the sample that the tree's cuts are fitted on
BRUTE_PAIRS, BRUTE_QUERIES, LEVELS = 1 << 16, 32, 8  # pairs, queries and depth beyond which no vantage point is taken
PAIRS_AT_ONCE = 1 << 22


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of a text's word shingles, as a signed integer (no words: 0).

    A-Z are lower-cased; fewer words than ``shingle``: the whole sequence is one shingle.
    """
    words = text.lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [h(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])[:len(words) - shingle + 1]
        hashes = [h(joined[a:b], seed) for a, b in zip(starts.tolist(), ends[shingle - 1:].tolist())]
    bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at:at + (1 << 16)], dtype="<u8")
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view("<i8")[0])


def _fingerprints(shingle: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch):
                fps = [fingerprint(t.as_py(), shingle, seed) for t in some.column("data")]
                yield pa.record_batch([some.column("doc_id"), pa.array(fps, pa.int64())], names=["doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp) of ``doc_id, text``; null text has no words.  One row per input row."""
    rows = docs.select(F.col("doc_id").cast("long"), text_bytes().alias("data"))
    return rows.mapInArrow(_fingerprints(shingle, seed), "doc_id long, fp long")


def distance(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class Tree:
    """Vantage points and radii as arrays; node n has the branches 2n+1 (inner) and 2n+2 (outer)."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        inner = (1 << depth) - 1
        self.vantage, self.radius = np.zeros(inner, np.uint64), np.full(inner, 32)
        parts = {0: sample}
        for n in range(inner):
            part = parts.pop(n)
            if len(part):
                # the vantage point, of a few candidates, that spreads its part widest
                some = part[:: max(1, len(part) // 8)][:8]
                spread = [distance(part, v).astype(float).var() for v in some]
                self.vantage[n] = some[int(np.argmax(spread))]
                self.radius[n] = int(np.median(distance(part, self.vantage[n])))
            d = distance(part, self.vantage[n])
            parts[2 * n + 1], parts[2 * n + 2] = part[d <= self.radius[n]], part[d > self.radius[n]]

    def leaf(self, fps: np.ndarray) -> np.ndarray:
        """The shard that stores each fingerprint, from 0."""
        node = np.zeros(len(fps), dtype=np.int64)
        for _ in range(self.depth):
            node = 2 * node + np.where(distance(fps, self.vantage[node]) <= self.radius[node], 1, 2)
        return node - len(self.vantage)

    def queries(self, fps: np.ndarray, home: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray]]:
        """(shard, positions) of the fingerprints that must be compared there and are stored in an earlier one."""
        todo = [(0, np.arange(len(fps)))]
        first = len(self.vantage)
        while todo:
            n, at = todo.pop()
            # last shard below this node: a fingerprint stored at or after it has no later shard here
            last = n
            while last < first:
                last = 2 * last + 2
            at = at[home[at] < last - first]
            if not len(at):
                continue
            if n >= first:
                yield n - first, at
                continue
            d = distance(fps[at], self.vantage[n]).astype(np.int64)
            todo += [(2 * n + 1, at[d - reach <= self.radius[n]]), (2 * n + 2, at[d + reach > self.radius[n]])]


def near(q: np.ndarray, t: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j) with distance(q[i], t[j]) <= reach, by vantage points and the triangle inequality."""
    todo = [(np.arange(len(q)), np.arange(len(t)), 0)]
    while todo:
        qi, ti, level = todo.pop()
        if not len(qi) or not len(ti):
            continue
        if len(qi) * len(ti) > BRUTE_PAIRS and len(qi) >= BRUTE_QUERIES and level < LEVELS:
            v = t[ti[(level * 7919) % len(ti)]]
            dq, dt = distance(q[qi], v), distance(t[ti], v)
            if int(dt.max()) - int(dt.min()) > 2 * reach or int(dq.max()) - int(dq.min()) > 2 * reach:
                order = np.argsort(dt, kind="stable")
                ti, dt = ti[order], dt[order]
                for d in np.unique(dq):
                    low, high = np.searchsorted(dt, max(0, int(d) - reach)), np.searchsorted(dt, int(d) + reach, "right")
                    todo.append((qi[dq == d], ti[low:high], level + 1))
                continue
        step = max(1, PAIRS_AT_ONCE // len(ti))
        for at in range(0, len(qi), step):
            some = qi[at:at + step]
            i, j = np.nonzero(distance(q[some][:, None], t[ti][None, :]) <= reach)
            yield some[i], ti[j]


PACKED = "leaf long, stored boolean, n long, fps binary"


def _deal(tree: Tree, reach: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            home = tree.leaf(fps)
            rows = [(int(x), True, int((home == x).sum()), fps[home == x].tobytes()) for x in np.unique(home)]
            rows += [(x, False, len(at), fps[at].tobytes()) for x, at in tree.queries(fps, home, reach)]
            yield batch_of(PACKED, rows)
    return deal


SPLIT = "leaf long, stored boolean, part long, held long, asked long, fps binary"


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Deals the fingerprints of a shard of ``held`` stored and ``asked`` query parts over these, by a hash."""
    for batch in batches:
        for leaf, stored, held, asked, packed in zip(*columns_of(batch, "leaf", "stored", "held", "asked", "fps")):
            fps = np.frombuffer(packed, np.uint64)
            share = (fps * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(held if stored else asked)
            yield batch_of(SPLIT, [(leaf, stored, int(x), held, asked, fps[share == x].tobytes()) for x in np.unique(share)])


def _search(reach: int):
    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        """One stored part of a shard against another part, stored or of queries, or against itself."""
        fps = lambda own: np.frombuffer(b"".join(pdf.loc[pdf["own"] == own, "fps"]), np.uint64)
        target, others = fps(True), fps(False)
        nodes = np.concatenate([target, others])
        forest, alone = Forest(len(nodes)), pdf["target"].iloc[0] == pdf["other"].iloc[0]
        for i, j in near(target if alone else others, target, reach):
            forest.link(i if alone else i + len(target), j)
        # only linked pairs are joined, and a fingerprint is at most once in a shard
        x, r = forest.edges()
        return pd.DataFrame({"a": nodes[x].view(np.int64), "b": nodes[r].view(np.int64)})
    return search


def _pairs_of_parts(dealt: DataFrame, part_rows: int) -> DataFrame:
    """(leaf, target, other, own, fps): the parts of each shard, once for each pair of parts they belong to.

    Stored parts are numbered from 0 and query parts after them; a target is a stored part, and
    ``other`` is itself, a stored part before it or a query part.  A pair holds about two times ``part_rows``.
    """
    many = lambda own: F.ceil(F.sum(F.when(F.col("stored") == own, F.col("n")).otherwise(0)) / part_rows)
    sizes = dealt.groupBy("leaf").agg(many(True).alias("held"), many(False).alias("asked")).where("held > 0")
    split = dealt.join(sizes, "leaf").mapInArrow(_split, SPLIT)
    pairs = F.expr("""CASE WHEN stored THEN concat(
        transform(sequence(0L, part), o -> struct(part AS target, o AS other, true AS own)),
        transform(IF(asked > 0, sequence(held, held + asked - 1), CAST(array() AS array<bigint>)), o -> struct(part AS target, o AS other, true AS own)),
        transform(IF(part + 1 < held, sequence(part + 1, held - 1), CAST(array() AS array<bigint>)), t -> struct(t AS target, part AS other, false AS own)))
        ELSE transform(sequence(0L, held - 1), t -> struct(t AS target, held + part AS other, false AS own)) END""")
    return split.withColumn("pair", F.explode(pairs)).select("leaf", "pair.target", "pair.other", "pair.own", "fps")


def fingerprint_links(fps: DataFrame, reach: int = MAX_BITS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Edges (a, b) between the different values of long column ``fp`` that join all within ``reach`` bits.

    Every such pair ends up in one component; an edge itself may join two ends of a chain of links.
    Shards hold ``leaf_rows`` or more: a query goes to the more shards the more there are, so from SHARDS on they grow
    to LEAF_MOST before their number does, and the bounds prune within them.  A shard far beyond that (many near
    copies in one ball) is searched in pairs of parts, so that a task's rows don't grow with the ball; their number
    does, with its square.
    """
    fps = written(fps.select("fp").distinct(), "fingerprints")
    total = fps.count()
    leaf_rows = max(leaf_rows, min(-(-total // SHARDS), LEAF_MOST))
    depth = max(0, int(np.ceil(np.log2(max(1, total) / leaf_rows))))
    # a sample in hash order: bounded, the same on every run; only the cuts of the tree rest on it
    size = min(SAMPLE_MOST, SAMPLE_PER_LEAF << depth)
    sample = [r["fp"] for r in fps.orderBy(F.xxhash64("fp")).limit(size).collect()] if depth else []
    tree = Tree(np.array(sample, dtype=np.int64).view(np.uint64), depth)
    dealt = written(fps.mapInArrow(_deal(tree, reach), PACKED), "shards")
    return _pairs_of_parts(dealt, min(4 * leaf_rows, max(LEAF_MOST, leaf_rows))).groupBy("leaf", "target", "other").applyInPandas(_search(reach), "a long, b long")


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, reach: int = MAX_BITS, seed: int = SEED,
                       leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of ``doc_id, text``, one row per input row.

    component_id is the smallest doc_id reachable over pairs of fingerprints that differ in at most
    ``reach`` bits.  Rows with null or empty text have fingerprint zero and link like any other; a
    null doc_id takes part in links but never names a component (alone: component_id null).
    Copies share a fingerprint, which is searched once.  A text of any length counts as a whole, its hashes
    65,536 at a time.  Other columns are left out.
    """
    fps = written(fingerprints(docs, shingle, seed), "simhash")
    reps = written(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "reps")
    edges = fingerprint_links(reps, reach, leaf_rows)
    groups = connected_components(edges).select(F.col("node").alias("fp"), F.col("component").alias("root"))
    rooted = reps.join(groups, "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    names = rooted.join(least, "root").select("fp", "component_id")
    return fps.join(names, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
