"""Connected components of a link table, by alternating star contractions.

Links stay in tables that are split over executors.  A first pass replaces the links
of each partition by a spanning forest; then large-star and small-star steps
(Kiveris et al., "Connected components in MapReduce and beyond") run until every node
points straight at the smallest node it can reach.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailcast.llm.common import Forest, written

EDGE = "a long, b long"


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        a, b = pdf["a"].to_numpy(np.int64), pdf["b"].to_numpy(np.int64)
        ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        f = Forest(len(ids))
        f.link(at[:len(a)], at[len(a):])
        x, r = f.edges()
        yield pd.DataFrame({"a": ids[x], "b": ids[r]})


def _large_star(e: DataFrame) -> DataFrame:
    """Point every larger neighbour of a node at the smallest node next to it."""
    both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """Point a node and its smaller neighbours at the smallest of them (edges are a > b)."""
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = e.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _is_star(e: DataFrame) -> bool:
    """True if each larger node has one edge and no smaller end is itself a larger end."""
    ends = e.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        e.select(F.col("b").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    per = ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per.where("up > 1 or (up = 1 and down = 1)").limit(1).count() == 0


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link; component is the smallest node reachable.

    ``edges`` has long columns a, b; repeats, both directions and loops are allowed, rows with
    a null end are ignored.  No links: no rows.
    """
    e = (edges.where("a is not null and b is not null and a != b")
         .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    e = written(e.mapInPandas(_forest, EDGE).distinct(), "links")
    while not _is_star(e):
        e = written(_small_star(_large_star(e)), "links")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
