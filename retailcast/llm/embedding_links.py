"""Near-duplicate vectors by a PCA-ordered, tiled comparison.

Vectors are scaled to length one and turned so that the directions of largest variance come
first.  Two vectors of cosine t or more lie within sqrt(2 - 2t) of each other in every
direction, so the first one cuts a label into cells of that width of which only neighbours
can hold links.  Cells are cut into tiles of bounded size.  A task compares two tiles: it
multiplies the leading dimensions first, bounds what the rest can still add by the product
of the suffix norms (Cauchy-Schwarz), and goes on only with pairs that can reach the threshold.
A large cell is cut into tiles by ranges of the next two directions, and two tiles meet only if the boxes of their
leading dimensions and suffix norms come within sqrt(2 - 2t) of each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailcast.llm.common import Forest, batch_of, written
from retailcast.llm.components import connected_components

TILE_ROWS = 2048
STAGES = (8, 16, 32)  # dimensions after which the bound is checked
SLACK = 1e-9  # far above the rounding of a bound, far below what would let many pairs through
ROWS_AT_ONCE, PAIRS_AT_ONCE = 256, 1 << 16
CELL = ["label", "dim", "cell"]


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision (scaled by the largest part first: no overflow)."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def close_pairs(a: np.ndarray, b: np.ndarray, turn: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j) of all rows of ``a`` and ``b`` (unit length) with cosine >= threshold, part by part."""
    za, zb = a @ turn, b @ turn
    d = za.shape[1]
    steps = [s for s in STAGES if s < d] + [d]
    # norms of what is left after each step
    rest_a = [np.sqrt(np.maximum(0, (za[:, s:] ** 2).sum(axis=1))) for s in steps]
    rest_b = [np.sqrt(np.maximum(0, (zb[:, s:] ** 2).sum(axis=1))) for s in steps]
    for at in range(0, len(za), ROWS_AT_ONCE):
        head = za[at:at + ROWS_AT_ONCE]
        lead = head[:, :steps[0]] @ zb[:, :steps[0]].T
        i, j = np.nonzero(lead + np.outer(rest_a[0][at:at + ROWS_AT_ONCE], rest_b[0]) >= threshold - SLACK)
        sums = lead[i, j]
        for p in range(0, len(i), PAIRS_AT_ONCE):
            x, y, s = i[p:p + PAIRS_AT_ONCE] + at, j[p:p + PAIRS_AT_ONCE], sums[p:p + PAIRS_AT_ONCE]
            for k in range(1, len(steps)):
                part = slice(steps[k - 1], steps[k])
                s = s + np.einsum("ij,ij->i", za[x, part], zb[y, part])
                on = s + rest_a[k][x] * rest_b[k][y] >= threshold - SLACK
                x, y, s = x[on], y[on], s[on]
            on = np.einsum("ij,ij->i", a[x], b[y]) >= threshold  # the cosine itself, as the vectors came
            yield x[on], y[on]


def _axes(turns: dict[int, np.ndarray], dim: int) -> np.ndarray:
    return turns[dim] if dim in turns else np.eye(dim)


def _tile(turns: dict[int, np.ndarray]):
    def tile(pdf: pd.DataFrame) -> pd.DataFrame:
        """One tile: its vectors at length one, and the box of their leading dimensions and the norm of the rest."""
        pdf = pdf.sort_values("rep")
        first = pdf.iloc[0]
        rows = unit(np.array(pdf["vec"].tolist(), dtype=np.float64))
        turned = rows @ _axes(turns, int(first["dim"]))
        box = np.column_stack([turned[:, :STAGES[0]], np.sqrt((turned[:, STAGES[0]:] ** 2).sum(axis=1))])
        own = {c: [first[c]] for c in ("label", "dim", "cell")}
        return pd.DataFrame(own | {"tile": ["/".join(str(first[c]) for c in (*CELL, "range_y", "range_z", "sub"))],
                                   "low": [box.min(axis=0).tolist()], "high": [box.max(axis=0).tolist()],
                                   "reps": [pdf["rep"].to_numpy("<i8").tobytes()],
                                   "copies": [pdf["copies"].to_numpy("<i8").tobytes()], "vecs": [rows.tobytes()]})
    return tile


def _compare(turns: dict[int, np.ndarray], threshold: float):
    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        """Links of one pair of tiles (or a tile with itself): rows (rep, its links, rep of its group in here)."""
        pdf = pdf.sort_values("side")
        reps = [np.frombuffer(x, "<i8") for x in pdf["reps"]]
        copies = [np.frombuffer(x, "<i8") for x in pdf["copies"]]
        dim = int(pdf["dim"].iloc[0])
        rows = [np.frombuffer(x, np.float64).reshape(-1, dim) for x in pdf["vecs"]]
        alone, n = len(rows) == 1, len(reps[0])
        turn = _axes(turns, dim)
        ids, weight = np.concatenate(reps), np.concatenate(copies)
        links, forest = np.zeros(len(ids), dtype=np.int64), Forest(len(ids))
        for i, j in close_pairs(rows[0], rows[-1], turn, threshold):
            if alone:
                i, j = i[i < j], j[i < j]
            else:
                j = j + n
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
            forest.link(i, j)
        x = np.nonzero(links)[0]
        return pd.DataFrame({"rep": ids[x], "links": links[x], "root": ids[forest.find(x)]})
    return compare


def _cells(turns: dict[int, np.ndarray], width: float):
    step = max(width / 16, 1 / 256)  # of the buckets that ranges are cut from: at most 512 a direction

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, vecs = np.zeros((batch.num_rows, 3), dtype=np.int64), batch.column("vec")
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                at = np.nonzero(dims == dim)[0]
                rows = unit(np.array([vecs[int(i)].as_py() for i in at], dtype=np.float64))
                lead = rows @ _axes(turns, int(dim))[:, :3]
                out[at, :lead.shape[1]] = np.floor(lead / np.array([width, step, step])[:lead.shape[1]])
            for k, name in enumerate(("cell", "y", "z")):
                batch = batch.append_column(name, pa.array(out[:, k]))
            yield batch
    return cells


def _range_number(keys: list[str], bucket: str, ranges: Column) -> Column:
    """The range of a bucket among its ``keys``: ``ranges`` of about equal numbers of rows ``n`` in bucket order."""
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) * ranges / F.sum("n").over(Window.partitionBy(*keys)))


def _ranges(placed: DataFrame, tile_rows: int) -> DataFrame:
    """(label, dim, cell, y, z, range_y, range_z, subs): the tile ranges of every bucket of the next two directions.

    A cell is cut on y into the square root of its number of tiles, and each of these on z.  A range that
    still holds more than ``tile_rows`` (one crowded bucket) falls into ``subs`` parts.
    """
    buckets = placed.groupBy(*CELL, "y", "z").agg(F.count("*").alias("n"))
    tiles = lambda keys: F.ceil(F.sum("n").over(Window.partitionBy(*keys)) / tile_rows)
    on_y = (buckets.groupBy(*CELL, "y").agg(F.sum("n").alias("n"))
            .select(*CELL, "y", _range_number(CELL, "y", F.ceil(F.sqrt(tiles(CELL)))).alias("range_y")))
    buckets = written(buckets.join(on_y, [*CELL, "y"]), "buckets")
    row = [*CELL, "range_y"]
    on_z = (buckets.groupBy(*row, "z").agg(F.sum("n").alias("n"))
            .select(*row, "z", "n", _range_number(row, "z", tiles(row)).alias("range_z"))
            .select(*row, "z", "range_z", tiles([*row, "range_z"]).alias("subs")))
    return buckets.drop("n").join(on_z, [*row, "z"])


def _meeting(tiles: DataFrame, threshold: float) -> DataFrame:
    """(one, two): each pair of tiles once, a tile with itself too, whose boxes can hold a link.

    Rows without the vectors: a cell meets itself and the next one, and boxes whose gaps add up to more
    than the largest squared distance of a link, 2 - 2t, are left out.
    """
    names = tiles.select(*CELL, "tile", "low", "high")
    left = names.select("label", "dim", F.explode(F.array(F.col("cell"), F.col("cell") + 1)).alias("cell"), F.col("cell").alias("own"),
                        F.col("tile").alias("one"), F.col("low").alias("own_low"), F.col("high").alias("own_high"))
    gap = F.zip_with(F.zip_with("low", "own_high", lambda x, y: x - y), F.zip_with("own_low", "high", lambda x, y: x - y),
                     lambda x, y: F.pow(F.greatest(x, y, F.lit(0.0)), 2))
    apart = F.aggregate(gap, F.lit(0.0), lambda s, x: s + x)
    return (left.join(names, CELL).where("own < cell or one <= tile").where(apart <= 2 - 2 * threshold + 1e-6)
            .select("one", F.col("tile").alias("two")))


def principal_axes(reps: DataFrame) -> dict[int, np.ndarray]:
    """Orthogonal axes by falling variance for the most frequent vector length (others: as they are)."""
    sizes = reps.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(1).collect()
    if not sizes or sizes[0]["count"] < 2 or sizes[0]["dim"] < 2:
        return {}
    dim = int(sizes[0]["dim"])
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    scaled = reps.where(F.col("dim") == dim).withColumn("norm", norm).where("norm > 0 and norm < double('inf')")
    vectors = scaled.select(array_to_vector(F.transform("vec", lambda x: x / F.col("norm"))).alias("v"))
    axes = PCA(k=dim, inputCol="v", outputCol="p").fit(vectors).pc.toArray()
    # any orthogonal matrix keeps the products; if the fit isn't one, go without
    return {dim: axes} if np.allclose(axes.T @ axes, np.eye(dim), atol=1e-9) else {}


def link_embeddings(vectors: DataFrame, threshold: float = 0.98, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links between all rows of ``vec_id, embedding, label`` with equal labels and cosine >= threshold.

    Returns vec_id, n_links, component_id, kept, one row per input row.  A row whose label, id or
    vector is null, or whose vector is empty, zero or holds a null or non-finite part, links with
    nothing: n_links 0, component_id its own id, kept true (null id: component_id null, kept false).
    Vectors of different length don't link.  Rows with equal label and vector are copies: they are
    compared once and count as linked with each other.  Other columns are left out.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must lie in (0, 1]")
    inf = F.lit(math.inf)
    sound = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)
             & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)) & F.exists("vec", lambda x: x != 0))
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vec"))
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    good = rows.where("sound")
    reps = written(good.groupBy("label", "vec").agg(F.min("vec_id").cast("long").alias("rep"), F.count("*").alias("copies"))
                   .withColumn("dim", F.size("vec").cast("long")), "vectors")
    turns = principal_axes(reps)
    width = math.sqrt(2 - 2 * threshold) + 1e-6
    placed = reps.mapInArrow(_cells(turns, width), _with(reps, "cell long, y long, z long"))
    placed = written(placed, "cells")
    tile = [*CELL, "range_y", "range_z", "sub"]
    tiles = (placed.join(_ranges(placed, tile_rows), [*CELL, "y", "z"])
             .withColumn("sub", F.pmod(F.xxhash64("rep"), F.col("subs"))).select(*tile, "rep", "copies", "vec")
             .repartition(*tile)  # else the join's deal, by bucket, would serve the groups too
             .groupBy(*tile).applyInPandas(
                 _tile(turns), f"label {reps.schema['label'].dataType.simpleString()}, dim long, cell long, tile string, "
                               "low array<double>, high array<double>, reps binary, copies binary, vecs binary"))
    tiles = written(tiles, "tiles")
    meet = _meeting(tiles, threshold)
    sides = meet.select("one", "two", F.lit(0).alias("side"), F.col("one").alias("tile")).union(
        meet.where("one != two").select("one", "two", F.lit(1), F.col("two")))
    found = written(sides.join(tiles.select("tile", "dim", "reps", "copies", "vecs"), "tile")
                    .groupBy("one", "two").applyInPandas(_compare(turns, threshold), "rep long, links long, root long"), "found")
    groups = connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    per_rep = (reps.select("label", "vec", "rep", "copies").join(linked, "rep", "left")
               .join(groups.withColumnRenamed("node", "rep"), "rep", "left")
               .select("label", "vec", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                       F.coalesce("component", "rep").alias("component_id")))
    matched = good.join(per_rep, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    single = rows.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return matched.union(single).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _with(df: DataFrame, more: str) -> str:
    return ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields] + [more])
