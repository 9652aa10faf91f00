"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A source whose target is c times its size gives floor(c) complete epochs; the words still
missing are drawn without replacement: every document gets the key -ln(u) / w, with u uniform
from a hash of its id and w its quality weight, documents are taken in ascending order of the
key, and a running sum stops at the budget.  Smaller keys come first, so a document's chance
grows with its weight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailcast.llm.common import word_count, written

WEIGHTS = (5.0, 2.0, 1.0)
MOST_EPOCHS = 3
BUCKET_ROWS = 5_000  # rows of a key range that are sorted in one go, about


def uniform(seed: int) -> Column:
    """A number in (0, 1) from the id (null: as the text "null") and the seed: 48 bits of an MD5."""
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(f":{seed}"))
    return (F.conv(F.substring(F.md5(name), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size, target) from ``source, source_size``.

    Sources by code point, null last, take the weights in turn.  All sizes are shared by weight; a
    target stops at ``most`` times its source's size, and the excess is shared again until none is
    above.  Sorted by cap per weight the capped sources come first, so the common share per weight
    of the rest is found with running sums.  One row per source goes to one task.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(order) - 1) % n + 1)
    s = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size").cast("double") * most)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything).cast("double")
    # the share per weight if all sources before this one are capped: it rises up to the first source
    # that isn't, and falls after it
    share = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    s = s.withColumn("share", share)
    level = F.max("share").over(everything)
    return s.select("source", "source_size", F.least("cap", level * F.col("weight")).alias("target"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_EPOCHS, seed: int = 11,
        quality: DataFrame | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, source, size, source_size, target, epochs, taken for every row of ``doc_id, text, source``.

    ``size`` is the number of words (null text: 0), ``epochs`` how often the mix holds the row, and
    ``taken`` = size * epochs.  ``quality`` (doc_id, weight > 0) scales the keys; rows without one have
    weight 1.  Nulls in source are a source of their own.  Rows that repeat an id share a key and are
    taken in order of size; an empty table gives no row; other columns are left out.  The row that
    crosses a budget is taken if that comes nearer to it.

    A source is cut into key ranges of about equal numbers of rows, whatever its weights.  Weights that are not positive
    numbers count as 1.  Ranges below the budget are taken
    whole by their sums, and only the range that holds the budget is sorted, so a source of any size
    is split over tasks.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "source", word_count().alias("size"))
    if quality is not None:
        per_id = quality.select(F.col("doc_id").cast("long"), F.col("weight").cast("double")).where(
            "doc_id is not null and weight > 0 and weight < double('Infinity')")  # NaN is greater than infinity
        rows = rows.join(per_id.groupBy("doc_id").agg(F.max("weight").alias("weight")), "doc_id", "left")
    else:
        rows = rows.withColumn("weight", F.lit(1.0))
    rows = rows.withColumn("weight", F.coalesce("weight", F.lit(1.0))).withColumn("draw", -F.ln(uniform(seed)) / F.col("weight"))
    # weights by powers of two, 129 kinds at most
    kind = F.greatest(F.lit(-64), F.least(F.lit(64), F.floor(F.log2("weight"))))
    rows = written(rows.select("doc_id", "source", "size", "draw", "weight", kind.alias("kind")), "mix")
    kinds = rows.groupBy("source", "kind").agg(F.sum("size").alias("size"), F.count("*").alias("rows"), F.avg("weight").alias("weight"))
    sizes = written(kinds.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum("rows").alias("rows"),
                                                F.collect_list(F.struct("weight", F.col("rows").cast("double").alias("rows"))).alias("kinds")), "sizes")
    targets = source_targets(sizes.select("source", "source_size"), weights, most)
    ranges = sizes.select("source", "rows", "kinds", (1 + F.floor(F.col("rows") / bucket_rows)).alias("ranges"))
    plan = targets.join(ranges, targets["source"].eqNullSafe(ranges["source"])).select(
        targets["source"], "source_size", "target", "ranges", "rows", "kinds",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).alias("full"))
    plan = written(plan.withColumn("budget", F.col("target") - F.col("full") * F.col("source_size")), "plan")
    # the share of a source's rows expected below a draw, given its weights: rises with the draw, and in even steps
    below = F.aggregate("kinds", F.lit(0.0), lambda s, k: s + k["rows"] * (1 - F.exp(-k["weight"] * F.col("draw"))))
    at = F.floor(below / F.col("rows") * F.col("ranges"))
    rows = (rows.drop("weight", "kind").join(plan, rows["source"].eqNullSafe(plan["source"])).drop(plan["source"])
            .withColumn("range", F.least(at, F.col("ranges") - 1)))
    sums = rows.groupBy("source", "range").agg(F.sum("size").alias("held"), F.first("budget").alias("budget"))
    below = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("low", F.coalesce(F.sum("held").over(below), F.lit(0))).select(
        F.col("source").alias("s"), F.col("range").alias("r"), "low",
        F.when(F.col("low") + F.col("held") <= F.col("budget"), "all").when(F.col("low") >= F.col("budget"), "none")
        .otherwise("part").alias("how"))
    rows = rows.join(sums, rows["source"].eqNullSafe(F.col("s")) & (F.col("range") == F.col("r"))).drop("s", "r")
    run = Window.partitionBy("source").orderBy("draw", "size", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    split = rows.where("how = 'part'").withColumn("before", F.col("low") + F.coalesce(F.sum("size").over(run), F.lit(0)))
    # taken if at least half of the row lies below the budget
    extra = F.when(F.col("before") + F.col("size") / 2 <= F.col("budget"), 1).otherwise(0)
    columns = ["doc_id", "source", "size", "source_size", "target", "full"]
    drawn = split.select(*columns, extra.alias("extra")).union(
        rows.where("how != 'part'").select(*columns, F.when(F.col("how") == "all", 1).otherwise(0)))
    # a source that stops at the cap has no budget left beyond its full epochs
    epochs = F.least(F.col("full") + F.col("extra"), F.lit(most)).cast("long")
    return drawn.select("doc_id", "source", "size", "source_size", "target", epochs.alias("epochs"),
                        (F.col("size") * epochs).alias("taken"))
