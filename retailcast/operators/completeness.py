"""Which expected names occur in a listing of keys, by an index of substrings.

A key contains a name only if it contains every k-gram of it.  The k-grams of the names are counted
among the keys; a name with a k-gram that no key has is missing, and every other name is looked up by its
rarest one, so that only the keys with that k-gram are compared with the name.  No name meets every key.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailcast.operators.features import materialize
from retailcast.sources.files import below, list_files

GRAM = 8  # characters of a k-gram; a shorter name is its own


def _grams(text: Column, size: Column) -> Column:
    """Different substrings of ``size`` characters; none if the text is shorter."""
    last = F.char_length(text) - size + 1
    return F.when(last > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substr(text, i, size))))


def found_items(expected: DataFrame, keys: DataFrame) -> DataFrame:
    """(name, found) for every different name of ``expected`` (name), against ``keys`` (key).

    Null names and null keys are left out.  The empty name is found if there is any key.
    """
    names = materialize(expected.select(F.col("name").cast("string")).where("name is not null").distinct()
                        .withColumn("size", F.least(F.char_length("name"), F.lit(GRAM))))
    sizes = sorted(r[0] for r in names.select("size").distinct().collect())  # at most GRAM + 1 numbers
    keys = materialize(keys.select(F.col("key").cast("string")).where("key is not null").distinct())
    wanted = names.where("size > 0").select("name", "size", F.explode(_grams(F.col("name"), F.col("size"))).alias("gram"))
    pieces = keys.select("key", F.explode(F.array(*[F.lit(n) for n in sizes if n] or [F.lit(GRAM)])).alias("size"))
    pieces = pieces.select("key", "size", F.explode(_grams(F.col("key"), F.col("size"))).alias("gram"))
    own = wanted.select("size", "gram").distinct()
    counts = pieces.join(own, ["size", "gram"], "left_semi").groupBy("size", "gram").agg(F.count("*").alias("n"))
    rarest = F.min_by(F.struct("gram", F.coalesce("n", F.lit(0)).alias("n")), F.struct(F.coalesce("n", F.lit(0)), "gram"))
    anchors = wanted.join(counts, ["size", "gram"], "left").groupBy("name", "size").agg(rarest.alias("a"))
    anchors = materialize(anchors.select("name", "size", "a.gram", "a.n"))
    met = (pieces.join(anchors.where("n > 0").select("name", "size", "gram"), ["size", "gram"])
           .where(F.contains("key", "name")).select("name").distinct().withColumn("found", F.lit(True)))
    nameless = names.where("size = 0").select("name", F.lit(keys.limit(1).count() > 0).alias("found"))
    return (names.where("size > 0").select("name").join(met, "name", "left")
            .select("name", F.coalesce("found", F.lit(False)).alias("found")).unionByName(nameless))


def completeness_report(items: DataFrame, keys: DataFrame) -> DataFrame:
    """One row: listed keys, expected, found and missing names, and whether all were found."""
    listed = keys.agg(F.count("key").alias("listed"))
    return (items.agg(F.count("*").alias("expected"), F.count_if("found").alias("found"), F.count_if(~F.col("found")).alias("missing"))
            .crossJoin(F.broadcast(listed))  # one row each
            .select("listed", "expected", "found", "missing", (F.col("missing") == 0).alias("success")))


def artifact_check(spark: SparkSession, root: str, expected: DataFrame, pattern: str = "*") -> tuple[DataFrame, DataFrame]:
    """List the files under ``root`` and look the names of ``expected`` (name) up in their paths: (report, items).

    Names are looked for below ``root``, so its own folders don't count.  A root that does not exist lists nothing.
    """
    try:
        listed = list_files(spark, root, pattern).select("path")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        listed = spark.createDataFrame([], "path string")
    keys = materialize(listed.select(below("path", root).alias("key")))
    items = materialize(found_items(expected, keys))
    return completeness_report(items, keys), items
