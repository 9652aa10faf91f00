"""File-level sources and sinks: tolerant and sampled multi-file scans, listings, writers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet_tolerant(spark: SparkSession, root: str, schema: T.StructType | None = None,
                          partition_filter=None, recursive: bool = False) -> DataFrame:
    """Scan every parquet file under ``root``; unreadable and zero-byte files are skipped.

    ``recursive`` also reads folders not named column=value, and then makes no columns of folder names.

    ``partition_filter`` (a Column on partition columns) is pruned at planning
    time, which replaces reading "the first N files".  Pass ``schema``: inferring
    it would read one footer, which may be the corrupt file.
    """
    r = spark.read.option("ignoreCorruptFiles", "true").option("mergeSchema", "false")
    if recursive:
        r = r.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(root)
    return df.where(partition_filter) if partition_filter is not None else df


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Fail fast when nothing was readable (one tiny job: ``limit(1)``)."""
    if df.limit(1).count() == 0:
        raise ValueError(f"no readable rows in {what}")
    return df


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, length, modified) of files under ``root``; file contents are never read.

    Zero-byte files do not appear in the listing.
    """
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", pattern).load(root)
                 .select("path", "length", F.col("modificationTime").alias("modified")))


def below(path, root: str) -> F.Column:
    """A path without the ``root`` it lies under, whatever the scheme is written like."""
    plain = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/+", "/", root).rstrip("/")
    return F.substring_index(path, plain + "/", -1)


def sample_files(spark: SparkSession, root: str, n: int, seed: int | None = None, pattern: str = "*.parquet",
                 keep: Column | None = None) -> list[str]:
    """``n`` files under ``root``: the first in path order, or with a ``seed`` those with the smallest hash of path and seed.

    ``keep`` is a predicate on the listing (path, length, modified).  Only the chosen paths reach the driver.
    """
    listed = list_files(spark, root, pattern)
    listed = listed.where(keep) if keep is not None else listed
    # the path below the root, so that a copy of the data elsewhere gives the same sample
    order = [F.xxhash64(F.lit(seed), below("path", root)), "path"] if seed is not None else ["path"]
    return [r["path"] for r in listed.orderBy(*order).limit(n).select("path").collect()]


def read_sample(spark: SparkSession, root: str, n: int, schema: T.StructType | None = None, seed: int | None = None,
                pattern: str = "*.parquet", keep: Column | None = None) -> DataFrame:
    """A scan of ``sample_files`` only: the other files are not part of its plan.

    Folders named column=value below ``root`` give their columns as in a scan of all files.  No file: ValueError.
    """
    paths = sample_files(spark, root, n, seed, pattern, keep)
    if not paths:
        raise ValueError(f"no file to sample in {root}")
    reader = spark.read.option("basePath", root)
    return (reader.schema(schema) if schema is not None else reader).parquet(*paths)


def tolerant_load(spark: SparkSession, root: str, schema: T.StructType, target: str) -> tuple[DataFrame, DataFrame]:
    """Copy the readable rows under ``root`` to ``target`` in one scan; returns (rows, report).

    The report has one row per listed file (file, length, n_rows, status read or skipped), and is made from
    the copy, which keeps each row's file until the report is written beside it: what it calls read is what the scan
    gave.  A file that is damaged or has no rows is skipped.  Folder names give no columns.
    """
    from retailcast.sources.footers import read_footers

    scan = read_parquet_tolerant(spark, root, schema, recursive=True)
    scan.select(norm_path(F.col("_metadata.file_path")).alias("__file"), "*").write.parquet(f"{target}/rows")
    copy = spark.read.schema(T.StructType([T.StructField("__file", T.StringType()), *schema.fields])).parquet(f"{target}/rows")
    seen = copy.groupBy("__file").agg(F.count("*").alias("n_rows"))
    facts = read_footers(spark, root, schema=schema).select(F.col("path").alias("file"), "length", "problem")
    both = facts.join(seen, facts["file"] == seen["__file"], "left")
    skipped = F.col("n_rows").isNull()
    both.select("file", "length", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.when(skipped, "skipped").otherwise("read").alias("status"),
                # a file whose footer is sound, but whose pages are not
                F.when(skipped, F.coalesce("problem", F.lit("damaged pages"))).alias("reason")).write.parquet(f"{target}/report")
    return copy.drop("__file"), spark.read.parquet(f"{target}/report")


ROWS_PER_FILE = 5_000_000


def write_partitioned(df: DataFrame, root: str, by=("year", "month", "day"), date_col: str = "date") -> None:
    """Hive-style daily folders; only the partitions present in ``df`` are replaced."""
    d = F.col(date_col)
    parts = {"year": F.year(d), "month": F.lpad(F.month(d).cast("string"), 2, "0"),
             "day": F.lpad(F.dayofmonth(d).cast("string"), 2, "0")}
    _write_folders(df.withColumns({p: parts[p] for p in by if p in parts and p not in df.columns}), root, by)


def _write_folders(df: DataFrame, root: str, by) -> None:
    """Replace the folders that ``df`` has rows for.  Spark deals the rows of a folder to one task, and splits a folder
    of very many rows when it has measured it (rebalance), so a hot day is written by several tasks."""
    (df.hint("rebalance", *by).write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE)
       .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(root))


def write_weekly_snapshot(df: DataFrame, root: str, date_col: str = "date") -> None:
    """Keep Sundays only, partition by year and ISO week."""
    d = F.col(date_col)
    out = df.where(F.weekday(d) == 6).withColumns({"year": F.year(d), "week": F.weekofyear(d)})
    _write_folders(out, root, ("year", "week"))


def write_small(df: DataFrame, path: str) -> None:
    """A small dimension table as a single file (callers guarantee the size)."""
    df.repartition(1).write.mode("overwrite").parquet(path)


def write_json_report(df: DataFrame, path: str) -> None:
    df.repartition(1).write.mode("overwrite").json(path)


def norm_path(c) -> F.Column:
    """'file:///x' and 'file:/x' name the same file: keep one slash after the scheme."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(col, r"^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def json_key_values(df: DataFrame, col: str, keep=()) -> DataFrame:
    """A JSON object column parsed to (key, value) rows (values as double)."""
    m = F.from_json(F.col(col), "map<string,double>")
    return df.select(*keep, F.explode(m).alias("key", "value"))


def map_value_sum(col: str) -> F.Column:
    """Sum of the values of a map<string,double> column, per row."""
    return F.aggregate(F.map_values(F.col(col)), F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0)))
