"""Parquet footers read in parallel: rows and date range of every file, and why a file is bad.

A footer holds the number of rows and the least and greatest value of a column per row group, so a file of
any size costs a few kilobytes.  Tasks open the files of a listing by themselves, where their store is one that
Arrow knows; other stores are read through Spark, one column of all files and the whole content of only
those files that gave no row.
"""

from __future__ import annotations

import datetime as dt
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailcast.sources.files import below, list_files, norm_path

FOOTER = "path string, length long, n_rows long, row_groups int, first_date date, last_date date, problem string"
OK, MISSING, EMPTY, DAMAGED, NO_ROWS = None, "missing file", "zero bytes", "damaged footer", "no rows"
ARROW_SCHEMES = ("file", "hdfs", "s3", "s3a", "gs")
FILES_PER_TASK = 200


def _date(value) -> dt.date | None:
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else None


def footer_facts(file, date_cols: tuple[str, ...]) -> tuple:
    """(rows, row groups, first date, last date, problem) of an open file.

    The dates are those of the first of ``date_cols`` that the file has; statistics that a writer left out are null.
    """
    size = file.size() if callable(file.size) else file.size
    if not size:
        return None, None, None, None, EMPTY
    try:
        meta = pq.read_metadata(file)
    except (pa.ArrowInvalid, OSError, struct.error):
        return None, None, None, None, DAMAGED
    if not meta.num_rows:
        return 0, meta.num_row_groups, None, None, NO_ROWS
    own = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
    places = [own[c] for c in date_cols if c in own]
    low, high, whole = [], [], bool(places)
    for g in range(meta.num_row_groups) if places else ():
        c = meta.row_group(g).column(places[0])
        s = c.statistics
        if s is not None and s.has_min_max:
            low.append(_date(s.min))
            high.append(_date(s.max))
        elif s is None or s.null_count != c.num_values:  # a group of nulls only has no bounds, and needs none
            whole = False
    whole = whole and None not in low + high
    return (meta.num_rows, meta.num_row_groups, min(low) if whole and low else None, max(high) if whole and high else None, OK)


def _read(date_cols: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
                if length == 0:
                    rows.append((path, 0, None, None, None, None, EMPTY))
                    continue
                store, inner = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
                try:
                    with store.open_input_file(inner) as f:
                        rows.append((path, length, *footer_facts(f, date_cols)))
                except FileNotFoundError:  # gone since it was listed
                    rows.append((path, None, None, None, None, None, MISSING))
            yield _batch(rows)
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.date32(), pa.date32(), pa.string()]
    names = [c.split()[0] for c in FOOTER.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Facts of files whose whole content Spark has read."""
    for batch in batches:
        yield _batch([(p, n, *footer_facts(pa.BufferReader(c.as_buffer()), ()))
                      for p, n, c in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), batch.column("content"))])


def _by_scan(spark: SparkSession, files: DataFrame, root: str, date_cols: tuple[str, ...], schema: T.StructType | None) -> DataFrame:
    """Footer facts by Spark's own reader: rows and dates from a scan of the date columns, and the reason only for files that
    gave no row.  The number of row groups stays null."""
    reader = spark.read.option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    reader = reader.schema(schema or ", ".join(f"`{c}` date" for c in date_cols))
    column = F.coalesce(*[F.to_date(F.col(f"`{c}`")) for c in date_cols])
    seen = (reader.parquet(root).groupBy(norm_path(F.col("_metadata.file_path")).alias("path"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min(column).alias("first_date"), F.max(column).alias("last_date")))
    both = files.join(seen, "path", "left")
    good = both.where("n_rows is not null").select("path", "length", "n_rows", F.lit(None).cast("int").alias("row_groups"), "first_date",
                                                   "last_date", F.lit(None).cast("string").alias("problem"))
    odd = both.where("n_rows is null").select("path", "length")
    content = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
               .select(norm_path("path").alias("path"), "length", "content"))
    return good.unionByName(content.join(odd.select("path"), "path", "left_semi").mapInArrow(_content, FOOTER))


def read_footers(spark: SparkSession, root: str, date_cols: tuple[str, ...] = ("date",), expected: DataFrame | None = None,
                 schema: T.StructType | None = None, pattern: str = "*.parquet") -> DataFrame:
    """The FOOTER columns of every Parquet file under ``root``, and of every file of ``expected`` (column path).

    ``problem`` is null for a good file, else why it is bad: missing file, zero bytes, damaged footer, no rows.
    ``first_date`` and ``last_date`` come from the statistics of the first of ``date_cols`` that the file has (date
    or timestamp; null where the writer left them out).  Files expected twice count once.  ``schema``, that of the date
    columns, is only used in a store that tasks can't open by themselves.
    """
    listed = list_files(spark, root, pattern).select(norm_path("path").alias("path"), "length")
    scheme = _scheme(spark, root)
    if scheme in ARROW_SCHEMES:
        parts = 1 + listed.count() // FILES_PER_TASK
        facts = listed.repartition(parts, "path").mapInArrow(_read(tuple(date_cols)), FOOTER)
    else:
        facts = _by_scan(spark, listed, root, tuple(date_cols), schema)
    if expected is None:
        return facts
    # the listing leaves out files of zero bytes: those that are expected are looked up one by one
    names = expected.select(norm_path("path").alias("path")).where("path is not null").distinct()
    absent = names.join(listed, "path", "left_anti")
    rows = [(p["path"], *_lookup(spark, p["path"])) for p in absent.toLocalIterator()]
    gone = spark.createDataFrame(rows, "path string, length long, problem string")
    return facts.unionByName(gone, allowMissingColumns=True)


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _scheme(spark: SparkSession, path: str) -> str:
    p, store = _path(spark, path)
    return p.toUri().getScheme() or store.getUri().getScheme()


def _lookup(spark: SparkSession, path: str) -> tuple[int | None, str]:
    p, store = _path(spark, path)
    if not store.exists(p):
        return None, MISSING
    return store.getFileStatus(p).getLen(), EMPTY if store.getFileStatus(p).getLen() == 0 else "not listed"


def footer_summary(facts: DataFrame) -> DataFrame:
    """One row: files, good files, rows, the date range, and a map of problems to numbers of files."""
    per = facts.groupBy("problem").agg(F.count("*").alias("n"), F.sum("n_rows").alias("rows"), F.min("first_date").alias("first"),
                                       F.max("last_date").alias("last"), F.sum("length").alias("bytes"))
    bad = F.filter(F.collect_list(F.struct("problem", "n")), lambda p: p["problem"].isNotNull())
    return per.agg(F.sum("n").alias("files"), F.coalesce(F.sum(F.when(F.col("problem").isNull(), F.col("n"))), F.lit(0)).alias("good_files"),
                   F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"), F.sum("bytes").alias("total_bytes"), F.min("first").alias("first_date"),
                   F.max("last").alias("last_date"), F.map_from_entries(bad).alias("problems"))


def manifest(spark: SparkSession, root: str, date_cols: tuple[str, ...] = ("date",), schema: T.StructType | None = None) -> DataFrame:
    """Per dataset (first folder or file stem under ``root``): files, bytes, rows, date range and bad files, from footers."""
    facts = read_footers(spark, root, date_cols, schema=schema)
    dataset = F.regexp_replace(F.split(below("path", root), "/").getItem(0), r"\.parquet$", "")
    return facts.groupBy(dataset.alias("dataset")).agg(
        F.count("*").alias("n_files"), F.sum("length").alias("total_bytes"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"), F.count("problem").alias("bad_files"))


def manifest_summary(per_dataset: DataFrame) -> DataFrame:
    """One row: a map of file counts, total files and bytes, rows and the date range of all datasets."""
    return per_dataset.agg(
        F.map_from_entries(F.collect_list(F.struct("dataset", "n_files"))).alias("file_counts"), F.sum("n_files").alias("total_files"),
        F.sum("total_bytes").alias("total_bytes"), F.sum("n_rows").alias("total_rows"), F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"))
