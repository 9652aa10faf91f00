"""Helpers shared by the text operators: written tables, empty-safe columns, hashed byte n-grams."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailcast.session import ensure_checkpoint_dir

# ASCII white space that ends a word: space and U+0009 to U+000D.  ``bytes.split()``
# without an argument splits on exactly these bytes.
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor costs its running tasks, not the work before.
    The table keeps its columns apart, so later readers load only what they select.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(column: str = "text") -> Column:
    """UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def word_count(column: str = "text") -> Column:
    """Number of words of a text column as a long (null: 0)."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def hashed_ngrams(data: bytes, order: int, bits: int) -> np.ndarray:
    """Bucket numbers of all byte n-grams of one text, in text order (fewer bytes: none)."""
    b = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    n = len(b) - order + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    key = b[:n].copy()
    for k in range(1, order):
        key = key * np.uint32(257) + b[k:k + n]
    # multiplicative hashing: the upper bits of the product
    return ((key * np.uint32(2654435761)) >> np.uint32(32 - bits)).astype(np.int64)


class Forest:
    """Union-find over the positions 0..n-1 with whole arrays of links at a time."""

    def __init__(self, n: int):
        self.parent = np.arange(n, dtype=np.int64)

    def find(self, x: np.ndarray) -> np.ndarray:
        p = self.parent[x]
        while True:
            q = self.parent[p]
            if np.array_equal(p, q):
                return p
            p = q

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.find(i), self.find(j)
            hi, lo = np.maximum(a, b), np.minimum(a, b)
            open_ = hi != lo
            i, j = hi[open_], lo[open_]
            np.minimum.at(self.parent, i, j)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """One edge from each non-root to its root."""
        x = np.arange(len(self.parent))
        root = self.find(x)
        open_ = root != x
        return x[open_], root[open_]


KINDS = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(),
         "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}
SLICE_BYTES = 4 << 20


def batch_of(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    """An Arrow batch of ``rows`` for a schema such as "a long, b binary"."""
    fields = [(name, KINDS[kind]) for name, kind in (f.split() for f in schema.split(", "))]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.record_batch([pa.array(c, t) for c, (_, t) in zip(columns, fields)], schema=pa.schema(fields))


def columns_of(batch: pa.RecordBatch, *names: str) -> list[list]:
    """Columns of an Arrow batch as Python lists; null is None, and long ids stay exact."""
    return [batch.column(n).to_pylist() for n in names]


def slices(batch: pa.RecordBatch, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``size`` bytes, so that long texts don't add up in Python."""
    n = max(1, int(batch.num_rows * size / max(1, batch.nbytes)))
    for at in range(0, batch.num_rows, n):
        yield batch.slice(at, n)


def filter_rows(docs: DataFrame, keep: Callable[[bytes], bool]) -> DataFrame:
    """Rows of ``docs`` whose text (UTF-8 bytes, null: empty) passes ``keep``.  Columns pass through packed, so
    no name can clash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch):
                yield some.select(["doc"]).filter(pa.array([bool(keep(t.as_py())) for t in some.column("data")], pa.bool_()))

    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), text_bytes().alias("data"))
    return packed.mapInArrow(run, T.StructType([T.StructField("doc", docs.schema)])).select("doc.*")


def numbered(rows: DataFrame, order: list[Column], name: str, range_rows: int = 50_000) -> DataFrame:
    """``rows`` with ``place``, the position from 0 in ``order``.  Rows that tie keep their order in the table.

    Rows are dealt to sorted ranges, which are written; a range's first place is the number of rows before it.
    A range is cut at sampled rows and ties are cut too, so a value of any frequency is split.
    """
    rows = written(rows.withColumn("at", F.monotonically_increasing_id()), name)
    parts = 1 + rows.count() // range_rows
    dealt = rows.repartitionByRange(parts, *order, "at").sortWithinPartitions(*order, "at").drop("at")
    dealt = written(dealt.withColumn("at", F.monotonically_increasing_id()), name)
    # monotonically_increasing_id: the partition above 33 bits, the row in it below
    held = dealt.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    first = written(held.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), name)
    inside = F.col("at").bitwiseAND(F.lit((1 << 33) - 1).cast("long"))
    return (dealt.withColumn("part", F.shiftright("at", 33)).join(first, "part")
            .withColumn("place", F.col("first") + inside).drop("part", "first", "at"))


def keyed(docs: DataFrame) -> DataFrame:
    """(key, doc) with a long key of its own for each row; ``doc`` holds all columns.

    The key is the doc_id where it is known and no other row has it.  The other rows get numbers beyond all ids, in
    the order of a hash of the whole row, so that keys follow from the rows and not from their files; copies of one
    row are next to each other, and which gets which number makes no difference.
    """
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    n = docs.agg(F.count("*").alias("rows"), F.count("doc_id").alias("known"), F.countDistinct("doc_id").alias("own"),
                 F.max(F.col("doc_id").cast("long")).alias("most"), F.min(F.col("doc_id").cast("long")).alias("least")).first()
    if n["rows"] == n["known"] == n["own"]:
        return docs.select(F.col("doc_id").cast("long").alias("key"), doc)
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("h1"),
                       F.xxhash64(F.lit(1), *[F.col(f"`{c}`") for c in docs.columns]).alias("h2"), doc)
    rows = written(rows, "keyed")
    again = written(rows.where("id is not null").groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "again")
    own = rows.where("id is not null").join(again, "id", "left_anti")
    others = rows.where("id is null").unionByName(rows.join(again, "id", "left_semi"))
    place = F.col("place").cast("long")
    up = (n["most"] if n["most"] is not None else -1) + n["rows"] < (1 << 63) - 1
    key = F.lit((n["most"] if n["most"] is not None else -1) + 1) + place if up else F.lit(n["least"] - 1) - place
    return own.select(F.col("id").alias("key"), "doc").unionByName(
        numbered(others.select("h1", "h2", "doc"), [F.col("h1"), F.col("h2")], "others").select(key.alias("key"), "doc"))
