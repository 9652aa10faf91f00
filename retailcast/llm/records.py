"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

File format of a shard (all numbers little-endian); records follow each other without gaps:

====================  =====================================================================
8 bytes               payload length
4 bytes               masked CRC-32 of those 8 bytes
payload               1 byte: 1 if the document has an id, 8 bytes: the id (0 if it has
                      none), 1 byte: bytes per token (2 or 4), then the token ids
4 bytes               masked CRC-32 of the payload
1 byte                line feed, which ends the record
====================  =====================================================================

A masked checksum is the CRC rotated right by 15 bits plus 0xA282EAD8, so that checksums
of data that hold checksums stay useful.  Shards are written by Spark's text writer (a
record is a string of arbitrary bytes, the line feed its separator), so that any file
system Spark can write works, a retried task commits its shard once, and no file is left
on an executor.  Names of shards sort in document order.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retailcast.llm.common import batch_of, columns_of, slices
from retailcast.llm.tokens import encoder
from retailcast.sources.footers import ARROW_SCHEMES

SHARD_BYTES = 8 << 20  # text bytes that go to one shard, about
HEAD, ID_HEAD, TAIL = struct.Struct("<QI"), struct.Struct("<BqB"), struct.Struct("<I")
SEEK_BYTES = 16 << 20  # of records that a shuffled read holds at a time
SHUFFLED = "doc_id long, n_tokens long, ids binary"
RECORD = ["shard string", "record long", "offset long", "length long", "doc_id long", "n_tokens long", "inside long", "ids binary"]


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes) -> bytes:
    """One record, without the line feed that the writer adds.  ``ids``: unsigned 32-bit."""
    a = np.frombuffer(ids, dtype="<u4")
    width = 2 if not len(a) or int(a.max()) < 1 << 16 else 4
    payload = ID_HEAD.pack(doc_id is not None, doc_id or 0, width) + a.astype(f"<u{width}").tobytes()
    size = struct.pack("<Q", len(payload))
    return size + TAIL.pack(masked_crc(size)) + payload + TAIL.pack(masked_crc(payload))


def parse(shard: str, data: bytes) -> Iterator[tuple]:
    """Records of one shard as RECORD tuples; a wrong length or checksum raises ValueError."""
    at = n = inside = 0
    while at < len(data):
        if at + HEAD.size > len(data):
            raise ValueError(f"{shard}: record {n} at {at} is cut short")
        size, crc = HEAD.unpack_from(data, at)
        if masked_crc(data[at:at + 8]) != crc:
            raise ValueError(f"{shard}: record {n} at {at} has a damaged length")
        end = at + HEAD.size + size
        payload = data[at + HEAD.size:end]
        if end + 5 > len(data) or TAIL.unpack_from(data, end)[0] != masked_crc(payload) or data[end + 4] != 10:
            raise ValueError(f"{shard}: record {n} at {at} is damaged")
        known, doc_id, width = ID_HEAD.unpack_from(payload)
        ids = np.frombuffer(payload, dtype=f"<u{width}", offset=ID_HEAD.size).astype("<u4")
        yield shard, n, at, end + 5 - at, doc_id if known else None, len(ids), inside, ids.tobytes()
        at, n, inside = end + 5, n + 1, inside + len(ids)


def _frames(path: str | None, end_id: int, special: bool):
    end = struct.pack("<I", end_id)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, special)
        for batch in batches:
            for part in slices(batch):
                doc_ids, texts = columns_of(part, "doc_id", "text")
                ids = e.encode_many([t or "" for t in texts])
                yield batch_of("frame binary", [(frame(i, x + end),) for i, x in zip(doc_ids, ids)])
    return encode


def _records(columns: list[str]):
    names = [c.split()[0] for c in RECORD]
    at, kinds = [names.index(c) for c in columns], _schema(columns)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, data in zip(batch.column("shard").to_pylist(), batch.column("content")):
                yield batch_of(kinds, [tuple(r[i] for i in at) for r in parse(shard, data.as_py())])
    return read


def _schema(columns: list[str]) -> str:
    return ", ".join(c for name in columns for c in RECORD if c.split()[0] == name)


def read_shards(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Records of all shards under ``path``, parsed and checked, with the RECORD columns asked for.

    A shard is read as a whole by one task, so its size bounds the task's memory.
    """
    files = (spark.read.format("binaryFile").load(f"{path}/data")
             .select(F.element_at(F.split("path", "/"), -1).alias("shard"), "content"))
    return files.mapInArrow(_records(columns), _schema(columns))


def write_records(docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int = 2,
                  shard_bytes: int = SHARD_BYTES, special: bool = False) -> None:
    """Encode ``doc_id, text`` and write ``path/data`` (shards) and ``path/index`` (Parquet).

    Documents lie in ascending doc_id order (null ids first, equal ids by a hash of the text), each as
    its ids and ``end_id``.  Null text counts as empty; repeated rows stay; other columns are
    left out.  An empty table gives an empty index.  Documents are dealt to shards by ranges of
    doc_id before they are encoded, so a text is shuffled once and encoded once.  ``special`` as in
    tokens.Encoder.

    The index has shard, record, offset, length (bytes), doc_id, start (tokens of all documents
    before it) and n_tokens.  It is made from the committed shards, checking every record; ``path/shards``
    holds the tokens before each shard.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = 1 + total // shard_bytes
    # a doc_id that very many rows share is split over shards by a hash of the text (the text itself
    # would send whole texts to the driver, as samples for the ranges)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = docs.repartitionByRange(shards, *order).sortWithinPartitions(*order, "text")
    frames = dealt.mapInArrow(_frames(tokenizer_path, end_id, special), "frame binary")
    frames.select(F.col("frame").cast("string")).write.option("lineSep", "\n").text(f"{path}/data")

    found = read_shards(spark, path, ["shard", "record", "offset", "length", "doc_id", "n_tokens"])
    found.write.parquet(f"{path}/found")
    found = spark.read.schema(found.schema).parquet(f"{path}/found")
    # tokens before each shard: one row per shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shard = found.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    shard = shard.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    shard.write.parquet(f"{path}/shards")
    inside = Window.partitionBy("shard").orderBy("record").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    (found.join(_shard_starts(spark, path), "shard")
     .select("shard", "record", "offset", "length", "doc_id", start.alias("start"), "n_tokens").write.parquet(f"{path}/index"))


def _shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """(shard, base): tokens before each shard.  A file of its own, so that Spark sees its size and broadcasts it
    while it is small."""
    return spark.read.schema("shard string, base long").parquet(f"{path}/shards")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/index")  # shard, record, offset, length, doc_id, start, n_tokens


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every record in the shards."""
    found = read_shards(spark, path, ["shard", "inside", "doc_id", "n_tokens", "ids"])
    return (found.join(_shard_starts(spark, path), "shard")
            .select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids"))


def _seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records at the offsets of an index, in its order; a batch opens each of its shards once."""
    for batch in batches:
        rows, data = list(zip(*columns_of(batch, "path", "offset", "length"))), [b""] * batch.num_rows
        by_shard: dict[str, list[int]] = {}
        for k, (path, _, _) in enumerate(rows):
            by_shard.setdefault(path, []).append(k)
        for path, places in by_shard.items():
            store, inner = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
            with store.open_input_file(inner) as f:
                for k in sorted(places, key=lambda k: rows[k][1]):
                    data[k] = f.read_at(rows[k][2], rows[k][1])
        yield batch_of(SHUFFLED, [(r[4], r[5], r[7]) for (path, _, _), d in zip(rows, data) for r in parse(path, d)])


def read_shuffled(spark: SparkSession, path: str, seed: int, partitions: int) -> DataFrame:
    """(doc_id, n_tokens, ids) of all records in an order drawn from ``seed``: partition by partition, each by position.

    The order is fixed on the index alone, so the same seed gives the same order whatever the cluster.  Only
    the index is shuffled; tasks then seek to their records, a SEEK_BYTES run at a time, and check them.  In a store
    that tasks can't open by themselves the shards are read whole and joined with the order instead.  Null and
    repeated ids and empty texts are records like any other, a record of any length is read whole, and an
    empty table gives no rows.
    """
    draw = F.xxhash64("shard", "offset", F.lit(seed))
    index = read_index(spark, path).select("shard", "offset", "length", draw.alias("draw"))
    order = ["draw", "shard", "offset"]
    files = spark.read.format("binaryFile").load(f"{path}/data").select("path", F.element_at(F.split("path", "/"), -1).alias("shard"))
    some = files.select("path").first()
    if some is None or some["path"].split(":")[0] in ARROW_SCHEMES:
        drawn = index.join(files, "shard").repartitionByRange(partitions, *order).sortWithinPartitions(*order)
        return drawn.select("path", "offset", "length").mapInArrow(_runs, SHUFFLED)
    found = read_shards(spark, path, ["shard", "offset", "doc_id", "n_tokens", "ids"])
    return (found.join(index.drop("length"), ["shard", "offset"]).repartitionByRange(partitions, *order)
            .sortWithinPartitions(*order).select("doc_id", "n_tokens", "ids"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of an index cut into runs of about SEEK_BYTES of records, so that a task holds one run."""
    for batch in batches:
        run = np.cumsum(batch.column("length").to_numpy()) // SEEK_BYTES
        cuts = [0, *(np.nonzero(np.diff(run))[0] + 1).tolist(), batch.num_rows]
        yield from _seek(batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a)
