"""Packing documents into fixed-length sequences: shortest-pack-first over the length histogram.

A document's ids (with an end id) are cut into full sequences and one remainder.  Only the
histogram of remainder lengths, at most ``max_len`` numbers, is gathered; the packing is found
on it (Krell et al., "Efficient Sequence Packing without Cross-contamination"): lengths are
placed longest first, each into the pattern with the most room left, and a pattern that takes
only part of a count is split.  Pieces for which no pattern has room fill new ones of their own
length.  The patterns then go back to the pieces by (length, rank).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailcast.llm.common import batch_of, columns_of, slices, written
from retailcast.llm.tokens import encoder

MAX_LEN = 2048
RANK_ROWS = 20_000  # pieces of one length that are numbered in one go, about
PIECE = "row_id long, doc_id long, start long, length long, doc_tokens long, ids binary, ids_crc32 long"
PLACE = "row_id long, start long, sequence_id long, offset long"


def shortest_pack_first(counts: dict[int, int], max_len: int = MAX_LEN) -> list[tuple[int, list[int]]]:
    """Patterns (how often, lengths in a sequence) that use up a length histogram exactly.

    Each length in turn, longest first, goes to the patterns with the most room (shortest
    filled), one piece a pass.  When none has room, new patterns take as many pieces of the
    length as fit: placed one by one, each would go to the pattern just begun.
    """
    room: dict[int, list[tuple[int, list[int]]]] = {}  # room left -> patterns

    def put(n: int, pattern: list[int], left: int) -> None:
        room.setdefault(left, []).append((n, pattern))

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n > 0:
            left = max((r for r in room if room[r]), default=0)
            if left < length:
                each = max_len // length
                for times, own in ((n // each, each), (1, n % each)):
                    if times and own:
                        put(times, [length] * own, max_len - own * length)
                break
            times, pattern = room[left].pop()
            used = min(times, n)
            if used < times:
                put(times - used, pattern, left)
            put(used, pattern + [length], left - length)
            n -= used
    return [p for left in sorted(room) for p in room[left]]


def _cut(path: str | None, end_id: int, max_len: int, special: bool):
    end = struct.pack("<I", end_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, special)
        for batch in batches:
            for some in slices(batch):
                rows = []
                row_ids, doc_ids, texts = columns_of(some, "row_id", "doc_id", "text")
                for row, doc_id, ids in zip(row_ids, doc_ids, e.encode_many([t or "" for t in texts])):
                    ids += end
                    for at in range(0, len(ids), 4 * max_len):
                        part = ids[at:at + 4 * max_len]
                        rows.append((row, doc_id, at // 4, len(part) // 4, len(ids) // 4, part, zlib.crc32(part)))
                yield batch_of(PIECE, rows)
    return cut


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, end_id: int = 1,
                   max_len: int = MAX_LEN, special: bool = False) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, ids, ids_crc32, sequence_id, offset) of all documents.

    ``ids`` are little-endian unsigned 32-bit integers, ``ids_crc32`` their CRC-32.  ``special`` as in tokens.Encoder.

    Null text counts as empty (the end id alone).  Rows that repeat a doc_id are documents of
    their own; null ids stay null.  An empty table gives no piece.  Other columns are left out.
    Every id lies in one piece, pieces of a sequence follow each other without gaps.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), "text").withColumn("row_id", F.monotonically_increasing_id())
    pieces = written(rows.mapInArrow(_cut(tokenizer_path, end_id, max_len, special), PIECE), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # max_len rows at most
    place = _place(counts, shortest_pack_first(counts, max_len))
    places = _ranked(pieces).mapInArrow(place, PLACE)  # only keys; the ids stay with their row
    return (pieces.join(places, ["row_id", "start"])
            .select("doc_id", "start", "length", "doc_tokens", "ids", "ids_crc32", "sequence_id", "offset"))


def _place(counts: dict[int, int], patterns: list[tuple[int, list[int]]]):
    """Sequence and offset of a piece from its length and rank.

    With the pieces numbered by (length, rank), each length of each pattern takes one run of numbers, ``own``
    pieces in a sequence, and the runs cover all numbers: a piece's run is found by binary search.
    """
    runs, rank, base = [], dict.fromkeys(counts, 0), 0
    for n, lengths in patterns:
        offset = 0
        for length, same in groupby(lengths):  # longest first, so equal lengths follow each other
            own = len(list(same))
            runs.append((length, rank[length], own, base, offset))
            rank[length] += n * own
            offset += own * length
        base += n
    length, low, own, base, offset = np.array(sorted(runs), np.int64).reshape(-1, 5).T
    sizes = np.zeros(max(counts, default=0) + 1, np.int64)
    for x, n in counts.items():
        sizes[x] = n
    first = np.cumsum(sizes) - sizes  # number of the first piece of each length
    low = low + first[length]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            number = first[of] + rank
            run = np.searchsorted(low, number, "right") - 1
            sequence, within = np.divmod(number - low[run], own[run])
            yield pa.record_batch([batch.column("row_id"), batch.column("start"), pa.array(base[run] + sequence),
                                   pa.array(offset[run] + within * of)], names=["row_id", "start", "sequence_id", "offset"])
    return place


def _ranked(pieces: DataFrame) -> DataFrame:
    """(row_id, start, length, rank): the pieces of each length numbered from 0.  A length that very many pieces
    share is numbered in parts: rows are dealt over ``parts`` by their id, and the parts' counts give each part's
    first number."""
    total = pieces.count()
    part = F.pmod(F.xxhash64("doc_id", "row_id"), F.lit(1 + total // RANK_ROWS))
    dealt = pieces.withColumn("part", part)
    sizes = dealt.groupBy("length", "part").count()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "part").orderBy("doc_id", "row_id", "start")
    keys = dealt.select("length", "part", "doc_id", "row_id", "start", F.row_number().over(within).alias("n"))
    return keys.join(sizes, ["length", "part"]).select("row_id", "start", "length", (F.col("n") - 1 + F.col("first")).alias("rank"))


def sequences(pieces: DataFrame, pad_id: int = 0, max_len: int = MAX_LEN) -> DataFrame:
    """The packed sequences themselves: (sequence_id, length, ids), ids padded with ``pad_id`` to
    ``max_len`` unless the length is a power of two.  A sequence has ``max_len`` ids at most."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    pad = F.unhex(F.repeat(F.lit(struct.pack("<I", pad_id).hex()), F.col("pad").cast("int")))
    return (pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts"))
            .withColumn("pad", F.when(F.bit_count("length") == 1, 0).otherwise(max_len - F.col("length")))
            .select("sequence_id", "length", F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("body"), "pad")
            .select("sequence_id", "length", F.concat("body", pad).alias("ids")))
