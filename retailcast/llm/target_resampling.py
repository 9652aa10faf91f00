"""Importance resampling towards a target distribution, ranked by a distributed radix sort.

Features (runs of words) are hashed into buckets.  A bucket's gain is the log ratio of its
smoothed shares among target texts and among all documents, a document's weight the mean gain
of its features, and its score the weight plus Gumbel noise from a hash of its id, so the
highest scores are a sample without replacement in proportion to exp(weight).

The order comes from an LSD radix sort: for each digit of the composite key, least significant
first, the rows of a block are counted by digit, prefix sums over (digit, block) give every block
the first destination of each digit, and rows move there in the order they have.  After the
last pass a row's place is its rank.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailcast.llm.common import batch_of, slices, text_bytes, written
from retailcast.llm.words import Words, crc32_of

BUCKETS, ORDER = 10_000, 1
PERCENT, MIN_WORDS, SEED = 10, 20, 2024
DIGIT_BITS = 11
BLOCK_BITS = 14  # rows of a block: 16,384, sorted in one go


def features(words: Words, order: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of all runs of 1 to ``order`` words."""
    docs, found = [], []
    for n in range(1, order + 1):
        first = words.runs(n)
        docs.append(words.doc[first])
        found.append(crc32_of(words.data, words.start[first], words.end[first + n - 1]) % np.uint32(buckets))
    return np.concatenate(docs), np.concatenate(found).astype(np.int64)


def _count(order: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch):
                n += np.bincount(features(Words([t.as_py() for t in part.column("data")]), order, buckets)[1], minlength=buckets)
        at = np.nonzero(n)[0]
        yield batch_of("bucket int, n long", list(zip(at.tolist(), n[at].tolist())))
    return run


def bucket_counts(texts: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all ``text`` by bucket.  One row per bucket reaches the driver."""
    sums = (texts.select(text_bytes().alias("data")).mapInArrow(_count(order, buckets), "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(buckets, np.int64)
    for r in sums:
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of the log ratio of smoothed shares, per bucket."""
    b, s_all, t_all = len(raw), int(raw.sum()), int(target.sum())
    ratio = lambda s, t: float(t + 1) * float(s_all + b) / (float(s + 1) * float(t_all + b))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(raw.tolist(), target.tolist())], np.int64)


WEIGHED = "doc_id long, n_words long, n_features long, weight long"


def _weigh(gain: np.ndarray, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = Words([t.as_py() for t in part.column("data")])
                doc, bucket = features(words, order, len(gain))
                n = np.bincount(doc, minlength=part.num_rows)
                total = np.bincount(doc, weights=gain[bucket], minlength=part.num_rows).astype(np.int64)  # whole numbers, exact
                columns = [part.column("doc_id"), *(pa.array(x.astype(np.int64)) for x in (words.counts(), n, total // np.maximum(n, 1)))]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in WEIGHED.split(", ")])
    return run


def noise(seed: int) -> Column:
    """floor(-1000 ln(-ln(u))) with u from 32 bits of a hash of the seed and the id (null: as the text "null")."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / float(1 << 32)))).cast("long")


def counting_pass(rows: DataFrame, digit: Column) -> DataFrame:
    """``rows`` with the places of a stable sort by ``digit``.  Rows of a block stay together, so a frequent digit
    is split over all blocks."""
    rows = rows.withColumn("digit", digit).withColumn("block", F.shiftright("place", BLOCK_BITS))
    counts = rows.groupBy("digit", "block").agg(F.count("*").alias("n"))
    # first destination of (digit, block): rows of smaller digits, then those of earlier blocks
    totals = counts.groupBy("digit").agg(F.sum("n").alias("held"))
    smaller = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)  # one row per digit value
    totals = totals.select("digit", F.coalesce(F.sum("held").over(smaller), F.lit(0)).alias("base"))
    earlier = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select("digit", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    first = ahead.join(totals, "digit").select("digit", "block", (F.col("base") + F.col("ahead")).alias("first"))
    inside = F.row_number().over(Window.partitionBy("block", "digit").orderBy("place")) - 1
    placed = rows.repartition("block").withColumn("inside", inside)
    return placed.join(first, ["digit", "block"]).withColumn("place", F.col("first") + F.col("inside")).drop("digit", "block", "inside", "first")


def packed(keys: list[str], ends: dict) -> list[tuple[Column, int]]:
    """The composite key as (column, bits) of unsigned longs, least significant first.

    A key counts from its least value, in as many bits as its greatest needs; neighbours share a long of
    at most 62 bits.  Values too far apart for a difference are taken as they are, with the sign bit flipped.
    """
    out: list[tuple[Column, int]] = []
    for key in reversed(keys):
        low, high = ends[f"min_{key}"], ends[f"max_{key}"]
        bits = (high - low).bit_length()
        if bits > 62:
            out.append((F.col(key).bitwiseXOR(F.lit(-1 << 63).cast("long")), 64))
        elif out and out[-1][1] + bits <= 62:
            below, n = out.pop()
            out.append((below.bitwiseOR(F.shiftleft(F.col(key) - F.lit(low), n)), n + bits))
        else:
            out.append((F.col(key) - F.lit(low), bits))
    return out


def radix_sort(rows: DataFrame, keys: list[str], name: str = "radix") -> DataFrame:
    """``rows`` with ``place``, the position from 0 in ascending order of ``keys``.

    ``keys`` are long columns without nulls, most significant first.  Rows that tie on all keys keep their
    order in the table.  Every pass is written.  Empty: no row.
    """
    rows = written(rows.withColumn("place", F.monotonically_increasing_id()), name)
    ends = rows.agg(*[f(k).alias(f"{f.__name__}_{k}") for k in keys for f in (F.min, F.max)]).first().asDict()
    if ends[f"min_{keys[0]}"] is None:
        return rows
    passes = [(key, down, min(DIGIT_BITS, bits - down)) for key, bits in packed(keys, ends) for down in range(0, max(1, bits), DIGIT_BITS)]
    for key, down, width in passes:
        digit = F.shiftrightunsigned(key, down).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        rows = written(counting_pass(rows, digit), name)
    return rows


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
             order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank for every row of ``docs`` (doc_id, text).

    ``target`` has a column text.  Of the rows with at least ``min_words`` words, ``percent`` in a hundred
    (rounded down) are drawn: those of the highest scores, ties to the smaller doc_id (null first).
    ``rank`` counts from 1, and is null for rows not drawn.  Null and wordless texts have no features and
    weight 0.  Rows that repeat an id share its noise; copies are ranked each on its own, and which of
    them gets which rank shows in no other column unless their n_features differ (fewer first).
    Without target text the gains only reflect rarity.  An empty table gives no row; other columns
    are left out.  Texts are read twice and never shuffled.
    """
    gain = gains(bucket_counts(docs, order, buckets), bucket_counts(target, order, buckets))
    rows = docs.select(F.col("doc_id").cast("long"), text_bytes().alias("data")).mapInArrow(_weigh(gain, order), WEIGHED)
    rows = rows.withColumn("score", F.col("weight") + noise(seed))
    low = F.col("n_words") < min_words
    # descending score as an ascending key, rows without an id before the others
    rows = rows.select("*", F.when(low, 1).otherwise(0).cast("long").alias("short"),
                       ((-F.col("score")) * 2 + F.when(F.col("doc_id").isNull(), 0).otherwise(1)).alias("k_score"),
                       F.coalesce("doc_id", F.lit(0).cast("long")).alias("k_id"))
    placed = radix_sort(rows, ["short", "k_score", "k_id", "n_features"])
    drawn = placed.where("short = 0").count() * percent // 100
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))
