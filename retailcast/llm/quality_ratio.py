"""Quality verdicts from hashed n-gram likelihood ratios, beside counted base rules.

Byte n-grams of every text are hashed into 2^bits buckets.  Two multinomials over the buckets
are estimated, one from trusted target documents and one from the whole raw corpus, both with
add-one smoothing.  A document's score is the mean of log p_target - log p_raw over its n-grams
(length-normalised, in nats per n-gram); it is kept if the score reaches a fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailcast.llm.common import batch_of, filter_rows, hashed_ngrams, slices, text_bytes

ORDER, BITS = 3, 16
THRESHOLD = -0.6  # nats per n-gram below the raw corpus; trusted text scores above -0.3 even in small tables, noise below -1
MIN_WORDS, MOST_REPEAT_PERCENT = 50, 50
SYMBOLS = b"#*$%&|<>"
VERDICT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, kept boolean, score double")


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found at least twice."""
    n = len(words) - 2
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    _, pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)  # renumbered: no overflow in the next step
    windows = pairs[:-1] * len(number) + ids[2:]
    in_order = np.sort(windows)
    twice = np.unique(in_order[1:][in_order[1:] == in_order[:-1]])
    if not len(twice):
        return 0
    at = np.nonzero(np.isin(windows, twice))[0]
    hit = np.zeros(len(words), dtype=bool)
    for k in range(3):
        hit[at + k] = True
    return int(hit.sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    words = text.split()
    joined = np.frombuffer(b"".join(words), dtype=np.uint8)
    seen: set[bytes] = set()
    dup = 0
    for line in text.split(b"\n"):
        if line.split():
            dup += line in seen
            seen.add(line)
    return (len(words), int(((joined & 0xC0) != 0x80).sum()), sum(text.count(SYMBOLS[k:k + 1]) for k in range(len(SYMBOLS))),
            dup, repeated_words(words))


COUNTS = "bucket long, raw long, target long"


def _count(order: int, bits: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for batch in batches:
            for some in slices(batch):
                good = some.column("good").to_pylist()
                grams = [hashed_ngrams(t.as_py(), order, bits) for t in some.column("data")]
                raw += np.bincount(np.concatenate(grams), minlength=1 << bits)
                if any(good):
                    target += np.bincount(np.concatenate([x for x, g in zip(grams, good) if g]), minlength=1 << bits)
        at = np.nonzero(raw)[0]
        yield batch_of(COUNTS, list(zip(at.tolist(), raw[at].tolist(), target[at].tolist())))
    return count


def fit_ratio(docs: DataFrame, trusted: DataFrame, order: int = ORDER, bits: int = BITS) -> np.ndarray:
    """log p_target - log p_raw per bucket, from all of ``docs`` (doc_id, text).

    ``trusted`` lists the doc_id of trusted documents, all of which are counted.  Without any trusted
    text the ratio is 0 everywhere: nothing is rejected.  The sums that reach the driver are one row
    per bucket.
    """
    ids = trusted.select(F.col("doc_id").cast("long")).where("doc_id is not null").distinct()
    rows = docs.select(F.col("doc_id").cast("long"), text_bytes().alias("data"))
    # the ids grow with the table, so they are dealt over tasks at every size; no side is sorted
    marked = rows.join(ids.withColumn("good", F.lit(True)).hint("shuffle_hash"), "doc_id", "left")
    sums = (marked.select("data", F.coalesce("good", F.lit(False)).alias("good")).mapInArrow(_count(order, bits), COUNTS)
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas())
    raw, target = np.zeros(1 << bits), np.zeros(1 << bits)
    raw[sums["bucket"].to_numpy(np.int64)] = sums["raw"]
    target[sums["bucket"].to_numpy(np.int64)] = sums["target"]
    if not target.sum():
        return np.zeros(1 << bits)
    share = lambda n: np.log((n + 1) / (n.sum() + len(n)))
    return share(target) - share(raw)


class Judge:
    """Verdict on one text: (counts of VERDICT ..., base_failed, kept, score)."""

    def __init__(self, ratio: np.ndarray, order: int, bits: int, threshold: float):
        self.ratio, self.order, self.bits, self.threshold = ratio.astype(np.float32), order, bits, threshold

    def __call__(self, text: bytes) -> tuple:
        base = base_counts(text)
        grams = hashed_ngrams(text, self.order, self.bits)
        score = float(self.ratio[grams].mean()) if len(grams) else 0.0
        failed = base[0] < MIN_WORDS or 100 * base[4] > MOST_REPEAT_PERCENT * base[0]
        return (*base, failed, not failed and score >= self.threshold, score)


def _judge(judge: Judge):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch):
                yield batch_of(VERDICT, [(i, *judge(t.as_py())) for i, t in zip(some.column("doc_id").to_pylist(), some.column("data"))])
    return run


def quality_verdicts(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, order: int = ORDER,
                     bits: int = BITS) -> DataFrame:
    """The VERDICT columns for every row of ``doc_id, text``; other columns are left out.

    Null text has no words and fails the base rules; rows that repeat or lack an id are judged
    each on its own.  An empty table gives no row.  Texts are counted in one pass, where they meet the
    trusted ids in a shuffle, and judged in a second.
    """
    judge = Judge(fit_ratio(docs, trusted, order, bits), order, bits, threshold)
    rows = docs.select(F.col("doc_id").cast("long"), text_bytes().alias("data"))
    return rows.mapInArrow(_judge(judge), VERDICT)


def keep_good(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, order: int = ORDER,
              bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` that quality_verdicts keeps, with all their columns, which aren't shuffled."""
    judge = Judge(fit_ratio(docs, trusted, order, bits), order, bits, threshold)
    return filter_rows(docs, lambda text: judge(text)[-2])
