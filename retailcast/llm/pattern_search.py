"""Benchmark passages in documents by Wu-Manber multi-pattern search over words.

The patterns are all windows of ten consecutive words of the benchmark items (an item of fewer
words is one window).  For each window length there is a shift table over hashed blocks of two
words: it tells how far the next window that could end in a pattern lies from here, so most
positions are never looked at.  Where the shift is zero, the bucket of the block's hash names
the patterns that end in it, the hash of the whole window selects one of them, and a direct
comparison of the bytes confirms it.  Texts are cut into stretches, and the cursors of all
stretches of a batch move at the same time.

Items are dealt into passes of a bounded size, one set of tables each, so that no task
holds more than that whatever the size of the benchmark.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailcast.llm.common import batch_of, slices, text_bytes, written
from retailcast.llm.words import Words

WINDOW = 10
BLOCK = 2  # words of a block
PASS_BYTES = 8 << 20  # item text whose tables a task holds at a time, about
STRETCH = 64  # positions that one cursor walks
MIX, MULTIPLIER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
BASES = (0x100000001B3, 0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x27D4EB2F165667C5)  # of the word hash


def run_hash(words: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words that end at each position of ``last``, from the hashes of the words."""
    h = np.zeros(len(last), np.uint64)
    for k in range(n):
        h = h * MULTIPLIER + words[last - (n - 1 - k)]
    return h * MIX


class Patterns:
    """Tables of all patterns of n words."""

    def __init__(self, items: Words, item: np.ndarray, hashes: np.ndarray, first: np.ndarray, n: int):
        """Patterns are the runs of ``items`` that start at ``first``; item[k] is the number of text k."""
        self.n, self.block = n, min(BLOCK, n)
        whole = run_hash(hashes, first + n - 1, n)
        order = np.argsort(whole, kind="stable")
        new = np.concatenate([[True], whole[order][1:] != whole[order][:-1]])
        number = np.cumsum(new) - 1
        head = order[new]  # one run for each different pattern
        cut = lambda i: items.data[items.start[first[i]]:items.end[first[i] + n - 1]].tobytes()
        texts = [cut(i) for i in head]
        if any(cut(order[k]) != texts[number[k]] for k in np.nonzero(~new)[0]):
            raise ArithmeticError("two different patterns have one hash")
        owners = np.unique(np.stack([number, item[items.doc[first[order]]]]), axis=1)

        # patterns by the hash of their last block, then by the hash of the whole
        at = first[head] + n - 1
        suffix = run_hash(hashes, at, self.block)
        by = np.lexsort((whole[head], suffix))
        self.whole, self.texts = whole[head][by], [texts[i] for i in by]
        self.size = np.array([len(t) for t in self.texts])
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        owners = owners[:, np.argsort(place[owners[0]], kind="stable")]
        self.items = owners[1]
        self.owned = np.searchsorted(place[owners[0]], np.arange(len(by) + 1))
        self.suffix, self.bucket = np.unique(suffix[by], return_index=True)
        self.bucket = np.append(self.bucket, len(by))

        bits = min(26, max(10, int(len(by) * n).bit_length() + 3))
        self.down = np.uint64(64 - bits)
        self.shift = np.full(1 << bits, n - self.block + 1, np.uint8)
        for back in range(n - self.block, -1, -1):  # smaller shifts overwrite larger ones
            self.shift[run_hash(hashes, at - back, self.block) >> self.down] = back

    def search(self, words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position of the last word, pattern) of every occurrence."""
        low, high = words.first[:-1] + self.n - 1, words.first[1:]
        steps = np.maximum(0, -((low - high) // STRETCH))
        begin = np.repeat(low, steps) + STRETCH * (np.arange(steps.sum()) - np.repeat(np.cumsum(steps) - steps, steps))
        stop = np.minimum(begin + STRETCH, np.repeat(high, steps))
        at, found = begin, []
        while len(at):
            block = run_hash(hashes, at, self.block)
            shift = self.shift[block >> self.down].astype(np.int64)
            here = shift == 0
            if here.any():
                found.append(self.confirm(words, hashes, at[here], block[here]))
            at = at + np.maximum(shift, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        both = [np.concatenate(x) for x in zip(*found)] if found else [np.empty(0, np.int64)] * 2
        return both[0], both[1]

    def confirm(self, words: Words, hashes: np.ndarray, at: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bucket = np.minimum(np.searchsorted(self.suffix, block), len(self.suffix) - 1)
        known = self.suffix[bucket] == block
        at, bucket = at[known], bucket[known]
        whole = run_hash(hashes, at, self.n)
        low, end = self.bucket[bucket], self.bucket[bucket + 1]
        high = end.copy()
        while (low < high).any():  # binary search in each bucket at once
            mid = (low + high) // 2
            below = self.whole[np.minimum(mid, len(self.whole) - 1)] < whole
            low, high = np.where((low < high) & below, mid + 1, low), np.where((low < high) & ~below, mid, high)
        ok = low < end
        at, pattern, whole = at[ok], low[ok], whole[ok]
        start = words.start[at - self.n + 1]
        ok = (self.whole[pattern] == whole) & (words.end[at] - start == self.size[pattern])
        at, pattern, start = at[ok], pattern[ok], start[ok]
        same = [words.data[s:words.end[a]].tobytes() == self.texts[p] for a, p, s in zip(at, pattern, start)]
        ok = np.array(same, dtype=bool)
        return at[ok], pattern[ok]


class Matcher:
    """Patterns of some items, by length."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.names = [name for name, _ in items]
        words = Words([text for _, text in items])
        self.tables: list[Patterns] = []
        for self.base in BASES:
            try:
                self.tables = self._build(words, window)
                return
            except ArithmeticError:
                continue
        raise ArithmeticError("no hash without collision among the patterns")

    def _build(self, words: Words, window: int) -> list[Patterns]:
        hashes, item, n_words = words.hashes(self.base), np.arange(len(self.names)), words.counts()
        tables = []
        for n in sorted({min(int(c), window) for c in n_words if c}):
            first = words.runs(n)
            if n < window:  # only items of just n words
                first = first[n_words[words.doc[first]] == n]
            tables.append(Patterns(words, item, hashes, first, n))
        return tables

    def match(self, texts: list[bytes]) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set[int]]]:
        """For each text: number of words, spans of hit words as (first, number), items found."""
        words = Words(texts)
        hashes = words.hashes(self.base)
        edge = np.zeros(len(words) + 1, np.int64)
        items: list[set[int]] = [set() for _ in texts]
        for t in self.tables:
            last, pattern = t.search(words, hashes)
            edge += np.bincount(last - t.n + 1, minlength=len(edge)) - np.bincount(last + 1, minlength=len(edge))
            for d, p in np.unique(np.stack([words.doc[last], pattern]), axis=1).T.tolist():
                items[d].update(t.items[t.owned[p]:t.owned[p + 1]].tolist())
        hit = np.cumsum(edge)[:-1] > 0
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        for d in np.unique(words.doc[hit]).tolist():
            a, b = words.first[d], words.first[d + 1]
            spans[d] = span_list(hit[a:b])
        return words.counts(), spans, items


def span_list(hit: np.ndarray) -> list[tuple[int, int]]:
    """Runs of true values as (first, number)."""
    step = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    first, stop = np.nonzero(step == 1)[0], np.nonzero(step == -1)[0]
    return list(zip(first.tolist(), (stop - first).tolist()))


def merge_spans(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of two lists of spans of one text; spans that touch become one."""
    out: list[tuple[int, int]] = []
    for first, n in sorted([*a, *b]):
        if out and first <= out[-1][0] + out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], first + n - out[-1][0]))
        else:
            out.append((first, n))
    return out


SPANS = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))
FOUND = "spans array<struct<first:long,words:long>>, items array<string>"
_matchers: dict[str, Matcher] = {}  # the tables of the pass this worker is in


def _scan(items: list[tuple[str | None, bytes]], window: int, with_text: bool):
    token = uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if token not in _matchers:
            _matchers.clear()
            _matchers[token] = Matcher(items, window)
        m = _matchers[token]
        for batch in batches:
            for part in slices(batch):
                n, spans, hits = m.match([t.as_py() for t in part.column("data")])
                spans = [merge_spans([(x["first"], x["words"]) for x in old], new) if old else new
                         for old, new in zip(part.column("spans").to_pylist(), spans)]
                names = [sorted({*old, *(m.names[i] for i in new if m.names[i] is not None)})
                         for old, new in zip(part.column("items").to_pylist(), hits)]
                columns = {"doc_id": part.column("doc_id")} | ({"data": part.column("data")} if with_text else {})
                columns |= {"n_words": pa.array(n, pa.int64()),
                            "spans": pa.array([[{"first": a, "words": k} for a, k in s] for s in spans], SPANS),
                            "items": pa.array(names, pa.list_(pa.string()))}
                yield pa.RecordBatch.from_pydict(columns)
    return run


def _plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items as their words, joined by single spaces; items without a word go."""
    for batch in batches:
        for part in slices(batch):
            rows = []
            for name, t in zip(part.column("item").to_pylist(), part.column("data")):
                words = Words([t.as_py()])
                if len(words):
                    rows.append((name, words.data[:-1].tobytes()))
            yield batch_of("item string, data binary", rows)


def find_passages(docs: DataFrame, items: DataFrame, window: int = WINDOW, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """doc_id, n_words, spans, items for every row of ``docs`` (doc_id, text).

    ``items`` has item_id and text.  ``spans`` lists the runs of document words (first, words) that lie
    inside any occurrence of a window of an item, in order, without overlap; ``items`` lists the ids of
    the items with such windows as strings in code point order.  Null text and text without a word
    have no windows; an item of fewer than ``window`` words is one window.  Items that repeat count
    once; the hits of an item without an id are in ``spans``, but can't be listed.  Rows of ``docs`` that
    repeat or lack an id are searched each on its own.  An empty table of documents gives no row, an
    empty benchmark no hit; other columns are left out.

    A pass holds the tables of about ``pass_bytes`` of item text; a larger benchmark takes several
    passes over the documents, each adding to what the last one found, and nothing is left out.  The items
    of one pass come to the driver.  A text is searched whole, in memory of about 20 times its size.
    """
    plain = written(items.select(F.col("item_id").cast("string").alias("item"), text_bytes().alias("data"))
                    .mapInArrow(_plain, "item string, data binary").distinct(), "items")
    passes = 1 + (plain.agg(F.sum(F.octet_length("data"))).first()[0] or 0) // pass_bytes
    part = F.pmod(F.xxhash64("item", "data"), F.lit(passes))
    rows = docs.select(F.col("doc_id").cast("long"), text_bytes().alias("data"),
                       F.expr("cast(array() as array<struct<first:long,words:long>>)").alias("spans"),
                       F.expr("cast(array() as array<string>)").alias("items"))
    for k in range(passes):
        some = [(r["item"], bytes(r["data"])) for r in plain.where(part == k).collect()]
        last = k == passes - 1
        schema = "doc_id long, " + ("" if last else "data binary, ") + "n_words long, " + FOUND
        rows = rows.select("doc_id", "data", "spans", "items").mapInArrow(_scan(some, window, not last), schema)
        rows = rows if last else written(rows, "passages")
    return rows


def hit_words(spans: str = "spans"):
    """Number of hit words, as a column."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["words"])


def without_passages(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, spans, items) of the clean documents: those without any hit."""
    return find_passages(docs, items, window).where(F.size("spans") == 0)
