"""Words of a batch of texts as numpy arrays: letters, digits and everything beyond ASCII, A-Z lower-cased.

The words of all texts stand in one buffer, each followed by one space, so that any run of
consecutive words of a text, joined by single spaces, is a slice of the buffer.
"""

from __future__ import annotations

import zlib

import numpy as np

WORD_CHARS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"  # the same words as a pattern over lower-cased text
SPACE = 0x20
LONG_WORD = 64  # bytes; the few longer spans get their checksum one by one


def _byte_table() -> np.ndarray:
    """Lower-case form of each byte that belongs to a word, a space for the others."""
    table = np.full(256, SPACE, np.uint8)
    for lo, hi in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[lo:hi + 1] = np.arange(lo, hi + 1)
    table[0x41:0x5B] = table[0x61:0x7B]
    return table


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, c >> 1 ^ np.uint32(0xEDB88320), c >> 1)
    return c.astype(np.uint32)


BYTES, CRC = _byte_table(), _crc_table()


class Words:
    """``data`` holds the words; word i is data[start[i]:end[i]] and belongs to text doc[i].

    Text k has the words first[k] to first[k + 1] - 1.  An array of about 20 times the texts' size is
    needed for a moment, so callers pass batches of a few megabytes.
    """

    def __init__(self, texts: list[bytes]):
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        begins = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        low = BYTES[np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)]
        inside = low != SPACE
        after = np.zeros_like(inside)  # the byte before belongs to a word
        after[1:] = inside[:-1]
        at = np.nonzero(inside & ~after)[0]
        self.data = low[inside | after]
        self.end = np.nonzero(self.data == SPACE)[0]
        self.start = np.concatenate([[0], self.end[:-1] + 1]).astype(np.int64) if len(self.end) else self.end
        self.first = np.searchsorted(at, begins)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, base: int) -> np.ndarray:
        """A 64-bit polynomial hash of each word; equal words have equal hashes, others may."""
        if not len(self):
            return np.empty(0, np.uint64)
        sizes = self.end + 1 - self.start
        powers = np.full(int(sizes.max()), base, np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        inside = np.arange(len(self.data)) - np.repeat(self.start, sizes)
        return np.add.reduceat(self.data.astype(np.uint64) * powers[inside], self.start)

    def runs(self, n: int) -> np.ndarray:
        """Positions of the first words of all runs of n consecutive words of one text."""
        if len(self) < n:
            return np.empty(0, np.int64)
        last = len(self) - n + 1
        return np.nonzero(self.doc[:last] == self.doc[n - 1:])[0]


def crc32_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of many slices of a byte array, column by column over slices sorted by length."""
    sizes = end - start
    out = np.zeros(len(start), np.uint32)
    for i in np.nonzero(sizes > LONG_WORD)[0]:
        out[i] = zlib.crc32(data[start[i]:end[i]])
    short = np.nonzero(sizes <= LONG_WORD)[0]
    order = short[np.argsort(LONG_WORD - sizes[short].astype(np.uint8), kind="stable")]
    at, left = start[order], np.searchsorted(-sizes[order], -np.arange(LONG_WORD + 1), "left")
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for k in range(LONG_WORD):  # left[k]: slices of more than k bytes
        n = left[k]
        if not n:
            break
        c = crc[:n]
        crc[:n] = CRC[(c ^ data[at[:n] + k]) & np.uint32(255)] ^ (c >> np.uint32(8))
    out[order] = ~crc
    return out
