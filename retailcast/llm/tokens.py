"""Token ids of whole texts with a public tokenizer file, quicker on repeated words.

A byte-level BPE splits a text into pieces before it merges anything, and a single space
or line feed between two non-space characters always starts a new piece.  So a text can be
cut there and the ids of its parts joined: equal parts are encoded once and looked up later.
The ids of words stay known from text to text, in a table whose size is bounded.
Texts in which white space comes in any other form are cut only where the rule holds.
"""

from __future__ import annotations

import codecs
import functools
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A space between two characters that are no white space
CUT = re.compile(r"(?<=\S) (?=\S)")
LATIN = "[A-Za-zªµºÀ-ÖØ-öø-ɏ]"
# Latin letters, perhaps ASCII marks after them (no apostrophe: it may begin a piece)
RUN = rf"^\n?{LATIN}+[!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{{|}}~]*$"
LETTER, MARK = (np.isin(np.arange(256), list(chars)) for chars in (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"))
MOST_MARKS = 8  # after a run of letters; words with more are encoded on their own
TEXT_AT_ONCE = 2 << 20  # characters cut into words at a time
# Known words, and bytes of them and their ids; beyond, the half of the words that most blocks of text held stays
KNOWN_WORDS, KNOWN_BYTES = 400_000, 24 << 20
LONGEST_KNOWN = 64  # bytes of a word that may stay


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level BPE files write for each byte value."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {b: chr(b if b in plain else next(spare)) for b in range(256)}


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers, equal to Tokenizer.encode's.

    ``special``: the string of a special token in a text is its id, as the library does unless told
    otherwise; without it that string is ordinary text.
    """

    def __init__(self, path: str | None = None, special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path or tokenizer_path())
        self.tokenizer.encode_special_tokens = not special
        # strings that are matched before a text is cut into words
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if special or not t.special]
        # words can be joined only under a plain byte-level model; any other file is used whole
        pre = self.tokenizer.pre_tokenizer
        self.by_word = isinstance(pre, ByteLevel) and pre.use_regex and not pre.add_prefix_space and \
            self.tokenizer.normalizer is None and self.tokenizer.post_processor is None and len(self.plain("\n")) == 4
        if not self.by_word:
            return
        # the same model on pieces that are in byte letters already and parted by spaces; in the
        # table byte 1 stands for the space before a word
        self.pieces = Tokenizer(self.tokenizer.model)
        self.pieces.pre_tokenizer = WhitespaceSplit()
        letters = _byte_letters()
        self.table = "".join(" " if b == 32 else letters[32] if b == 1 else letters[b] for b in range(256))
        vocabulary = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, i in vocabulary.items():
            self.sizes[i] = len(token)
        self.line = np.frombuffer(self.plain("\n"), "<u4")[0]
        # the known words; where each one's ids begin in the pool, their number, whether a line feed's id comes
        # first, whether the word can't be encoded on its own, and how many blocks of text held it
        self.words, self.pool = pa.array([], pa.large_string()), np.empty(0, "<u4")
        self.starts, self.counts, self.seen = (np.empty(0, np.int32) for _ in range(3))
        self.lead, self.odd = (np.empty(0, bool) for _ in range(2))

    def plain(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _runs(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(is the word a run of letters with a few marks after it, ids of all such words, number of ids of each).

        One call encodes them all; its ids are cut again by the lengths of their tokens.  A word's own line
        feed is left out.
        """
        offsets = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1)
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8, offsets[-1])
        begin, end = offsets[:-1].copy(), offsets[1:].copy()
        full = end > begin
        begin[full] += data[begin[full]] == 10
        core = end.copy()
        for _ in range(MOST_MARKS):
            at = np.nonzero(core > begin)[0]
            core[at] -= MARK[data[core[at] - 1]]
        kind = np.where(data >= 128, 1 << 32, 0) + ~(LETTER[data] | (data >= 128))
        sums = np.concatenate([[0], np.cumsum(kind)])
        inside = sums[core] - sums[begin]  # bytes of no letter, and beyond ASCII in the upper half
        run = (core > begin) & (inside == 0)
        far = np.nonzero((core > begin) & (inside > 0) & (inside % (1 << 32) == 0))[0]
        run[far] = pc.match_substring_regex(words.take(pa.array(far)), RUN).to_numpy(zero_copy_only=False)
        begin, core, end = begin[run], core[run], end[run]
        if not len(begin):
            return run, np.empty(0, "<u4"), np.empty(0, np.int64)
        # the letters with what parts them: byte 1 before a word, a space before its marks and after it
        own = np.concatenate([[0], np.cumsum(end - begin)])
        take = np.repeat(begin - own[:-1], end - begin) + np.arange(own[-1])
        first = begin > offsets[:-1][run]
        places = np.concatenate([own[:-1][~first], own[:-1] + core - begin, own[1:]])
        values = np.repeat(np.array([1, 32, 32], np.uint8), [(~first).sum(), len(begin), len(begin)])
        order = np.argsort(places + np.where(np.arange(len(places)) < (~first).sum(), 0.5, 0), kind="stable")
        raw = np.insert(data[take], places[order], values[order]).tobytes()
        text = codecs.charmap_decode(raw, "strict", self.table)[0]
        ids = np.array(self.pieces.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        letters = np.cumsum(end - begin + ~first)
        return run, ids, np.diff(np.searchsorted(np.cumsum(self.sizes[ids]), letters) + 1, prepend=0)

    def _places(self, words: pa.Array) -> np.ndarray:
        """Places of different words among the known ones; new words are encoded and become known."""
        found = pc.index_in(words, value_set=self.words)
        new = np.nonzero(found.is_null().to_numpy(zero_copy_only=False))[0]
        at = np.array(found.fill_null(0))
        at[new] = np.arange(len(self.words), len(self.words) + len(new))
        if len(new):
            self._learn(words.take(pa.array(new)))
        self.seen[at] += 1
        return at

    def _learn(self, words: pa.Array) -> None:
        runs, ids, n = self._runs(words)
        sizes, lead, odd = np.zeros(len(words), np.int64), np.zeros(len(words), bool), np.zeros(len(words), bool)
        sizes[runs] = n
        lead[runs] = pc.starts_with(words, "\n").to_numpy(zero_copy_only=False)[runs]
        starts = len(self.pool) + np.cumsum(sizes) - sizes - lead  # a line feed's id stands before its word's
        pools, at = [self.pool, ids], len(self.pool) + len(ids)
        for k in np.nonzero(~runs)[0]:
            w = words[int(k)].as_py()
            first = w.startswith("\n")
            odd[k] = w[first:].split() != [w[first:]]  # empty, or white space within
            if not odd[k]:
                ids = np.frombuffer(self.plain(w if first else " " + w), "<u4")
                starts[k], sizes[k], at = at, len(ids), at + len(ids)
                pools.append(ids)
                if first and ids[0] != self.line:
                    raise ValueError(f"a line feed joins its word in {w!r}")
        self.words, self.pool = pa.concat_arrays([self.words, words]), np.concatenate(pools)
        self.starts = np.concatenate([self.starts, starts.astype(np.int32)])
        self.counts = np.concatenate([self.counts, (sizes + lead).astype(np.int32)])
        self.seen = np.concatenate([self.seen, np.zeros(len(words), np.int32)])
        self.lead, self.odd = np.concatenate([self.lead, lead]), np.concatenate([self.odd, odd])

    def _forget(self) -> None:
        """Half of the known words stay, those that most blocks of text held, but no long ones; later blocks weigh more."""
        short = np.nonzero(pc.binary_length(self.words).to_numpy() <= LONGEST_KNOWN)[0]
        stay = np.sort(short[np.argsort(-self.seen[short], kind="stable")[:len(self.words) // 2]])
        lead, counts = self.lead[stay], self.counts[stay]
        own = counts - lead
        ends = np.cumsum(own, dtype=np.int32)
        self.pool = self.pool[np.repeat(self.starts[stay] + lead - (ends - own), own) + np.arange(own.sum(), dtype=np.int32)]
        self.words, self.seen = self.words.take(pa.array(stay)), self.seen[stay] // 2
        self.starts, self.counts, self.lead, self.odd = ends - counts, counts, lead, self.odd[stay]

    def _by_parts(self, text: str) -> bytes:
        first, *rest = CUT.split(text)
        return self.plain(first) + b"".join(self.plain(" " + p) for p in rest)

    def encode_many(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text; equal words of texts that come together are encoded once."""
        if not self.by_word:
            yield from (self.plain(t) if t else b"" for t in texts)
            return
        some, size = [], 0
        for text in texts:
            if any(a in text for a in self.added):
                yield from self._encode_some(some)
                yield self.plain(text)
                some, size = [], 0
                continue
            some.append(text)
            size += len(text)
            if size >= TEXT_AT_ONCE:
                yield from self._encode_some(some)
                some, size = [], 0
        yield from self._encode_some(some)

    def _encode_some(self, texts: list[str]) -> Iterator[bytes]:
        """Cut all texts into words, encode those not known yet, and put the ids of all words in place."""
        if not texts:
            return
        # the first word of a text is written like one after a line feed, whose id is dropped again
        texts = [t.replace("\n", " \n") for t in texts]
        words = pc.split_pattern(pa.array(["\n" + " \n".join(texts)], pa.large_string()), " ").values.dictionary_encode()
        codes = self._places(words.dictionary)[words.indices.to_numpy()]
        counts, lead, odd = self.counts[codes], self.lead[codes], self.odd[codes]
        ends = np.cumsum(counts, dtype=np.int32)
        place = np.repeat(self.starts[codes] - (ends - counts), counts)
        place += np.arange(ends[-1], dtype=np.int32)
        ids = self.pool[place]
        ids[(ends - counts)[lead]] = self.line
        del words, place
        if len(self.words) > KNOWN_WORDS or self.words.nbytes + self.pool.nbytes > KNOWN_BYTES:
            self._forget()
        pa.default_memory_pool().release_unused()
        has_odd = odd.any()
        word = 0
        for text in texts:
            n = text.count(" ") + 1
            if not text:
                yield b""
            elif has_odd and odd[word:word + n].any():
                yield self._by_parts(text.replace(" \n", "\n"))
            else:
                yield ids[ends[word] - counts[word] + 1:ends[word + n - 1]].tobytes()
            word += n

    def encode(self, text: str) -> bytes:
        return next(self.encode_many([text]))


@functools.lru_cache(maxsize=2)
def encoder(path: str | None = None, special: bool = False) -> Encoder:
    """The worker's encoder for a tokenizer file, loaded once per process."""
    return Encoder(path, special)
