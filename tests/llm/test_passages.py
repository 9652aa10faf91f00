import hashlib
import random
import re

import numpy as np
import pytest

from retailcast.llm import pattern_search, queries
from retailcast.llm.words import WORD_CHARS, Words, crc32_of
from tests.conftest import SF_SMALL

PATTERN = re.compile(WORD_CHARS)
DOCS = "doc_id long, text string, data string, spans int, items string, n_words string"
ITEMS = "item_id long, text string, doc_id string, data int"


def words(text):
    return PATTERN.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, window=10):
    """(n_words, hit words, items) by comparing every window with every window."""
    found = []
    for _, text in docs:
        w, hit, names = words(text), set(), set()
        for name, t in items:
            p = words(t)
            n = min(len(p), window)
            for i in range(len(p) - n + 1 if n else 0):
                for k in range(len(w) - n + 1):
                    if w[k:k + n] == p[i:i + n]:
                        hit.update(range(k, k + n))
                        names |= {str(name)} - {"None"}
        found.append((len(w), hit, sorted(names)))
    return found


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, "x", 1, "y", "z") for i, t in docs], DOCS)
    b = spark.createDataFrame([(i, t, "x", 1) for i, t in items], ITEMS)
    out = pattern_search.find_passages(d, b, **options)
    assert out.columns == ["doc_id", "n_words", "spans", "items"]
    rows = out.collect()
    hits = lambda r: {k for s in r["spans"] for k in range(s["first"], s["first"] + s["words"])}
    assert all(a["first"] + a["words"] < b["first"] for r in rows for a, b in zip(r["spans"], r["spans"][1:]))
    return sorted((str(r["doc_id"]), r["n_words"], sorted(hits(r)), r["items"]) for r in rows)


def expected(docs, items, window=10):
    return sorted((str(i), n, sorted(hit), names) for (i, _), (n, hit, names) in zip(docs, plain(docs, items, window)))


def random_text(rng, n, vocabulary):
    return "".join(rng.choice(vocabulary) + rng.choice([" ", "  ", "\n", ", ", "-", "\u007f", "\x00"]) for _ in range(n))


def test_words_and_checksums():
    import zlib

    texts = ["", "A b1,Été 日本", "z" * 500 + " {x}", "  ", " ", "a_b`c~d\u007fe"]
    w = Words([t.encode() for t in texts])
    own = [w.data[s:e].tobytes().decode() for s, e in zip(w.start, w.end)]
    assert own == [x for t in texts for x in words(t)] and w.counts().tolist() == [len(words(t)) for t in texts]
    assert w.doc.tolist() == [i for i, t in enumerate(texts) for _ in words(t)]
    assert crc32_of(w.data, w.start, w.end).tolist() == [zlib.crc32(x.encode()) for x in own]
    h = w.hashes(pattern_search.BASES[0])
    assert len(set(zip(own, h.tolist()))) == len(set(own)) == len(set(h.tolist()))
    assert len(Words([])) == 0 and len(Words([b"", b" "]).hashes(3)) == 0


@pytest.mark.parametrize("window", [1, 2, 10])
def test_against_every_window(spark, window):
    rng = random.Random(window)
    vocabulary = ["a", "B", "b", "aa", "é", "x9", "日"]
    items = [(i, random_text(rng, rng.choice([0, 1, 2, 5, 9, 10, 11, 25]), vocabulary)) for i in range(12)]
    items += [(3, items[3][1]), (90, None), (91, ""), (92, " . "), (93, items[4][1]), (None, "only an item without a name")]
    docs = [(i, random_text(rng, rng.choice([0, 3, 9, 10, 40, 200]), vocabulary)) for i in range(15)]
    docs += [(100 + i, random_text(rng, 30, vocabulary) + " " + (t or "") + " " + random_text(rng, 5, vocabulary)) for i, (_, t) in enumerate(items)]
    docs += [(500, None), (501, ""), (None, items[5][1]), (501, items[6][1]), (501, items[6][1]), (502, "Only AN item, without a name?")]
    want = expected(docs, items, window)
    assert run(spark, docs, items, window=window) == want
    assert run(spark, docs, items, window=window, pass_bytes=120) == want  # several passes


def test_shift_bounds_in_a_long_text(spark):
    rng = random.Random(5)
    filler = [f"w{k}" for k in range(3000)]
    passage = [f"p{k}" for k in range(30)]
    text = [rng.choice(filler) for _ in range(150_000)]
    for at in (0, 63, 128, 1000, 1031, 149_970):
        text[at:at + 30] = passage
    text[5000:5009] = passage[:9]  # too short to count
    text[6000:6010] = passage[7:17]
    docs = [(1, " ".join(text)), (2, " ".join(passage[:9])), (3, " ".join(passage[20:]))]
    got = {r[0]: r for r in run(spark, docs, [(7, " ".join(passage)), (8, "p1 p3"), (9, "w1 p0")])}
    hit = set(got["1"][2])
    want = {k for at in (0, 63, 128, 1000, 1031, 149_970) for k in range(at, at + 30)} | set(range(6000, 6010))
    assert hit == want
    assert got["2"][2] == [] and got["3"][2] == list(range(10)) and got["3"][3] == ["7"]


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b")]) == []
    assert run(spark, [(1, "a b")], []) == [("1", 2, [], [])]
    assert run(spark, [(1, "a b")], [(1, None)]) == [("1", 2, [], [])]


def test_colliding_hashes_take_another_base(monkeypatch):
    monkeypatch.setattr(pattern_search, "BASES", (0, pattern_search.BASES[0]))  # base 0 only sees first letters
    m = pattern_search.Matcher([("1", b"ab cd"), ("2", b"ax cx")], 2)
    assert m.base != 0 and m.match([b"x ab cd ax cx"])[1] == [[(1, 4)]]
    monkeypatch.setattr(pattern_search, "BASES", (0,))
    with pytest.raises(ArithmeticError):
        pattern_search.Matcher([("1", b"ab cd"), ("2", b"ax cx")], 2)


def test_positions_are_skipped():
    """Words far from any pattern are looked at once in nine positions."""
    items = Words([b" ".join(b"p%d" % k for k in range(40))])
    t = pattern_search.Patterns(items, np.arange(1), items.hashes(pattern_search.BASES[0]), items.runs(10), 10)
    assert t.shift.max() == 9 and (t.shift == 9).mean() > 0.5


def test_clean_documents_and_digest(spark):
    docs, items = queries.table(spark, SF_SMALL, "documents"), queries.table(spark, SF_SMALL, "benchmark")
    got = {r["doc_id"]: r for r in queries.op11_pattern_search(spark, SF_SMALL).collect()}
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    named = [(r["item_id"], r["text"]) for r in items.collect()]
    grams = {}
    for name, text in named:
        p = words(text)
        for i in range(max(1, len(p) - 9)):
            grams.setdefault(tuple(p[i:i + 10]), set()).add(name)
    assert all(len(words(t)) >= 10 for _, t in named)
    for doc_id, text in pairs:
        w, hit, found = words(text), set(), set()
        for i in range(len(w) - 9):
            if tuple(w[i:i + 10]) in grams:
                hit.update(range(i, i + 10))
                found |= grams[tuple(w[i:i + 10])]
        r = got[doc_id]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (len(w), len(hit), len(found), bool(hit))
        assert r["items_sha256"] == hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
    clean = pattern_search.without_passages(docs, items)
    assert {r["doc_id"] for r in clean.collect()} == {i for i, r in got.items() if not r["contaminated"]}
    assert any(r["contaminated"] for r in got.values()) and not all(r["contaminated"] for r in got.values())
