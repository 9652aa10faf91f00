import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from retailcast.llm import packing, queries, records, tokens
from retailcast.llm.common import shared_path
from retailcast.llm.tokens import Encoder, tokenizer_path
from tests.conftest import SF_SMALL
from tests.llm.brute import crc

ODD = ["", " ", "\n", "a\n\nb", " a", "a ", "a  b", "a \nb", "a\n b", "tab\tword x", "x y z", "don't can't 's", "42 7a a7",
       "<|endoftext|> end", "ß Êtes ñ", "日本 語", "a\x1cb c", "!!! ... ,a", "\r\n x", "end\n", "a" * 5000, "word " * 3000 + "w"]


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_encoder_equals_the_tokenizer(plain):
    e = Encoder()
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice([" ", "\n", "a", "B", "é", ".", "'", "s", "7", "\t", " ", "ʼ", "_"]) for _ in range(40))
                   for _ in range(400)]
    for t in texts:
        assert list(np.frombuffer(e.encode(t), "<u4")) == plain(t), repr(t)
    assert [list(np.frombuffer(x, "<u4")) for x in e.encode_many(texts)] == [plain(t) for t in texts]


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, shard int")


def test_records_round_trip(spark, plain):
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD)] + [(None, "no id", None, 2), (3, "again", "y", 3), (3, "again", "y", 3), (99, None, "", 0)]
    path = shared_path(spark, "t")
    records.write_records(_docs(spark, rows), path, end_id=2, shard_bytes=4000)
    got = records.read_records(spark, path).toPandas().sort_values("start")
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    hashed = lambda t: 42 if t is None else signed(xxhash.xxh64_intdigest(t, 42))
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashed(r[1])))
    assert [None if np.isnan(x) else int(x) for x in got["doc_id"].astype(float)] == [r[0] for r in order]
    start = 0
    for (_, text, *_x), at, n, ids in zip(order, got["start"], got["n_tokens"], got["ids"]):
        want = plain(text or "") + [2]
        assert (at, n, list(np.frombuffer(ids, "<u4"))) == (start, len(want), want)
        start += n
    index = records.read_index(spark, path)
    assert index.count() == len(rows) and index.select("shard").distinct().count() > 3


def test_shuffled_read_is_a_permutation_by_seed(spark):
    path = shared_path(spark, "t")
    records.write_records(_docs(spark, [(i, f"text {i}", "", 0) for i in range(60)]), path, shard_bytes=100)
    read = lambda seed: [r[0] for r in records.read_shuffled(spark, path, seed, 3).collect()]
    one, same, other = read(1), read(1), read(2)
    assert one == same != other and sorted(one) == sorted(other) == list(range(60)) != one


def test_shuffled_read_seeks_to_its_records(spark, monkeypatch):
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD)] + [(None, "no id", None, 2), (3, "again", "y", 3), (3, "again", "y", 3), (98, "long " * 60_000, "", 0)]
    path = shared_path(spark, "t")
    records.write_records(_docs(spark, rows), path, shard_bytes=4000)
    same = lambda df: [(r["doc_id"], r["n_tokens"], bytes(r["ids"])) for r in df.collect()]
    drawn = records.read_shuffled(spark, path, 5, 4)
    assert "content" not in drawn._jdf.queryExecution().executedPlan().toString()  # no shard is read whole
    monkeypatch.setattr(records, "ARROW_SCHEMES", ())
    whole = records.read_shuffled(spark, path, 5, 4)
    assert same(drawn) == same(whole) and len(same(whole)) == len(rows)
    monkeypatch.undo()
    monkeypatch.setattr(records, "SEEK_BYTES", 50)
    assert same(records.read_shuffled(spark, path, 5, 4)) == same(whole)
    empty = shared_path(spark, "t")
    records.write_records(_docs(spark, rows[:0]), empty)
    assert records.read_shuffled(spark, empty, 5, 4).count() == 0


def test_damaged_records_are_refused():
    good = records.frame(7, struct.pack("<3I", 1, 70000, 2)) + b"\n"
    assert [r[1:6] for r in records.parse("s", good * 2)] == [(0, 0, len(good), 7, 3), (1, len(good), len(good), 7, 3)]
    for at in range(len(good)):
        bad = good[:at] + bytes([good[at] ^ 1]) + good[at + 1:]
        with pytest.raises(ValueError):
            list(records.parse("s", bad))
    with pytest.raises(ValueError):
        list(records.parse("s", good[:-3]))


def test_empty_tables(spark):
    path = shared_path(spark, "t")
    none = _docs(spark, [])
    records.write_records(none, path)
    assert records.read_records(spark, path).count() == 0
    assert packing.pack_documents(none).count() == 0


def check_packing(pieces, docs, plain, max_len, end_id):
    want = {}
    for i, t in docs:
        want.setdefault(i, []).append(plain(t or "") + [end_id])
    by_seq = {}
    for p in pieces:
        by_seq.setdefault(p["sequence_id"], []).append(p)
        assert any(crc(w[p["start"]:p["start"] + p["length"]]) == p["ids_crc32"] and len(w) == p["doc_tokens"] for w in want[p["doc_id"]])
    assert sum(p["length"] for p in pieces) == sum(len(w) for v in want.values() for w in v)
    padding = 0
    for seq in by_seq.values():
        at = 0
        for p in sorted(seq, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert 0 < at <= max_len
        padding += 0 if at & (at - 1) == 0 else max_len - at
    assert set(by_seq) == set(range(len(by_seq)))
    return padding


def test_packing_covers_every_id_once(spark, plain):
    rng = random.Random(5)
    texts = ODD + ["ab " * rng.randint(1, 60) for _ in range(200)]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "none", "", 0), (1, None, "", 0), (1, "twice", "", 0), (1, "twice", "", 0)]
    pieces = [r.asDict() for r in packing.pack_documents(_docs(spark, rows), max_len=64, end_id=1).collect()]
    padding = check_packing(pieces, [(r[0], r[1]) for r in rows], plain, 64, 1)
    assert padding < 0.02 * sum(p["length"] for p in pieces)
    seqs = packing.sequences(packing.pack_documents(_docs(spark, rows), max_len=64), pad_id=0, max_len=64).collect()
    assert all(len(s["ids"]) == 4 * (s["length"] if s["length"].bit_count() == 1 else 64) for s in seqs)


def test_shortest_pack_first_uses_up_the_histogram():
    rng = random.Random(1)
    for _ in range(30):
        top = rng.choice([8, 64, 500])
        counts = {rng.randint(1, top): rng.randint(1, 40) for _ in range(rng.randint(1, 60))}
        patterns, got = packing.shortest_pack_first(counts, top), {}
        for n, lengths in patterns:
            assert n > 0 and sum(lengths) <= top
            for x in lengths:
                got[x] = got.get(x, 0) + n
        assert got == counts


def test_queries_on_the_small_table(spark, plain):
    docs = queries.table(spark, SF_SMALL, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    got = queries.op1_token_records(spark, SF_SMALL).orderBy("doc_id").collect()
    start = 0
    for d, r in zip(docs, got, strict=True):
        ids = plain(d["text"] or "") + [2]
        assert tuple(r) == (d["doc_id"], start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    pieces = [r.asDict() for r in queries.op8_sequence_packing(spark, SF_SMALL).collect()]
    padding = check_packing(pieces, [tuple(d) for d in docs], plain, 2048, 1)
    assert padding < 0.02 * sum(p["length"] for p in pieces)


def test_a_hot_length_fills_its_own_sequences():
    rng = random.Random(2)
    for hot in (40, 100, 300, 700):
        counts = {}
        for _ in range(600):
            n = rng.randint(1, 599)
            counts[n] = counts.get(n, 0) + 1
        counts[hot] = counts.get(hot, 0) + 300
        open_ = []  # placed one by one, longest first, each into the shortest open pack with room
        for length in sorted(counts, reverse=True):
            for _ in range(counts[length]):
                least = min(open_, default=2048)
                if least + length <= 2048:
                    open_.remove(least)
                    open_.append(least + length)
                else:
                    open_.append(length)
        patterns = packing.shortest_pack_first(counts)
        tokens = sum(n * x for x, n in counts.items())
        assert sorted(sum(p) for n, p in patterns for _ in range(n)) == sorted(open_)
        assert sum(n * (2048 - sum(p)) for n, p in patterns) < 0.03 * tokens


def test_packing_a_table_with_a_hot_length(spark, plain):
    rng = random.Random(6)
    texts = ["ab " * rng.randint(1, 25) for _ in range(200)] + ["ab " * 4] * 100
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    pieces = [r.asDict() for r in packing.pack_documents(_docs(spark, rows), max_len=64, end_id=1).collect()]
    padding = check_packing(pieces, [(r[0], r[1]) for r in rows], plain, 64, 1)
    assert padding < 0.03 * sum(p["length"] for p in pieces)


def test_queries_encode_like_an_unchanged_tokenizer(spark, tmp_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    default = lambda text: t.encode(text, add_special_tokens=False).ids
    texts = [*ODD, "a<|endoftext|>b", "x <|endoftext|>\n<|endoftext|> y", "<|endoftext|", "later"]
    assert default("<|endoftext|> end") == [50256, 886]
    e = Encoder(special=True)
    assert [list(np.frombuffer(x, "<u4")) for x in e.encode_many(texts)] == [default(x) for x in texts]
    _docs(spark, [(i, x, "", 0) for i, x in enumerate(texts)]).write.parquet(f"{tmp_path}/documents.parquet")
    start = 0
    for text, r in zip(texts, queries.op1_token_records(spark, str(tmp_path)).orderBy("doc_id").collect(), strict=True):
        ids = default(text) + [2]
        assert tuple(r)[1:] == (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    pieces = [r.asDict() for r in queries.op8_sequence_packing(spark, str(tmp_path)).collect()]
    check_packing(pieces, list(enumerate(texts)), default, 2048, 1)


class Counted:
    """The encoder's tokenizer of pieces, keeping the words that it is given."""

    def __init__(self, pieces):
        self.pieces, self.words = pieces, []

    def encode_batch_fast(self, texts, **options):
        self.words += [w for t in texts for w in t.split()]
        return self.pieces.encode_batch_fast(texts, **options)


def _counted():
    e = Encoder(special=True)
    e.pieces = Counted(e.pieces)
    return e, e.pieces.words


def test_records_encode_a_word_once_over_many_batches(monkeypatch, plain):
    e, words = _counted()
    monkeypatch.setattr(records, "encoder", lambda *_: e)
    texts = ["one two\nthree, one", "two one\nthree, four", "one two\nthree, four five"]
    batches = [pa.record_batch([pa.array([k], pa.int64()), pa.array([t])], names=["doc_id", "text"]) for k, t in enumerate(texts)]
    data = b"".join(f.as_py() + b"\n" for b in records._frames(None, 2, True)(iter(batches)) for f in b.column("frame"))
    assert [list(np.frombuffer(r[-1], "<u4")) for r in records.parse("s", data)] == [plain(t) + [2] for t in texts]
    # a word is another one after a line feed, with a space before it and with none; marks are words of their own
    assert sorted(words) == sorted(["one", "Ġtwo", "three", ",", "Ġone", "two", "Ġfour", "Ġfive"])


def test_packing_encodes_a_word_once_over_many_batches(monkeypatch, plain):
    e, words = _counted()
    monkeypatch.setattr(packing, "encoder", lambda *_: e)
    texts = ["of the\nday", "the of\nday", "of of\nthe the", "<|endoftext|> of", "of the night"]
    batches = [pa.record_batch([pa.array([k], pa.int64()), pa.array([k], pa.int64()), pa.array([t])], names=["row_id", "doc_id", "text"])
               for k, t in enumerate(texts)]
    got = {}
    for b in packing._cut(None, 1, 3, True)(iter(batches)):
        for r in b.to_pylist():
            got.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert got == {k: ([50256] + plain(" of") if k == 3 else plain(t)) + [1] for k, t in enumerate(texts)}
    assert sorted(words) == sorted(["of", "Ġthe", "day", "the", "Ġof", "Ġnight"])


def test_the_table_of_known_words_stays_small(monkeypatch, plain):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["a", "of", "\nthe", "\n", "", "can't", "x" * 90, "7%", "né", f"w{rng.random()}"]) for _ in range(30)) for _ in range(300)]
    want = [plain(t) for t in texts]
    monkeypatch.setattr(tokens, "TEXT_AT_ONCE", 200)
    for words, size in ((40, 1 << 20), (1 << 20, 500), (1, 1)):
        monkeypatch.setattr(tokens, "KNOWN_WORDS", words)
        monkeypatch.setattr(tokens, "KNOWN_BYTES", size)
        e = Encoder()
        for at in range(0, len(texts), 50):
            assert [list(np.frombuffer(x, "<u4")) for x in e.encode_many(texts[at:at + 50])] == want[at:at + 50]
            assert len(e.words) <= max(words, 40) and e.words.nbytes + e.pool.nbytes <= max(size, 500)
    often = [t for t in ("of", "\nthe", "a") for _ in range(9)]
    monkeypatch.setattr(tokens, "KNOWN_WORDS", 8)
    monkeypatch.setattr(tokens, "KNOWN_BYTES", 1 << 20)
    e, words = _counted()
    for k in range(20):
        e.encode(f"x of the of the w{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 2]}")
    assert words.count("Ġof") == words.count("Ġthe") == 1  # what every text holds is not forgotten
