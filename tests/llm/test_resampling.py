import hashlib
import math
import random
import zlib

import pytest

from retailcast.llm import queries, target_resampling
from tests.conftest import SF_SMALL
from tests.llm.test_passages import words

DOCS = "doc_id long, text string, n_words string, place int, score string, block int"


def grams(text, order):
    w = words(text)
    return [" ".join(w[i:i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1)]


def plain(docs, target, percent=10, least=20, seed=2024, order=1, buckets=10_000):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for _, text in docs:
        for g in grams(text, order):
            s[bucket(g)] += 1
    for text in target:
        for g in grams(text, order):
            t[bucket(g)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    out = []
    for doc_id, text in docs:
        g = [gain[bucket(x)] for x in grams(text, order)]
        weight = sum(g) // len(g) if g else 0
        h = int(hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(words(text)), len(g), weight, score, None])
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2]))
    for k, r in enumerate(fit[:len(fit) * percent // 100]):
        r[5] = k + 1
    return sorted(map(tuple, out), key=str)


def run(spark, docs, target, **options):
    d = spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in docs], DOCS)
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    out = target_resampling.resample(d, goal, **options)
    assert out.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def corpus(n, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)] + ["été", "日本", "x" * 100]
    return [(k, " ".join(rng.choices(vocabulary, k=rng.choice([0, 5, 19, 20, 21, 60, 200])))) for k in range(n)]


@pytest.mark.parametrize("options", [{}, {"order": 2, "percent": 50, "seed": 7, "buckets": 500}, {"percent": 100, "least": 0}])
def test_against_a_plain_version(spark, options):
    docs = corpus(300)
    docs += [(None, docs[5][1]), (None, None), (7, docs[8][1]), (7, docs[8][1]), (7, docs[8][1] + " more"), (-5, docs[9][1]), (400, None),
             (401, " , "), (402, "one " * 30000)]
    target = [" ".join(f"w{k}" for k in range(40)), "", None, "w1 w2 w3 other words"]
    own = {("min_words" if k == "least" else k): v for k, v in options.items()}
    assert run(spark, docs, target, **own) == plain(docs, target, **options)


def test_empty_tables(spark):
    assert run(spark, [], ["a"]) == []
    assert run(spark, corpus(40), []) == plain(corpus(40), [])


def test_radix_sort(spark, monkeypatch):
    monkeypatch.setattr(target_resampling, "BLOCK_BITS", 5)  # many blocks
    monkeypatch.setattr(target_resampling, "DIGIT_BITS", 6)
    rng = random.Random(3)
    ends = [-(1 << 63), (1 << 63) - 1, 0, -1, 1]
    for a_values, b_values in (([5], list(range(40))), (ends, [7, 8]), ([k * k for k in range(90)], [-3, -2, 1000]), ([1] * 9 + [2], ends)):
        rows = [(rng.choice(a_values), rng.choice(b_values), k) for k in range(700)]
        got = target_resampling.radix_sort(spark.createDataFrame(rows, "a long, b long, tag long").repartition(5), ["a", "b"]).collect()
        assert sorted(r["place"] for r in got) == list(range(len(rows)))
        assert [(r["a"], r["b"]) for r in sorted(got, key=lambda r: r["place"])] == sorted((a, b) for a, b, _ in rows)
        assert sorted(r["tag"] for r in got) == list(range(len(rows)))


def test_ranks_do_not_depend_on_the_layout(spark):
    docs = queries.table(spark, SF_SMALL, "documents").select("doc_id", "text")
    docs = docs.union(docs.limit(20))
    goal = queries.table(spark, SF_SMALL, "benchmark")
    one, two = (sorted(map(tuple, target_resampling.resample(docs.repartition(n), goal, percent=40).collect()), key=str) for n in (2, 7))
    assert one == two == plain([tuple(r) for r in docs.collect()], [r["text"] for r in goal.collect()], percent=40)
