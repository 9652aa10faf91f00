import math
import random

import numpy as np

from retailcast.llm import embedding_links, queries, simhash_tree
from retailcast.llm.common import written
from retailcast.llm.components import connected_components
from tests.conftest import SF_SMALL
from tests.llm.brute import components, cosine, simhash


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 540)] + [(7, 7), (900, 901), (901, 900)]
    links += [(rng.randint(1000, 1080), rng.randint(1000, 1080)) for _ in range(50)]
    rng.shuffle(links)
    df = spark.createDataFrame(links + [(None, 3)], "a long, b long").repartition(7)
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    real = [(a, b) for a, b in links if a != b]
    assert got == components({x for p in real for x in p}, real)
    assert connected_components(df.limit(0)).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string, rep long, vec string, tile int")


def check_vectors(got, rows, threshold):
    bad = lambda v: v is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v)
    ok = [r for r in rows if r[0] is not None and r[2] is not None and not bad(r[1])]
    links = [(a[0], b[0]) for i, a in enumerate(ok) for b in ok[i + 1:]
             if a[2] == b[2] and len(a[1]) == len(b[1]) and cosine(a[1], b[1]) >= threshold]
    comp = components({r[0] for r in rows if r[0] is not None}, links)
    n = {r[0]: sum((r[0] == a) + (r[0] == b) for a, b in links) for r in ok}
    want = sorted(((r[0], n.get(r[0], 0), comp.get(r[0]), r[0] is not None and comp[r[0]] == r[0]) for r in rows), key=str)
    assert sorted(map(tuple, got), key=str) == want


def test_vector_links_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    rows, k = [], 0
    for label, base in (("a", 6), ("b", 3), (None, 1)):
        for centre in rng.normal(size=(base, 20)):
            for noise in (0.0, 0.0, 0.02, 0.1, 0.1, 0.14, 0.18, 0.2, 0.2):
                rows.append((k, [float(x) for x in centre + noise * rng.normal(size=20)], label, 1, "x", 2))
                k += 1
    big = [1e300, 2e300] + [0.0] * 18
    rows += [(k, big, "a", 0, "", 0), (k + 1, [x * 1e-320 for x in big], "a", 0, "", 0), (k + 2, [0.0] * 20, "a", 0, "", 0),
             (k + 3, None, "a", 0, "", 0), (k + 4, [1.0, None], "a", 0, "", 0), (k + 5, [float("nan")] * 20, "a", 0, "", 0),
             (k + 6, [float("inf")] * 20, "a", 0, "", 0), (k + 7, [], "a", 0, "", 0), (k + 8, [3.0, 4.0], "a", 0, "", 0),
             (k + 9, [6.0, 8.0], "a", 0, "", 0), (None, [3.0, 4.0], "a", 0, "", 0)]
    for tile in (5, 2048):
        got = embedding_links.link_embeddings(vectors(spark, rows), 0.98, tile_rows=tile)
        check_vectors(got.collect(), [r[:3] for r in rows], 0.98)


def test_vector_links_of_nothing(spark):
    assert embedding_links.link_embeddings(vectors(spark, [])).count() == 0
    one = embedding_links.link_embeddings(vectors(spark, [(5, [1.0, 0.0], "a", 0, "", 0)])).collect()
    assert [tuple(r) for r in one] == [(5, 0, 5, True)]


def test_few_tiles_of_a_large_cell_meet(spark):
    """Many groups in one cell of the first direction: all links are found, and few of the pairs of tiles are compared."""
    rng = np.random.default_rng(8)
    centres = np.column_stack([np.full(60, 5.0), rng.normal(size=(60, 9)) * [6, 6, 2, 2, 1, 1, 1, 1, 1]])
    rows = [(k, [float(x) for x in centres[k % 60] + 0.05 * rng.normal(size=10)], "a", 1, "x", 2) for k in range(1200)]
    # one crowded point: more rows than a tile in one bucket of every direction
    rows += [(2000 + k, [float(x) for x in centres[0] + 1e-5 * rng.normal(size=10)], "a", 1, "x", 2) for k in range(60)]
    seen = []
    real = embedding_links._meeting
    embedding_links._meeting = lambda tiles, t: seen.append((tiles.count(), (m := written(real(tiles, t), "t")).count())) or m
    try:
        got = embedding_links.link_embeddings(vectors(spark, rows), 0.98, tile_rows=10).collect()
    finally:
        embedding_links._meeting = real
    check_vectors(got, [r[:3] for r in rows], 0.98)
    tiles, pairs = seen[0]
    assert tiles >= 120 and pairs < tiles * tiles / 8


def test_simhash_of_texts(spark):
    texts = ["", " \t\n", "one", "one two", "A b C", "a b c", "a b c d e f g", "Ä ä   x", "x\x0by z", "word " * 70000, None]
    rows = [(i, t, "f", 0, "k") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, fp int, part string")
    got = {r["doc_id"]: r["fingerprint"] for r in simhash_tree.simhash_components(df).collect()}
    assert got == {i: f"{simhash(t):016x}" for i, t in enumerate(texts)}
    assert simhash_tree.simhash_components(df.limit(0)).count() == 0


def test_near_fingerprints_against_all_pairs(spark):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(400)] + [0, (1 << 64) - 1]
    values = set(base)
    for x in base[:150]:
        for _ in range(4):
            y = x
            for b in rng.sample(range(64), rng.randint(1, 5)):
                y ^= 1 << b
            values.add(y)
    hub = base[0]
    values |= {hub ^ 1 << a ^ 1 << b for a in range(20) for b in range(20)}  # a ball of many near values
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    want = components(signed, [(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3])
    df = spark.createDataFrame([(x,) for x in signed * 2], "fp long").repartition(5)
    for leaf in (16, 64, 4096):
        edges = simhash_tree.fingerprint_links(df, 3, leaf_rows=leaf).collect()
        assert components(signed, [tuple(e) for e in edges]) == want


def test_shards_grow_before_their_number_does(spark, monkeypatch):
    depths = []
    real = simhash_tree.Tree.__init__
    monkeypatch.setattr(simhash_tree.Tree, "__init__", lambda self, sample, depth: (depths.append(depth), real(self, sample, depth))[1])
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    values = np.unique(np.concatenate([base, base[:300] ^ np.uint64(0b1011), base[300:500] ^ np.uint64(0b10111)]))
    df = spark.createDataFrame([(int(x),) for x in values], "fp long")
    want = {(min(a, b), max(a, b)) for a, b in zip(base[:300].tolist(), (base[:300] ^ np.uint64(0b1011)).tolist())}
    for most, depth in ((1 << 20, 6), (20, 8)):
        monkeypatch.setattr(simhash_tree, "LEAF_MOST", most)
        edges = {(min(e), max(e)) for e in simhash_tree.fingerprint_links(df, 3, leaf_rows=4).collect()}
        assert edges == want and depths[-1] == depth


def test_deep_search_within_a_shard():
    rng = np.random.default_rng(5)
    t = rng.integers(0, 1 << 63, 6000, dtype=np.uint64)
    q = np.concatenate([t[:40] ^ np.uint64(0b111), t[40:80] ^ np.uint64(0b1111), rng.integers(0, 1 << 63, 2000, dtype=np.uint64)])
    found = {(int(a), int(b)) for i, j in simhash_tree.near(q, t, 3) for a, b in zip(i, j)}
    assert found == {(k, k) for k in range(40)}


def test_a_ball_is_searched_in_bounded_pairs_of_parts(spark):
    rng = np.random.default_rng(1)
    fps = np.unique(rng.integers(0, 1 << 63, 9000, dtype=np.uint64))
    packed = lambda stored, x: (0, stored, len(x), x.tobytes())
    rows = [packed(True, x) for x in np.array_split(fps[:5000], 7)] + [packed(False, x) for x in np.array_split(fps[5000:], 3)]
    dealt = spark.createDataFrame(rows, "leaf long, stored boolean, n long, fps binary")
    pairs = simhash_tree._pairs_of_parts(dealt, 500).collect()
    task = {}
    for r in pairs:
        task.setdefault((r["target"], r["other"]), {True: [], False: []})[r["own"]] += np.frombuffer(r["fps"], np.uint64).tolist()
    assert max(len(x[True]) + len(x[False]) for x in task.values()) < 1.4 * 2 * 500
    met = sum(len(x[True]) * len(x[False]) if t != o else len(x[True]) * (len(x[True]) - 1) // 2 for (t, o), x in task.items())
    n, q = 5000, len(fps) - 5000
    assert met == n * (n - 1) // 2 + n * q  # every stored pair and every query once


def test_queries_on_the_small_tables(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in queries.table(spark, SF_SMALL, "embeddings").collect()]
    check_vectors(queries.op2_embedding_links(spark, SF_SMALL).collect(), rows, 0.98)
    docs = {r["doc_id"]: simhash(r["text"]) for r in queries.table(spark, SF_SMALL, "documents").collect()}
    ids = sorted(docs)
    comp = components(ids, [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if (docs[a] ^ docs[b]).bit_count() <= 3])
    got = queries.op3_simhash_tree(spark, SF_SMALL).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {i: (f"{docs[i]:016x}", comp[i]) for i in ids}
