import hashlib

import pytest
from pyspark.sql import functions as F

from retailcast.llm import merkle_manifest, queries
from tests.conftest import SF_SMALL

FIELDS = merkle_manifest.FIELDS
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, h string, tree int, path string, idx int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes, arity):
    """root, and for each node the list of (left, right) sibling digests from the bottom."""
    paths, own, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for k, at in enumerate(own):
            run = range(at - at % arity, min(len(level), at - at % arity + arity))
            paths[k].append(("".join(level[j] for j in run if j < at), "".join(level[j] for j in run if j > at)))
        level = [sha("".join(level[i:i + arity])) for i in range(0, len(level), arity)]
        own = [at // arity for at in own]
    return level[0], paths


def plain(rows, arity=3):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((own, *climb([leaf(r) for r in own], arity)))
    root, tops = climb([t[1] for t in trees], arity)
    return sorted((str(r[0]), str(r[1]), leaf(r), path + top, sub, root)
                  for (own, sub, paths), top in zip(trees, tops) for r, path in zip(own, paths))


def run(spark, rows, arity=3, parts=3):
    df = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA).repartition(parts)
    out = merkle_manifest.merkle_manifest(df, arity=arity, carry={"n_chars": F.col("n_chars")})
    assert out.columns == ["doc_id", "source", "leaf", "path", "subroot", "root", "n_chars"]
    out = out.withColumn("folded", merkle_manifest.fold_path("leaf", "path")).collect()
    assert all(r["folded"] == r["root"] for r in out)
    return sorted((str(r["doc_id"]), str(r["source"]), r["leaf"], [(s["left"], s["right"]) for s in r["path"]], r["subroot"], r["root"])
                  for r in out)


def rows_of(source, n, start=0):
    return [(start + k, source, "en", 3, f"text {k}\né") for k in range(n)]


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_trees_of_all_sizes(spark, arity):
    rows = [r for k, n in enumerate([1, 2, 3, 4, 5, 9, 10, 25, 26, 27, 28, 82]) for r in rows_of(f"s{k}", n, 1000 * k)]
    rows += rows_of(None, 7) + rows_of("", 4) + rows_of("é", 2) + rows_of("Z", 1) + [rows[5]] * 4
    rows += [(None, "s1", None, None, None), (None, "s1", None, None, None), (None, None, None, None, "x"), (-9, "s2", "", 0, ""),
             (8, "s3", "en", 1, "t" * 300_000), (8, "s3", "en", 1, "other")]
    assert run(spark, rows, arity) == plain(rows, arity)


def test_several_tiers(spark, monkeypatch):
    monkeypatch.setattr(merkle_manifest, "CHUNK_ROWS", 9)  # two levels a chunk: 700 rows take four tiers
    monkeypatch.setattr(merkle_manifest, "RANGE_ROWS", 100)
    rows = rows_of("hot", 700) + rows_of("small", 5) + rows_of("mid", 82) + [r for k in range(30) for r in rows_of(f"x{k}", 1)]
    assert run(spark, rows) == plain(rows)


def test_a_chunk_of_full_size(spark):
    rows = rows_of("hot", 2187 + 5) + rows_of("other", 2)
    assert run(spark, rows) == plain(rows)


def test_one_row_and_no_row(spark):
    one = rows_of("s", 1)
    assert run(spark, one) == plain(one) and run(spark, one)[0][3] == []
    df = spark.createDataFrame([], SCHEMA)
    assert merkle_manifest.merkle_manifest(df).count() == 0


def test_layout_does_not_matter(spark):
    rows = rows_of("a", 40) + rows_of("b", 3) + [rows_of("a", 1)[0]] * 30
    assert run(spark, rows, parts=1) == run(spark, rows, parts=6)


def test_tampered_rows_fail(spark):
    docs = {r["doc_id"]: r for r in queries.table(spark, SF_SMALL, "documents").collect()}
    got = {r["doc_id"]: r for r in queries.op13_merkle_manifest(spark, SF_SMALL).collect()}
    rows = [tuple(r[f] for f in FIELDS) for r in docs.values()]
    want = {int(i): (a, path, sub, root) for i, _, a, path, sub, root in plain(rows)}
    import zlib

    broken = 0
    for i, r in got.items():
        a, path, sub, root = want[i]
        assert (r["leaf"], r["subroot"], r["root"]) == (a, sub, root)
        assert r["proof_sha256"] == sha("".join(x + y for x, y in path))
        d = docs[i]
        changed = zlib.crc32(str(i).encode()) % 2 == 0 and d["text"] is not None and "\n" in d["text"]
        h = leaf([d[f] if f != "text" or not changed else d[f].replace("\n", "") for f in FIELDS])
        for x, y in path:
            h = sha(x + h + y)
        assert r["folded_root"] == h and r["verified"] == (h == root) == (not changed)
        broken += changed
    assert broken > 0
