import hashlib
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from retailcast.llm import blocklist, mixing, queries
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.brute import words
from tests.oracle_compare import compare_frames

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
@pytest.mark.parametrize("sf", [SF_SMALL])
def test_queries_match_duckdb(spark, name, sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    ok, why = compare_frames(queries.QUERIES[name](spark, sf).toPandas(), con.execute(queries.ORACLE_SQL[name]).df())
    assert ok, why


URLS = ["http://A.Example.COM/en/x?q=1#f", "https://www.example.com/en/", "http://example.com/en", "ftp://x.net/es/1", "x.net/es/1", None, "",
        "http://net/fr/2", "http://com", "http://com/", "http://Ünï.NET/fr/É", "://", "http://?q", "a?b=http://q.com/z", "http://h.org:80/a.html",
        "https://www.h.org/a/", "http://bad.org/p.htm#x", "http://bad.org/p?x=1", "http://bad.org/q", "http://example.com.evil.org/en/",
        "http://notexample.com/en/1", "line://a\nb.org/c\nd"]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
    tail = rest[end:]
    stop = min([tail.index(c) for c in "?#" if c in tail] + [len(tail)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), tail[:stop]


def test_urls_by_hand(spark):
    rules = queries.URL_RULES
    pages = spark.createDataFrame([(i, u, "h", "k") for i, u in enumerate(URLS)] + [(0, URLS[0], "h", "k")],
                                  "page_id long, url string, host int, key string".replace("host int", "host string"))
    listed = spark.createDataFrame([("https://www.bad.org/p.html",), ("http://bad.org/p",), (None,), ("nohost",), ("http://h.org/a",)], "url string")
    bad = {"bad.org/p", "h.org/a"}
    got = sorted(map(tuple, blocklist.judge_urls(pages, listed, rules).select("page_id", "host", "path", "rule", "verdict", "listed").collect()))
    want = []
    for i, u in [*enumerate(URLS), (0, URLS[0])]:
        host, path = plain_parts(u)
        fit = [(h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fit, key=lambda f: len(f[0]), default=(None, None))
        h = host.removeprefix("www.")
        h = h[:-3] if h.endswith(":80") else h
        p = path.rstrip("/")
        p = p.removesuffix(".html") if p.endswith(".html") else p.removesuffix(".htm")
        hit = bool(host) and h + p in bad
        want.append((i, host, path, rule, verdict or ("block" if hit else "allow"), hit))
    assert got == sorted(want)
    none = listed.limit(0)
    assert blocklist.judge_urls(pages, none, []).where("verdict = 'block'").count() == 0
    assert blocklist.judge_urls(pages.limit(0), listed, rules).count() == 0


def test_filter_misses_nothing_and_passes_little(spark):
    keys = spark.range(40_000).selectExpr("concat('host', id % 977, '.org/p', id) as key")
    listed = keys.limit(0).union(keys.where("crc32(key) % 8 = 0"))
    n = listed.count()
    blocks = 1 + n // blocklist.KEYS_PER_BLOCK
    passed = blocklist.possible_hits(keys, blocklist.build_filter(listed, blocks), blocks)
    assert listed.join(passed, "key", "left_anti").count() == 0
    assert passed.count() - n < 0.02 * (40_000 - n)


def test_native_plan(spark):
    plan = queries.op6_url_blocklist(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "html" not in plan.split("ReadSchema", 1)[1].split("\n")[0]


def plain_mix(rows, weight_of, weights, most, seed):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, capped = {}, set()
    while True:  # share what the capped sources leave, until none is above its cap
        left = sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        total = sum(w[s] for s in names if s not in capped)
        target = {s: most * sizes[s] if s in capped else left * w[s] / total for s in names}
        over = {s for s in names if target[s] > most * sizes[s] + 1e-9}
        if not over:
            break
        capped |= over

    def key(doc):
        name = f"{'null' if doc is None else doc}:{seed}"
        return -math.log((int(hashlib.md5(name.encode()).hexdigest()[:12], 16) + 0.5) / (1 << 48)) / weight_of.get(doc, 1.0)

    out = []
    for s in names:
        full = int(target[s] // sizes[s] + 1e-9) if sizes[s] else 0
        budget, before = target[s] - full * sizes[s], 0
        for doc, text, _ in sorted((r for r in rows if r[2] == s), key=lambda r: (key(r[0]), len(words(r[1])), r[0] or -1)):
            n = len(words(text))
            out.append((doc, s, n, sizes[s], round(target[s], 4), n * min(most, full + (before + n / 2 <= budget + 1e-9))))
            before += n
    return sorted(out, key=str)


@pytest.mark.parametrize("bucket_rows", [3, 5000])
def test_mix_against_a_plain_version(spark, bucket_rows):
    rows = [(i, "w " * (1 + i * 7 % 90), f"s{i % 3}") for i in range(120)] + [(200 + i, "a b c", None) for i in range(9)]
    rows += [(300, None, "s0"), (301, "", "zz"), (None, "x y", "s1"), (302, "v " * 4000, "big"), (5, "twice twice", "s2"), (5, "twice twice", "s2")]
    df = spark.createDataFrame([(*r, 1, "w") for r in rows], "doc_id long, text string, source string, size int, weight string").repartition(4)
    weight = {i: 1 + i % 4 / 2 for i in range(60)}
    quality = spark.createDataFrame([(i, w) for i, w in weight.items()] + [(None, 3.0), (7, 0.0)], "doc_id long, weight double")
    mixed = mixing.mix(df, quality=quality, seed=4, bucket_rows=bucket_rows)
    got = [(r["doc_id"], r["source"], r["size"], r["source_size"], round(r["target"], 4), r["taken"]) for r in mixed.collect()]
    assert sorted(got, key=str) == plain_mix(rows, weight, mixing.WEIGHTS, 3, 4)
    assert all(r[5] <= 3 * r[2] for r in got)
    assert mixing.mix(df.limit(0)).count() == 0


@pytest.mark.parametrize("weight", [200.0, 0.01, None])
def test_ranges_are_even_whatever_the_weights(spark, weight, monkeypatch):
    """No key range holds more than twice the mean, so none is large to sort."""
    seen = []
    own = mixing.written
    monkeypatch.setattr(mixing, "written", lambda df, name: seen.append((name, own(df, name))) or seen[-1][1])
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.lit("s").alias("source"))
    mixed_weights = F.lit(weight) if weight else F.exp(F.col("id") % 12 - 4.0)
    quality = df.select("doc_id", F.col("doc_id").alias("id")).select("doc_id", mixed_weights.cast("double").alias("weight"))
    assert mixing.mix(df, quality=quality, bucket_rows=200).count() == 20_000
    rows, plan = dict(seen)["mix"], dict(seen)["plan"].first()
    share = F.aggregate(F.array(*[F.struct(F.lit(k["weight"]).alias("w"), F.lit(k["rows"]).alias("n")) for k in plan["kinds"]]), F.lit(0.0),
                        lambda s, k: s + k["n"] * (1 - F.exp(-k["w"] * F.col("draw")))) / plan["rows"]
    per = [r["count"] for r in rows.groupBy(F.floor(share * plan["ranges"])).count().collect()]
    assert plan["ranges"] == 101 and len(per) > 95 and max(per) <= 2 * 20_000 / 101


def test_weights_that_are_no_positive_numbers_count_as_one(spark):
    rows = [(i, "w " * (3 + i), "s") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    odd = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, -1.0), (4, 0.0), (5, None)], "doc_id long, weight double")
    one, two = (sorted((r["doc_id"], r["epochs"]) for r in mixing.mix(df, quality=q).collect()) for q in (odd, None))
    assert one == two


def test_mix_reaches_its_targets(spark):
    got = queries.op7_source_mix(spark, SF_ORACLE).join(queries.table(spark, SF_ORACLE, "documents").select("doc_id", "source"), "doc_id")
    per = got.groupBy("source").agg({"taken": "sum", "target": "max", "size": "max"}).collect()
    assert len(per) > 5 and all(abs(r["sum(taken)"] - r["max(target)"]) <= r["max(size)"] for r in per)
