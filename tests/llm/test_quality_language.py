import numpy as np

from retailcast.llm import language_svm, quality_ratio, queries
from retailcast.llm.common import filter_rows, hashed_ngrams
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.brute import base_counts

TEXTS = ["", None, " \n ", "a", "a b c a b c a", "x\nx\n\nx y\nx y \n", "#*$ é ñ\t%&|<>", "w " * 70000, "a b c d " * 30,
         "one two three\none two three", "é" * 3 + " \x0b " + "日本", "- - - -"]


def docs(spark, texts, lang=None):
    return spark.createDataFrame([(i, t, lang, 1, "c") for i, t in enumerate(texts)], "doc_id long, text string, lang string, data int, doc string")


def test_base_counts_against_a_plain_version():
    for t in TEXTS:
        if t is None or len(t) < 10000:
            assert quality_ratio.base_counts((t or "").encode()) == base_counts(t), t
    assert quality_ratio.base_counts(("w " * 70000).encode())[0::4] == (70000, 70000)


def test_verdicts_by_hand(spark):
    good = [" ".join(f"plain{i}word{k}" for k in range(60)) for i in range(8)]
    noisy = [" ".join(f"pl{k}ain%%%@@" for k in range(60)) for _ in range(4)]
    texts = good + noisy + TEXTS
    df = docs(spark, texts)
    trusted = spark.createDataFrame([(i,) for i in range(8)] + [(None,), (3,)], "doc_id long")
    got = {r["doc_id"]: r for r in quality_ratio.quality_verdicts(df, trusted).collect()}
    bits = quality_ratio.BITS
    raw, target = np.zeros(1 << bits), np.zeros(1 << bits)
    for i, t in enumerate(texts):
        n = np.bincount(hashed_ngrams((t or "").encode(), 3, bits), minlength=1 << bits)
        raw += n
        target += n * (i < 8)
    ratio = np.log((target + 1) / (target.sum() + len(target))) - np.log((raw + 1) / (raw.sum() + len(raw)))
    for i, t in enumerate(texts):
        grams = hashed_ngrams((t or "").encode(), 3, bits)
        score = ratio[grams].mean() if len(grams) else 0.0
        n = base_counts(t) if len(t or "") < 10000 else (70000, 70000, 0, 0, 70000)
        failed = n[0] < 50 or 100 * n[4] > 50 * n[0]
        r = got[i]
        assert tuple(r)[1:6] == n and r["base_failed"] == failed
        assert abs(r["score"] - score) < 1e-4 and r["kept"] == (not failed and score >= quality_ratio.THRESHOLD)
    assert all(got[i]["kept"] for i in range(8)) and not any(got[i]["kept"] for i in range(8, 12))
    kept = quality_ratio.keep_good(df, trusted)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["kept"]}


def test_every_trusted_document_counts(spark):
    from pyspark.sql import functions as F

    ids = [r["id"] for r in spark.range(20_400).orderBy(F.xxhash64("id"), "id").collect()]
    rare = {i: " ".join(f"\u0436\u0448{chr(0x430 + k // 32)}{chr(0x430 + k % 32)}" for k in range(60)) for i in ids[-20:]}
    words = " ".join(f"common{k}" for k in range(8))
    rows = [(i, rare.get(i, f"{words} {i}")) for i in ids]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = quality_ratio.quality_verdicts(df, df.select("doc_id")).collect()
    assert len(got) == len(rows)
    assert all(r["kept"] for r in got if r["doc_id"] in rare)
    assert all(abs(r["score"]) < 1e-6 for r in got)  # all text is trusted: target and raw counts are the same


def test_no_trusted_text_rejects_nothing_beyond_the_base(spark):
    df = docs(spark, [" ".join(f"w{k}" for k in range(80))])
    none = spark.createDataFrame([], "doc_id long")
    assert [r["kept"] for r in quality_ratio.quality_verdicts(df, none).collect()] == [True]
    assert quality_ratio.quality_verdicts(df.limit(0), none).count() == 0


def test_filter_keeps_null_ids_and_repeats(spark):
    df = spark.createDataFrame([(None, "a", 1), (2, "b", 2), (2, "b", 2), (3, None, 3)], "doc_id long, text string, `odd name` int")
    assert sorted(map(tuple, filter_rows(df, lambda t: t != b"a").collect()), key=str) == [(2, "b", 2), (2, "b", 2), (3, None, 3)]


def test_quality_query(spark):
    rows = {r["doc_id"]: r["text"] for r in queries.table(spark, SF_SMALL, "documents").collect()}
    label = {r["doc_id"]: r["quality"] for r in queries.table(spark, SF_SMALL, "labels").collect()}
    got = queries.op4_quality_ratio(spark, SF_SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        n = base_counts(rows[r["doc_id"]]) if len(rows[r["doc_id"]]) < 6000 else tuple(r)[1:6]
        assert tuple(r)[1:6] == n
        assert r["base_failed"] == (n[0] < 50 or 100 * n[4] > 50 * n[0])
    good = [r["kept"] for r in got if label.get(r["doc_id"]) == 1 and not r["base_failed"]]
    poor = [r["kept"] for r in got if label.get(r["doc_id"]) == 0]
    assert all(good) and sum(poor) <= 0.1 * len(poor)


def test_svm_separates_and_repeats():
    rng = np.random.default_rng(0)
    x = np.hstack([rng.normal(size=(200, 6)), np.ones((200, 1))]).astype(np.float32)
    y = np.where(x[:, 0] - 0.5 * x[:, 1] + 0.2 > 0, 1, -1)
    w = language_svm.fit_svm(x, y, cost=10, rounds=40)
    assert ((x @ w > 0) == (y > 0)).mean() > 0.98 and (w == language_svm.fit_svm(x, y, cost=10, rounds=40)).all()


def test_language_query_on_held_out_documents(spark):
    lang = {r["doc_id"]: r["lang"] for r in queries.table(spark, SF_ORACLE, "documents").collect()}
    got = queries.op5_language_svm(spark, SF_ORACLE).collect()
    assert len(got) == len(lang) and all(0 <= r["score"] <= 1 for r in got)
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in got if r["held_out"] and r["lang_pred"] != "und"]
    assert len(held) > 200 and sum(held) > 0.98 * len(held)


def test_language_edge_cases(spark):
    rows = [(i, f"the words of {i} and that thing is here", "en", 0) for i in range(30)]
    rows += [(100 + i, f"le mot de {i} et une chose est ici pour vous", "fr", 0) for i in range(30)]
    rows += [(200 + i, f"las cosas de {i} y una palabra para usted con los otros", "es", 0) for i in range(30)]
    rows += [(None, "the", "en", 0), (400, None, "en", 0), (401, "", None, 0), (402, "12 34 ²½!", "xx", 0), (403, "et la chose", None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, x int")
    model = language_svm.fit_languages(df)
    assert model.langs == {"germanic": ["en"], "romance": ["es", "fr"]}
    got = {r["doc_id"]: (r["lang_pred"], r["family"]) for r in language_svm.predict_languages(df, model).collect()}
    assert got[5] == ("en", "germanic") and got[110] == ("fr", "romance") and got[210] == ("es", "romance")
    assert got[400] == got[401] == got[402] == ("und", None) and got[403] == ("fr", "romance")
    assert language_svm.keep_known(df, model, 0.0).count() == len(rows) - 3
    none = language_svm.fit_languages(df.limit(0))
    assert language_svm.predict_languages(df, none).where("lang_pred = 'und'").count() == len(rows)
    one = language_svm.fit_languages(df.where("lang = 'en'"))
    assert one.predict(b"abc") == ("en", 1.0, "germanic")
