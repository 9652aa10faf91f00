import corpus_pipeline
from pyspark.sql import functions as F

from retailcast.llm import queries, simhash_tree
from retailcast.llm.common import written
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.brute import crc, words
from tests.llm.test_records_packing import check_packing, plain  # noqa: F401


def test_stages_hand_on_what_they_keep(spark, plain):  # noqa: F811
    docs = queries.table(spark, SF_ORACLE, "documents")
    columns, steps = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        steps[name] = (docs, docs := written(stage(spark, docs, SF_ORACLE), "t"))
        assert name == "pack" or docs.columns == columns
    ids = lambda df: sorted(r[0] for r in df.select("doc_id").collect())
    before, after = steps["quality"]
    assert ids(after) == ids(queries.op4_quality_ratio(spark, SF_ORACLE).where("kept"))
    before, after = steps["language"]
    assert set(ids(after)) <= set(ids(before)) and len(ids(after)) > 0.98 * len(ids(before))
    before, after = steps["near_copies"]
    groups = simhash_tree.simhash_components(before)
    assert ids(after) == sorted(r[0] for r in groups.select("component_id").distinct().collect()) and len(ids(after)) < len(ids(before))
    before, after = steps["mix"]
    n = {r["doc_id"]: len(words(r["text"])) for r in before.collect()}
    times = {r["doc_id"]: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert max(times.values()) == 3 and abs(sum(n[i] * k for i, k in times.items()) - sum(n.values())) < 0.05 * sum(n.values())
    before, after = steps["pack"]
    pieces = [r.asDict() for r in after.collect()]
    assert all(crc(list(memoryview(bytes(p["ids"])).cast("I"))) == p["ids_crc32"] for p in pieces)
    check_packing(pieces, [(r["doc_id"], r["text"]) for r in before.select("doc_id", "text").collect()], plain, 2048, 1)


def test_odd_documents_pass_every_stage(spark):
    good = "plain words that say a little about this and that thing here and there with some more of them for the test of it all "
    rows = [(i, good * 3 + " ".join(f"w{i}x{k}" for k in range(40)), "en", "s", 1) for i in range(20)]
    rows += [(None, rows[0][1], None, None, None), (1, rows[1][1], "en", "s", 1), (1, rows[1][1], "en", "s", 1), (50, None, "en", "s", 0),
             (51, "", "en", None, 0), (52, "123 " * 90, "en", "s", 2), (53, rows[3][1], "en", None, 0)]
    for docs in (spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"),
                 spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")):
        for _name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, SF_SMALL), "t")
        n = docs.where(F.col("start") == 0).count()
        assert n == 0 if not docs.count() else n >= 10


def test_run_is_the_registered_query(spark):
    assert queries.QUERIES["pipeline"](spark, SF_SMALL).count() > 0 and corpus_pipeline.ORACLE_SQL is None


def test_keys_follow_from_the_rows(spark):
    from retailcast.llm.common import keyed

    schema = "doc_id long, text string, key string, doc int, h1 string"
    rows = [(i, f"t{i}", "k", 1, "h") for i in range(30)] + [(3, "t3", "k", 1, "h"), (3, "other", "k", 1, "h"), (None, "n", None, None, None),
                                                             (None, "n", None, None, None), (7, None, "k", 2, "h")]
    for own in (rows, rows[:30], [], [(None, None, None, None, None)], [((1 << 63) - 1, "a", "k", 1, "h")] * 2, [(-(1 << 63), "a", "k", 1, "h")] * 2):
        df = spark.createDataFrame(own, schema)
        got = [sorted(((r["key"], *r["doc"]) for r in keyed(df.repartition(n)).collect()), key=str) for n in (1, 5)]
        assert got[0] == got[1] and len({r[0] for r in got[0]}) == len(own)
        assert sorted((r[1:] for r in got[0]), key=str) == sorted(own, key=str)
        once = [r[0] for r in own if r[0] is not None and sum(o[0] == r[0] for o in own) == 1]
        assert {r[1] for r in got[0] if r[0] == r[1]} >= set(once)


def test_repeated_ids_do_not_depend_on_the_files(spark):
    docs = queries.table(spark, SF_SMALL, "documents")
    docs = written(docs.union(docs.limit(3)).union(docs.where("doc_id = 5")), "t")
    columns = sorted(docs.columns)
    for name, stage in corpus_pipeline.STAGES[2:4]:
        one, two = (stage(spark, docs.repartition(n), SF_SMALL).select(columns) for n in (3, 7))
        assert sorted(map(str, one.collect())) == sorted(map(str, two.collect())), name


def test_long_texts_and_clashing_columns_pass_every_stage(spark):
    good = "plain words that say a little about this and that thing here and there with some more of them for the test of it all "
    rows = [(i, good * 3 + " ".join(f"w{i}x{k}" for k in range(40)), "en", "s", 1, "a", 1, "b", 2.0, "c") for i in range(10)]
    words_of = good.split()
    # a new word after every two: no window of three words repeats, as the base rules of quality want
    rows.append((99, " ".join(f"{words_of[k % 25]} {words_of[k * 7 % 24]} word{k}" for k in range(20_000)), "en", "s", 1, "a", 1, "b", 2.0, "c"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string, data int, doc string, "
                                       "weight double, component_id string")
    for _name, stage in corpus_pipeline.STAGES[:-1]:
        columns, docs = docs.columns, written(stage(spark, docs, SF_SMALL), "t")
        assert docs.columns == columns
    assert docs.where("doc_id = 99").count() > 0
    pieces = written(corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL), "t")
    assert pieces.where("doc_id = 99").count() > 10
