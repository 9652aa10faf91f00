"""Footers, samples, tolerant loads, completeness, the commit log and recommendations."""

import datetime as dt
import os
import threading

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailcast.operators import completeness, ledger, models, recommend, validate
from retailcast.sources import commit_log, files, footers
from tests.conftest import SF_SMALL

D = dt.date
SCHEMA = T.StructType([T.StructField("date", T.DateType()), T.StructField("x", T.LongType())])


def put(path, dates, rows_per_group=2):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table({"date": pa.array(dates, pa.date32()), "x": pa.array(range(len(dates)), pa.int64())}), path, row_group_size=rows_per_group)


@pytest.fixture()
def folder(tmpdir_path):
    """Two good files and one of each bad kind."""
    put(f"{tmpdir_path}/a/good.parquet", [D(2024, 1, k) for k in (3, 1, 2, 9, 8)])
    put(f"{tmpdir_path}/b/nulls.parquet", [None, None, D(2023, 5, 5), D(2024, 6, 6)])
    put(f"{tmpdir_path}/b/empty.parquet", [])
    for name, data in (("b/junk.parquet", b"no parquet at all"), ("a/zero.parquet", b"")):
        with open(f"{tmpdir_path}/{name}", "wb") as f:
            f.write(data)
    whole = open(f"{tmpdir_path}/a/good.parquet", "rb").read()
    with open(f"{tmpdir_path}/a/cut.parquet", "wb") as f:
        f.write(whole[:-20])
    return tmpdir_path


WANT = {"good.parquet": (5, None), "nulls.parquet": (4, None), "empty.parquet": (0, "no rows"), "junk.parquet": (None, "damaged footer"),
        "cut.parquet": (None, "damaged footer"), "zero.parquet": (None, "zero bytes"), "gone.parquet": (None, "missing file")}


def expected_files(spark, folder):
    names = [f"file://{folder}/a/{n}" for n in ("good.parquet", "zero.parquet", "gone.parquet", "gone.parquet")] + [None]
    return spark.createDataFrame([(n,) for n in names], "path string")


@pytest.mark.parametrize("schemes", [footers.ARROW_SCHEMES, ()])  # by footers, and through Spark's own reader
def test_reasons_and_dates(spark, folder, monkeypatch, schemes):
    monkeypatch.setattr(footers, "ARROW_SCHEMES", schemes)
    facts = footers.read_footers(spark, folder, expected=expected_files(spark, folder), schema=SCHEMA).collect()
    got = {os.path.basename(r["path"]): r for r in facts}
    assert len(facts) == 7 and {n: (r["n_rows"], r["problem"]) for n, r in got.items()} == WANT
    assert (got["good.parquet"]["first_date"], got["good.parquet"]["last_date"]) == (D(2024, 1, 1), D(2024, 1, 9))
    assert (got["nulls.parquet"]["first_date"], got["nulls.parquet"]["last_date"]) == (D(2023, 5, 5), D(2024, 6, 6))
    if schemes:
        assert got["good.parquet"]["row_groups"] == 3


def test_manifest_with_date_range(spark, folder):
    per = {r["dataset"]: r for r in footers.manifest(spark, folder).collect()}
    assert (per["a"]["n_files"], per["a"]["n_rows"], per["a"]["bad_files"], per["a"]["last_date"]) == (2, 5, 1, D(2024, 1, 9))
    assert (per["b"]["n_files"], per["b"]["n_rows"], per["b"]["bad_files"], per["b"]["first_date"]) == (3, 4, 2, D(2023, 5, 5))
    one = footers.manifest_summary(footers.manifest(spark, folder)).first()
    assert one["file_counts"] == {"a": 2, "b": 3} and (one["total_rows"], one["first_date"]) == (9, D(2023, 5, 5))
    s = footers.footer_summary(footers.read_footers(spark, folder)).first()
    assert (s["files"], s["good_files"], s["total_rows"], s["problems"]) == (5, 2, 9, {"damaged footer": 2, "no rows": 1})
    assert footers.manifest(spark, folder, ("nothing",)).where("first_date is not null").count() == 0


def test_footers_against_duckdb(spark):
    for name, col in (("lineitem", "l_shipdate"), ("orders", "o_orderdate"), ("events", "ts"), ("part", "p_name")):
        path = f"{SF_SMALL}/{name}.parquet"
        r = footers.read_footers(spark, path, (col,)).first()
        rows, groups = duckdb.sql(f"SELECT num_rows, num_row_groups FROM parquet_file_metadata('{path}')").fetchall()[0]
        low, high = duckdb.sql(f"SELECT min(try_cast(stats_min_value AS DATE)), max(try_cast(stats_max_value AS DATE)) "
                               f"FROM parquet_metadata('{path}') WHERE path_in_schema = '{col}'").fetchall()[0]
        assert (r["n_rows"], r["row_groups"], r["problem"]) == (rows, groups, None)
        assert (r["first_date"], r["last_date"]) == (low, high)


def test_file_checks_name_the_reason(spark, folder):
    issues = validate.file_checks(spark, expected_files(spark, folder), folder, SCHEMA).collect()
    assert sorted(r["issue"] for r in issues) == ["damaged footer", "damaged footer", "missing file", "no rows", "zero bytes"]
    s = validate.data_summary(footers.read_footers(spark, folder), validate.file_checks(spark, expected_files(spark, folder), folder), 2).first()
    assert (s["files_validated"], s["total_rows"], s["bad_files"], s["issues_found"], len(s["issues"])) == (5, 9, 3, 5, 2)


# ------------------------------------------------------------------ samples --
def test_only_chosen_files_are_in_the_plan(spark, tmpdir_path):
    root = f"{tmpdir_path}/t+x"
    for k in range(12):
        put(f"{root}/part={k:02d}/f.parquet", [D(2024, 1, 1)] * (k + 1))
    first = files.read_sample(spark, root, 3, SCHEMA)
    assert [p.split("part=")[1][:2] for p in sorted(first.inputFiles())] == ["00", "01", "02"] and first.count() == 6
    assert sorted(r["part"] for r in first.select("part").distinct().collect()) == [0, 1, 2]
    drawn = files.sample_files(spark, root, 4, seed=1)
    assert drawn == files.sample_files(spark, root, 4, seed=1) and len(drawn) == 4 != len(set(drawn) & set(files.sample_files(spark, root, 4, seed=2)))
    assert len(files.read_sample(spark, root, 99, SCHEMA, seed=5).inputFiles()) == 12
    kept = files.read_sample(spark, root, 2, SCHEMA, keep=F.col("path").contains("part=1"))
    assert sorted(r["part"] for r in kept.select("part").distinct().collect()) == [10, 11]
    with pytest.raises(ValueError):
        files.read_sample(spark, root, 2, SCHEMA, keep=F.lit(False))


def test_tolerant_load_reports_every_file(spark, folder, tmpdir_path):
    os.remove(f"{folder}/a/zero.parquet")
    whole = bytearray(open(f"{folder}/a/good.parquet", "rb").read())
    whole[4:40] = b"\xff" * 36  # sound footer, broken pages
    with open(f"{folder}/b/pages.parquet", "wb") as f:
        f.write(whole)
    rows, report = files.tolerant_load(spark, folder, SCHEMA, f"{tmpdir_path}-loaded")
    got = {os.path.basename(r["file"]): (r["n_rows"], r["status"], r["reason"]) for r in report.collect()}
    assert got["good.parquet"] == (5, "read", None) and got["nulls.parquet"] == (4, "read", None)
    assert got["empty.parquet"] == (0, "skipped", "no rows") and got["junk.parquet"] == (0, "skipped", "damaged footer") == got["cut.parquet"]
    assert got["pages.parquet"][1:] == ("skipped", "damaged pages")
    listed = files.list_files(spark, folder, "*.parquet").count()
    assert listed == len(got) == sum(s == "read" for _, s, _ in got.values()) + sum(s == "skipped" for _, s, _ in got.values())
    assert rows.columns == ["date", "x"] and rows.count() == 9


# ------------------------------------------------------------- completeness --
def test_found_items_against_substrings(spark):
    import random

    rng = random.Random(4)
    keys = ["/".join("".join(rng.choices("ab", k=rng.choice([1, 3, 9, 12]))) for _ in range(3)) for _ in range(60)] + ["", None, "été/日本語の名前"]
    names = ["".join(rng.choices("ab/", k=rng.choice([0, 1, 2, 7, 8, 9, 14]))) for _ in range(150)] + [None, "日本", "日本語の名前", "é/é", keys[0], keys[0] + "x"]
    got = completeness.found_items(spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame([(k,) for k in keys], "key string"))
    want = {n: any(n in k for k in keys if k is not None) for n in names if n is not None}
    assert {r["name"]: r["found"] for r in got.collect()} == want and len(set(want.values())) == 2
    none = spark.createDataFrame([], "key string")
    assert not any(r["found"] for r in completeness.found_items(spark.createDataFrame([("",), ("a",)], "name string"), none).collect())
    assert completeness.found_items(spark.createDataFrame([], "name string"), spark.createDataFrame([("a",)], "key string")).count() == 0


def test_a_hundred_thousand_names(spark):
    names = spark.range(100_000).select(F.format_string("artifacts/models/model_%06d", "id").alias("name"))
    keys = spark.range(0, 100_000, 2).select(F.format_string("s3/run/artifacts/models/model_%06d/weights.bin", "id").alias("key"))
    report = completeness.completeness_report(completeness.found_items(names, keys), keys).first()
    assert tuple(report) == (50_000, 100_000, 50_000, 50_000, False)


def test_artifact_check(spark, tmpdir_path):
    spark.range(3).coalesce(1).write.parquet(f"{tmpdir_path}/models/forest")
    exp = spark.createDataFrame([("models/forest",), ("weights",)], "name string")
    report, items = completeness.artifact_check(spark, tmpdir_path, exp, "*.parquet")
    assert tuple(report.first()) == (1, 2, 1, 1, False) and {r["name"]: r["found"] for r in items.collect()} == {"models/forest": True, "weights": False}
    assert completeness.artifact_check(spark, f"{tmpdir_path}/models", exp.limit(1), "*.parquet")[0].first()["success"] is False  # below the root only
    assert tuple(completeness.artifact_check(spark, f"{tmpdir_path}/nowhere", exp)[0].first()) == (0, 2, 0, 2, False)


# --------------------------------------------------------------- commit log --
def test_put_if_absent_has_one_winner(spark, tmpdir_path):
    won = []

    def writer(k):
        if commit_log.put_if_absent(spark, f"{tmpdir_path}/x/1.json", str(k)):
            won.append(k)

    threads = [threading.Thread(target=writer, args=(k,)) for k in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and open(f"{tmpdir_path}/x/1.json").read() == str(won[0]) and os.listdir(f"{tmpdir_path}/x") == ["1.json"]


def test_put_if_absent_by_rename(spark, tmpdir_path):
    spark._jsparkSession.sparkContext().hadoopConfiguration().set("fs.viewfs.mounttable.rc.link./t", f"file://{tmpdir_path}")
    path = "viewfs://rc/t/log/1.json"
    assert commit_log.put_if_absent(spark, path, "one") and not commit_log.put_if_absent(spark, path, "two")
    assert open(f"{tmpdir_path}/log/1.json").read() == "one" and [n for n in os.listdir(f"{tmpdir_path}/log") if not n.endswith(".crc")] == ["1.json"]


def test_writers_with_skewed_clocks_never_share_a_version(spark, tmpdir_path, monkeypatch):
    class Skewed(dt.datetime):
        @classmethod
        def now(cls, tz=None):
            own = int(threading.current_thread().name.split("-")[-1]) if "writer" in threading.current_thread().name else 0
            return dt.datetime(2024, 1, 1, tzinfo=tz) - dt.timedelta(days=own * 100)

    monkeypatch.setattr(ledger.dt, "datetime", Skewed)
    got = []

    def writer(name):
        for k in range(4):
            r = ledger.register_version(spark, tmpdir_path, "a model/with: odd name", f"{name}-{k}").first()
            got.append((r["version"], r["run_id"]))

    threads = [threading.Thread(target=writer, args=(f"run{k}",), name=f"writer-{k}") for k in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(v for v, _ in got) == list(range(1, 13))
    held = {(r["version"], r["run_id"]) for r in ledger.versions(spark, tmpdir_path).collect()}
    assert held == set(got)  # who read a version back still holds it
    assert ledger.register_version(spark, tmpdir_path, "other", "r").first()["version"] == 1


def test_readers_see_whole_tables(spark, tmpdir_path):
    commit_log.write_snapshot(spark.range(100).withColumn("v", F.lit(0)), tmpdir_path)
    seen, errors, done = [], [], threading.Event()

    def reader():
        while not done.is_set():
            try:
                seen.append({(r["v"], r["count"]) for r in commit_log.read_snapshot(spark, tmpdir_path).groupBy("v").count().collect()})
            except Exception as e:  # noqa: BLE001
                errors.append(e)
                return

    t = threading.Thread(target=reader)
    t.start()
    for v in range(1, 6):
        commit_log.write_snapshot(spark.range(100).withColumn("v", F.lit(v)), tmpdir_path)
    done.set()
    t.join()
    assert not errors and seen and all(len(s) == 1 and next(iter(s))[1] == 100 for s in seen)


def test_snapshots(spark, tmpdir_path):
    with pytest.raises(ValueError):
        commit_log.read_snapshot(spark, tmpdir_path)
    assert commit_log.write_snapshot(spark.range(3), tmpdir_path) == 1
    with pytest.raises(Exception):  # a writer that fails leaves the table as it was
        commit_log.write_snapshot(spark.range(3).select(F.raise_error(F.lit("stop")).alias("id")), tmpdir_path)
    assert commit_log.write_snapshot(spark.range(5), tmpdir_path) == 2
    assert commit_log.write_snapshot(spark.range(2), tmpdir_path, append=True) == 3
    counts = [commit_log.read_snapshot(spark, tmpdir_path, n).count() for n in (1, 2, 3, None)]
    assert counts == [3, 5, 7, 7] and len(commit_log.vacuum(spark, tmpdir_path, keep=1)) == 2
    assert commit_log.read_snapshot(spark, tmpdir_path).count() == 7
    schema = T.StructType([T.StructField("number", T.LongType()), T.StructField("folders", T.ArrayType(T.StringType()))])
    assert sorted((r["number"], len(r["folders"])) for r in commit_log.entries(spark, tmpdir_path, schema).collect()) == [(1, 1), (2, 1), (3, 2)]


# -------------------------------------------- recommendations, bounds, small --
def test_recommendations(spark):
    measured = spark.createDataFrame([("train_rows", 12.0), ("n_features", 51.0), ("mean_shift_test", 0.2), ("zero_target_share", None),
                                      ("mean_shift_validation", 0.256), ("unknown", 9.0)], "check string, value double")
    got = {r["check"]: r for r in recommend.recommendations(measured, recommend.rule_table(spark)).collect()}
    assert set(got) == {"train_rows", "n_features", "mean_shift_validation"}
    assert "25.6%" in got["mean_shift_validation"]["text"] and "20.0%" in got["mean_shift_validation"]["text"]
    assert got["train_rows"]["text"].startswith("Only 12 training rows (at least 1000 ") and got["train_rows"]["severity"] == "warning"
    own = [("a", ">=", 1.0, "x", "count", "{value} of {threshold}"), ("a", "<=", 1.0, "y", "percent", "{value}"), ("a", "?", 0.0, "z", "count", "")]
    fired = recommend.recommendations(spark.createDataFrame([("a", 1.0)], "check string, value double"), recommend.rule_table(spark, own))
    assert {r["text"] for r in fired.collect()} == {"1 of 1", "100.0%"}


def test_given_bounds_double_no_row(spark):
    preds = spark.createDataFrame([(1, 5.0), (2, 6.0), (None, 7.0)], "date int, prediction double")
    bounds = spark.createDataFrame([(1, 4.0, 6.0), (1, 3.0, 5.5), (None, 1.0, 9.0), (8, 0.0, 0.0)], "date int, lower double, upper double")
    got = sorted(map(str, (tuple(r) for r in models.with_bounds(preds, bounds).collect())))
    assert got == sorted(map(str, [(1, 5.0, 3.0, 6.0), (2, 6.0, None, None), (None, 7.0, 1.0, 9.0)]))


def test_head_strip_round(spark):
    df = spark.createDataFrame([(2, " b\t", 1.005), (1, "a b", 2.344), (3, " \n ", None), (None, None, -1.555)], "k int, s string, x double")
    assert [r["k"] for r in validate.head_sample(df, ["k"], 2).collect()] == [None, 1]
    out = {r["k"]: r for r in validate.rounded_to(validate.stripped(df, ["s"]), ["x"]).collect()}
    assert [out[k]["s"] for k in (2, 1, 3, None)] == ["b", "a b", "", None] and out[1]["x"] == 2.34


def test_hot_day_is_written_by_several_tasks(spark, tmpdir_path):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        df = spark.range(0, 300_000, 1, 8).select(F.lit(D(2024, 1, 7)).alias("date"), F.xxhash64("id").alias("x"))
        files.write_partitioned(df, f"{tmpdir_path}/d")
        files.write_weekly_snapshot(df, f"{tmpdir_path}/w")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for folder in ("d/year=2024/month=01/day=07", "w/year=2024/week=1"):
        assert len([n for n in os.listdir(f"{tmpdir_path}/{folder}") if n.endswith(".parquet")]) > 1
    assert spark.read.parquet(f"{tmpdir_path}/d").count() == spark.read.parquet(f"{tmpdir_path}/w").count() == 300_000
