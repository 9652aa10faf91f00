"""Run ledger kept as append-only parquet tables (runs, params, metrics, stages) and version logs.

Tables live under one root on shared storage.  Nothing is ever rewritten in
place: a stage change is a new event row and the current stage is the latest
event, so concurrent writers only append.  Versions are put-if-absent files
(see commit_log), so that two writers never hold the same one.
"""

from __future__ import annotations

import datetime as dt
import os
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailcast.sources import commit_log

RUNS = T.StructType([T.StructField("run_id", T.StringType()), T.StructField("run_name", T.StringType()),
                     T.StructField("status", T.StringType()), T.StructField("logged_at", T.TimestampType())])
PARAMS = T.StructType([T.StructField("run_id", T.StringType()), T.StructField("key", T.StringType()),
                       T.StructField("value", T.StringType())])
METRICS = T.StructType([T.StructField("run_id", T.StringType()), T.StructField("key", T.StringType()),
                        T.StructField("value", T.DoubleType())])
VERSIONS = T.StructType([T.StructField("model_name", T.StringType()), T.StructField("version", T.LongType()),
                         T.StructField("run_id", T.StringType()), T.StructField("created_at", T.TimestampType())])
STAGES = T.StructType([T.StructField("model_name", T.StringType()), T.StructField("version", T.LongType()),
                       T.StructField("stage", T.StringType()), T.StructField("changed_at", T.TimestampType())])
_SCHEMAS = {"runs": RUNS, "run_params": PARAMS, "run_metrics": METRICS, "model_versions": VERSIONS,
            "version_stages": STAGES}


def _path(root: str, table: str) -> str:
    return os.path.join(root, table)


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A ledger table; empty (with its schema) when nothing was logged yet."""
    schema = _SCHEMAS[table]
    try:
        return spark.read.schema(schema).parquet(_path(root, table))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # anything else is no empty ledger
            raise
        return spark.createDataFrame([], schema)


def _append(df: DataFrame, root: str, table: str) -> None:
    df.select(*[f.name for f in _SCHEMAS[table].fields]).write.mode("append").parquet(_path(root, table))


def log_run(spark: SparkSession, root: str, run_id: str, params: dict, metrics: DataFrame | None = None,
            status: str = "FINISHED", run_name: str | None = None) -> None:
    """Append a run, its params and its metrics.

    ``metrics`` is a (key, value) DataFrame - e.g. ``model || '_' || metric`` -
    written straight from the executors, never collected.
    """
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    _append(spark.createDataFrame([(run_id, run_name or run_id, status, now)], RUNS), root, "runs")
    if params:
        _append(spark.createDataFrame([(run_id, str(k), str(v)) for k, v in params.items()], PARAMS),
                root, "run_params")
    if metrics is not None:
        _append(metrics.select(F.lit(run_id).alias("run_id"), F.col("key").cast("string"),
                               F.col("value").cast("double")), root, "run_metrics")


def metrics_as_keys(long: DataFrame) -> DataFrame:
    """(model, metric, value) -> (key = model_metric, value)."""
    return long.select(F.concat_ws("_", "model", "metric").alias("key"), "value")


def split_metric_key(df: DataFrame, key_col: str = "key",
                     metrics=("rmse", "mae", "mape", "r2")) -> DataFrame:
    """Split ``model_metric`` keys back into (model, metric); other keys give nulls."""
    pattern = r"^(.+)_(" + "|".join(metrics) + r")$"
    return df.withColumns({"model": F.nullif(F.regexp_extract(key_col, pattern, 1), F.lit("")),
                           "metric": F.nullif(F.regexp_extract(key_col, pattern, 2), F.lit(""))})


def run_view(spark: SparkSession, root: str, keys: list[str]) -> DataFrame:
    """One row per run: metrics pivoted to columns named by ``keys`` (the pivot values are given,
    so Spark does not run a distinct job to discover them)."""
    m = read(spark, root, "run_metrics")
    return m.groupBy("run_id").pivot("key", keys).agg(F.max("value"))


def best_run(spark: SparkSession, root: str, key: str, ascending: bool = True) -> DataFrame:
    """The run with the lowest (or highest) value of metric ``key``: a top-1, not a sort."""
    m = read(spark, root, "run_metrics").where(F.col("key") == key)
    order = F.col("value").asc_nulls_last() if ascending else F.col("value").desc_nulls_last()
    return m.orderBy(order, "run_id").limit(1)


def _claims(root: str, model_name: str) -> str:
    """Folder of a model's version log; any name is a valid folder name."""
    return f"{_path(root, 'model_versions')}/model={quote(model_name, safe='')}"


def register_version(spark: SparkSession, root: str, model_name: str, run_id: str) -> DataFrame:
    """Claim the next free version of ``model_name`` and return that row.

    A version is a put-if-absent file: of several writers one gets it, and the others go on to the next, whatever
    their clocks say.
    """
    def content(version: int, _last) -> dict:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        return {"model_name": model_name, "version": version, "run_id": run_id, "created_at": now.isoformat(sep=" ")}

    version = commit_log.commit(spark, _claims(root, model_name), content)["version"]
    return versions(spark, root).where((F.col("model_name") == model_name) & (F.col("version") == version))


def versions(spark: SparkSession, root: str) -> DataFrame:
    """Registered versions of all models, read from their version logs."""
    try:
        return (spark.read.schema(VERSIONS).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
                .json(_path(root, "model_versions")))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # anything else is no empty ledger
            raise
        return spark.createDataFrame([], VERSIONS)


def set_stage(spark: SparkSession, root: str, model_name: str, version: int, stage: str) -> None:
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    _append(spark.createDataFrame([(model_name, int(version), stage, now)], STAGES), root, "version_stages")


def current_versions(spark: SparkSession, root: str) -> DataFrame:
    """Every version with its latest stage ('None' when never staged)."""
    ev = read(spark, root, "version_stages")
    last = ev.groupBy("model_name", "version").agg(F.max_by("stage", "changed_at").alias("stage"))
    return (versions(spark, root).join(last, ["model_name", "version"], "left")
            .withColumn("stage", F.coalesce("stage", F.lit("None"))))


def latest_version(spark: SparkSession, root: str, model_name: str, stage: str | None = None,
                   fallback_key: str | None = None) -> DataFrame:
    """Highest version of a model (optionally in a stage); when there is none, the best run
    by ``fallback_key`` supplies the run id (version null)."""
    v = current_versions(spark, root).where(F.col("model_name") == model_name)
    if stage:
        v = v.where(F.col("stage") == stage)
    top = v.agg(F.max_by(F.struct("version", "run_id", "stage"), "version").alias("v"))
    out = top.select(F.lit(model_name).alias("model_name"), F.col("v.version").alias("version"),
                     F.col("v.run_id").alias("run_id"), F.col("v.stage").alias("stage"))
    if fallback_key:
        best = best_run(spark, root, fallback_key).select(F.col("run_id").alias("__fb")).select(
            F.max("__fb")).scalar()
        out = out.withColumn("run_id", F.coalesce("run_id", best))
    return out


def best_model(long: DataFrame, metric: str = "rmse") -> DataFrame:
    """The model with the smallest ``metric`` among current results (ties -> first name)."""
    m = long.where(F.col("metric") == metric)
    w = Window.orderBy(F.col("value").asc_nulls_last(), "model")
    return m.withColumn("__r", F.row_number().over(w)).where("__r = 1") \
            .select(F.col("model").alias("best_model"), F.col("value").alias(metric))
