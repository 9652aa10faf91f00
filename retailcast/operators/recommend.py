"""Recommendations: a table of rules joined with measured values, one row per rule that fires."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailcast.config import LEAKAGE_CORRELATION, MAX_FEATURES, MIN_TRAIN_ROWS, SHIFT_THRESHOLD, ZERO_TARGET_SHARE

RULE = "check string, comparison string, threshold double, severity string, unit string, text string"
# {value} stands for the measured value, {threshold} for the limit, both in the rule's unit
RULES = [
    ("mean_shift_validation", ">", SHIFT_THRESHOLD, "warning", "percent",
     "The mean of the validation target lies {value} from that of the training rows (limit {threshold}): look for drift before trusting the weights."),
    ("mean_shift_test", ">", SHIFT_THRESHOLD, "warning", "percent",
     "The mean of the test target lies {value} from that of the training rows (limit {threshold}): scores may not carry over."),
    ("n_features", ">", float(MAX_FEATURES), "info", "count",
     "{value} features are used (limit {threshold}): select by importance."),
    ("high_correlation_features", ">", 0.0, "error", "count",
     f"{{value}} features correlate with the target beyond {LEAKAGE_CORRELATION:g}: check that they are known before the sale."),
    ("train_rows", "<", float(MIN_TRAIN_ROWS), "warning", "count",
     "Only {value} training rows (at least {threshold} are wanted): add history or stores."),
    ("zero_target_share", ">", ZERO_TARGET_SHARE, "info", "percent",
     "{value} of the training targets are zero (limit {threshold}): model sales and no sales apart."),
]


def rule_table(spark: SparkSession, rules: list[tuple] | None = None) -> DataFrame:
    """The rules as a table; ``rules`` are tuples in the order of RULE."""
    return spark.createDataFrame(rules if rules is not None else RULES, RULE)


def _shown(value: Column, unit: Column) -> Column:
    return F.when(unit == "percent", F.format_string("%.1f%%", value * 100)).otherwise(F.format_string("%.0f", value))


def recommendations(measured: DataFrame, rules: DataFrame) -> DataFrame:
    """(check, severity, value, threshold, text) of every rule whose comparison (>, >=, <, <=) holds for its measured value.

    ``measured`` has check and value.  A check measured several times fires for each value; a null value, an unknown
    check and an unknown comparison fire nothing.
    """
    value, limit, how = F.col("value").cast("double"), F.col("threshold"), F.col("comparison")
    holds = F.when(how == ">", value > limit).when(how == ">=", value >= limit).when(how == "<", value < limit).when(how == "<=", value <= limit)
    text = F.replace(F.replace("text", F.lit("{value}"), _shown(value, F.col("unit"))), F.lit("{threshold}"), _shown(limit, F.col("unit")))
    return (measured.select("check", "value").join(rules, "check").where(holds)
            .select("check", "severity", value.alias("value"), "threshold", text.alias("text")))
