"""Data validation: file checks, required columns, type and value contracts, issue summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailcast.config import REQUIRED_COLUMNS, VALUE_RANGES
from retailcast.sources.files import norm_path
from retailcast.sources.footers import read_footers

_ISSUE = T.StructType([T.StructField("issue", T.StringType()), T.StructField("detail", T.StringType())])


def missing_columns(spark: SparkSession, df: DataFrame, required=REQUIRED_COLUMNS) -> DataFrame:
    """Required column names absent from ``df`` (schema metadata only, no data read)."""
    missing = [c for c in required if c not in df.columns]
    return spark.createDataFrame([("missing_column", c) for c in missing], _ISSUE)


def type_contract(spark: SparkSession, df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """Columns whose Spark type differs from the contract (e.g. {'sales': 'double'})."""
    actual = dict(df.dtypes)
    rows = [("type_mismatch", f"{c}: expected {t}, found {actual.get(c)}")
            for c, t in contract.items() if actual.get(c) != t]
    return spark.createDataFrame(rows, _ISSUE)


def cast_failures(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """Per column: non-null values that do not cast to the contract type (one pass)."""
    aggs = [F.count_if(F.col(c).isNotNull() & F.expr(f"try_cast(`{c}` AS {t})").isNull()).alias(c)
            for c, t in contract.items()]
    return df.agg(*aggs).unpivot([], list(contract), "column", "failed")


def value_checks(df: DataFrame, checks: dict[str, F.Column], dataset: str) -> DataFrame:
    """Rows failing each named predicate; one aggregation: (dataset, check, n_rows, n_failed)."""
    aggs = [F.count_if(pred).alias(name) for name, pred in checks.items()]
    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *aggs)
    return (wide.unpivot(["__rows"], list(checks), "check", "n_failed")
                .select(F.lit(dataset).alias("dataset"), "check", F.col("__rows").alias("n_rows"), "n_failed"))


def range_checks(ranges=VALUE_RANGES) -> dict[str, F.Column]:
    return {f"{c}_out_of_range": ~F.col(c).between(lo, hi) for c, (lo, hi) in ranges.items()}


def per_file_checks(df: DataFrame, quantity: str = "quantity_sold", revenue: str = "revenue",
                    listed: DataFrame | None = None) -> DataFrame:
    """Per source file: rows, min quantity / revenue and negative counts.

    ``df`` reads the files directly.  A file of ``listed`` (column ``path``) that gave no row is
    returned with 0 rows.
    """
    per = _per_file(df, quantity, revenue)
    if listed is None:
        return per
    names = listed.select(norm_path("path").alias("file")).distinct()
    rows = per.withColumn("file", norm_path("file"))
    return names.join(rows, "file", "left").fillna(0, ["rows", "negative_quantity", "negative_revenue"])


def _per_file(df: DataFrame, quantity: str, revenue: str) -> DataFrame:
    return df.groupBy(F.input_file_name().alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(quantity).alias("min_quantity"), F.min(revenue).alias("min_revenue"),
        F.count_if(F.col(quantity) < 0).alias("negative_quantity"),
        F.count_if(F.col(revenue) < 0).alias("negative_revenue"))


def file_checks(spark: SparkSession, expected: DataFrame, root: str, schema: T.StructType | None = None) -> DataFrame:
    """(issue, detail): why an expected or listed file is bad (missing file, zero bytes, damaged footer, no rows), and
    its path.  ``expected`` has a ``path`` column.  Only footers are read."""
    return (read_footers(spark, root, expected=expected, schema=schema).where("problem is not null")
            .select(F.col("problem").alias("issue"), F.col("path").alias("detail")))


def issue_summary(issues: DataFrame, first_n: int = 10) -> DataFrame:
    """Total issue count and the first ``first_n`` issues (by text), as one row.

    The first issues come from a top-k (``orderBy().limit()``), never a full collect.
    """
    total = issues.select(F.count(F.lit(1))).scalar()
    head = issues.orderBy("issue", "detail").limit(first_n)
    return head.agg(F.collect_list(F.concat_ws(": ", "issue", "detail")).alias("first_issues")) \
               .select(total.alias("num_issues_found"), "first_issues")


def head_sample(df: DataFrame, order_cols: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in the order of ``order_cols`` (nulls first): a top-k, not a sort of all rows."""
    return df.orderBy(*order_cols).limit(n)


def stripped(df: DataFrame, cols: list[str]) -> DataFrame:
    """``cols`` without white space at both ends; a text of white space only becomes empty."""
    return df.withColumns({c: F.regexp_replace(c, r"^\s+|\s+$", "") for c in cols})


def rounded_to(df: DataFrame, cols: list[str], digits: int = 2) -> DataFrame:
    """``cols`` rounded half away from zero."""
    return df.withColumns({c: F.round(c, digits) for c in cols})


def data_summary(facts: DataFrame, issues: DataFrame, first_n: int = 10) -> DataFrame:
    """One row for a report: files validated, rows and bad files from footers, issues found and the first of them."""
    files = facts.agg(F.count("*").alias("files_validated"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total_rows"),
                      F.count("problem").alias("bad_files"))
    found = issue_summary(issues, first_n)
    return files.crossJoin(F.broadcast(found)).select(  # one row each
        "files_validated", "total_rows", "bad_files", F.col("num_issues_found").alias("issues_found"), F.col("first_issues").alias("issues"))


def missing_items(expected: DataFrame, found: DataFrame, name_col: str = "name", key_col: str = "key") -> DataFrame:
    """Expected names that no found key contains (substring match); null names are none."""
    from retailcast.operators.completeness import found_items

    items = found_items(expected.select(F.col(name_col).alias("name")), found.select(F.col(key_col).alias("key")))
    missing = items.where(~F.col("found")).select(F.col("name").alias(name_col))
    return expected.join(missing, name_col, "left_semi")
