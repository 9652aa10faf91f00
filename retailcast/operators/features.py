"""Time-series features: lags, rolling statistics, fills, the full feature build.

Lags and rolling windows are *positional* (previous rows of the group in date
order), as in the original workflow.  All lag and rolling columns of one call
are computed from one window column, so Spark plans a single Exchange + Sort +
Window for all of them.

Scale: if a group has more than ``chunk_rows`` rows, each group is cut into chunks of ``chunk_rows``
positions and the last ``history`` rows of every chunk are copied into the
next one; windows then run per (group, chunk).  A long or hot series is spread
over many tasks and the result is exact (no row ever needs history beyond the
copied rows).  ``chunk_rows=None`` keeps a group whole.  Without groups the chunked
path is always used, so an ungrouped window never collapses the frame into one task.
Rows that share a date are numbered by a hash of the row; null dates come last.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailcast.config import LAGS, ROLLING_FUNCTIONS, ROLLING_WINDOWS
from retailcast.operators.ordering import POS, null_safe, row_index

CHUNK_ROWS = 8192  # rows of a series that one window partition holds, about
CHUNK = "__chunk"
CARRY = "__carry"


def cluster_by(df: DataFrame, cols: list[str]) -> DataFrame:
    """Hash-partition by the window keys, so that the windows that follow share one exchange.

    No partition count is pinned: adaptive execution may merge or split partitions.
    """
    return df.repartition(*cols)


def lag_columns(target: str, lags=LAGS) -> dict[str, callable]:
    return {f"{target}_lag_{k}": (lambda w, k=k: F.lag(target, k).over(w)) for k in lags}


FRAME = "__frame"


def _frame_column(target: str, rows: int) -> dict[str, callable]:
    """The row's value and the ``rows`` values before it, as one array in order; the structs keep nulls in place."""
    return {FRAME: lambda w: F.collect_list(F.struct(F.col(target).alias("v"))).over(w.rowsBetween(-rows, 0))}


def _from_frame(df: DataFrame, target: str, lags, windows, functions, closed: str) -> DataFrame:
    """Lags and rolling statistics from slices of each row's frame, which is dropped.

    closed='right' includes the current row (original behaviour); 'left' ends one row before.
    """
    unknown = set(functions) - {"mean", "std", "min", "max", "median"}
    if unknown:
        raise ValueError(f"unknown rolling functions {sorted(unknown)}")
    # SQL text: parsed at once, where as many single columns would take longer to build than to run
    held = f"size({FRAME})" if closed == "right" else f"(size({FRAME}) - 1)"  # rows that may belong to a window
    values = "filter(transform(slice({f}, greatest({h} - {w} + 1, 1), least({h}, {w})), x -> CAST(x.v AS DOUBLE)), x -> x IS NOT NULL) AS __v{w}"
    out = df.selectExpr("*", *[f"get({FRAME}, size({FRAME}) - 1 - {k}).v AS `{target}_lag_{k}`" for k in lags],
                        *[values.format(f=FRAME, h=held, w=w) for w in windows]).drop(FRAME)
    out = out.selectExpr("*", *[f"try_divide(aggregate(__v{w}, 0D, (s, x) -> s + x), size(__v{w})) AS __m{w}" for w in windows],
                         *[f"sort_array(__v{w}) AS __s{w}" for w in windows])
    kind = df.schema[target].dataType.simpleString()
    text = {"mean": "__m{w}",
            "std": "CASE WHEN size(__v{w}) > 1 THEN sqrt(aggregate(__v{w}, 0D, (s, x) -> s + (x - __m{w}) * (x - __m{w})) / (size(__v{w}) - 1)) END",
            "min": f"CAST(get(__s{{w}}, 0) AS {kind})", "max": f"CAST(get(__s{{w}}, size(__s{{w}}) - 1) AS {kind})",
            "median": "(get(__s{w}, (size(__s{w}) - 1) DIV 2) + get(__s{w}, size(__s{w}) DIV 2)) / 2"}
    wanted = [f"{text[f].format(w=w)} AS `{target}_rolling_{w}_{f}`" for w in windows for f in dict.fromkeys(functions)]
    return out.selectExpr("*", *wanted).drop(*[f"__{k}{w}" for k in "vms" for w in windows])


def _history(lags, windows, closed) -> int:
    h = max([0, *lags])
    return max(h, max(windows) - (1 if closed == "right" else 0)) if windows else h


def largest_group(df: DataFrame, group_cols: list[str]) -> int:
    return df.groupBy(*group_cols).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0


def apply_windows(df: DataFrame, columns: dict[str, callable], group_cols: list[str] | None,
                  order_col: str = "date", history: int = 30, chunk_rows: int | None = CHUNK_ROWS) -> DataFrame:
    """Add window columns (name -> fn(window_spec) -> Column) in one window pass.

    The frame is written once and its groups are counted: if one has more than ``chunk_rows`` rows, all are cut into
    chunks, else each is one window partition.  Both ways give the same rows.
    """
    group_cols = list(group_cols or [])
    if group_cols and chunk_rows:
        df = materialize(df)
        if largest_group(df, group_cols) <= chunk_rows:
            chunk_rows = None
    if group_cols and not chunk_rows:
        spec = Window.partitionBy(*group_cols).orderBy(F.col(order_col).asc_nulls_last())
        return cluster_by(df, group_cols).withColumns({n: f(spec) for n, f in columns.items()})
    chunk_rows = max(int(chunk_rows or 4096), history + 1)
    idx = row_index(df, [order_col], group_cols)
    chunk = F.floor(F.col(POS) / chunk_rows)
    # a row goes to its own chunk, and one of a chunk's last rows to the next chunk too
    own, next_ = F.struct(chunk.alias("c"), F.lit(False).alias("k")), F.struct((chunk + 1).alias("c"), F.lit(True).alias("k"))
    places = F.when(F.col(POS) % chunk_rows >= chunk_rows - history, F.array(own, next_)).otherwise(F.array(own))
    both = idx.select("*", F.explode(places).alias("__place")).select("*", F.col("__place.c").alias(CHUNK), F.col("__place.k").alias(CARRY))
    both = cluster_by(both.drop("__place"), group_cols + [CHUNK])
    spec = Window.partitionBy(*group_cols, CHUNK).orderBy(POS)
    out = both.withColumns({n: f(spec) for n, f in columns.items()})
    return out.where(~F.col(CARRY)).drop(CHUNK, CARRY, POS)


def lag_features(df: DataFrame, target: str, group_cols: list[str] | None = None,
                 order_col: str = "date", lags=LAGS, chunk_rows: int | None = CHUNK_ROWS) -> DataFrame:
    return apply_windows(df, lag_columns(target, lags), group_cols, order_col,
                         history=max(lags), chunk_rows=chunk_rows)


def rolling_features(df: DataFrame, target: str, group_cols: list[str] | None = None,
                     order_col: str = "date", windows=ROLLING_WINDOWS, functions=ROLLING_FUNCTIONS,
                     closed: str = "right", chunk_rows: int | None = CHUNK_ROWS) -> DataFrame:
    return lag_and_rolling(df, target, group_cols, order_col, (), windows, functions, closed, chunk_rows)


def lag_and_rolling(df: DataFrame, target: str, group_cols: list[str] | None = None,
                    order_col: str = "date", lags=LAGS, windows=ROLLING_WINDOWS,
                    functions=ROLLING_FUNCTIONS, closed: str = "right",
                    chunk_rows: int | None = CHUNK_ROWS) -> DataFrame:
    """All lags and rolling statistics from one window column: the values of the last rows as an array."""
    history = _history(lags, windows, closed)
    framed = apply_windows(df, _frame_column(target, history), group_cols, order_col, history=history, chunk_rows=chunk_rows)
    return _from_frame(framed, target, lags, windows, functions, closed)


def scalar_row(df: DataFrame, aggs: list[Column]):
    """Global aggregates as one scalar subquery; returns ``i -> Column`` for the i-th value.

    The values travel as one double array: every reference is then the same
    subquery plan, which Spark evaluates once and reuses (a struct would be
    pruned per field into separate subqueries).  Nothing is collected.
    """
    arr = df.select(F.array(*[a.cast("double") for a in aggs])).scalar()
    return lambda i: F.element_at(arr, i + 1)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet into the folder of ``spark.checkpoint.dir`` and read it back.

    One pass, unlike a checkpoint of an unpersisted frame, which computes its last stage once to count it and
    once to save it.  Later readers load only the columns they use, Spark knows the size of the table,
    and a lost executor never forces recomputation of the upstream plan.  (Callers write
    frames that are small by construction - store-day grain - or narrow them first.)
    """
    from retailcast.session import ensure_checkpoint_dir

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/frames/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns by schema (booleans are not numeric)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _is_sequence_col(name: str) -> bool:
    return "lag" in name or "rolling" in name


def fill_missing(df: DataFrame, group_cols: list[str] | None = None, order_col: str = "date",
                 compat: bool = False, exclude: tuple = (), chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Fill nulls: lag/rolling columns forward then backward, other numeric columns by mean.

    Default: forward/backward fill inside each group.  ``compat=True``
    reproduces a fill over the whole frame sorted by (group, date), which lets
    a group's leading nulls take the previous group's last value:
    (1) fill inside the group; (2) each group's last non-null value, one row
    per group, is carried over the groups in key order; (3) the nulls left
    lead the whole frame and take its first non-null value.
    Without groups the frame must hold one row per ``order_col`` value and is
    filled the same way with the date as the group.

    Mean-filled columns come out as double.  Means are global; they come back
    as one scalar subquery, never a collect.
    """
    group_cols = list(group_cols or [])
    seq_cols = [c for c in numeric_columns(df) if _is_sequence_col(c) and c not in exclude]
    mean_cols = [c for c in numeric_columns(df)
                 if not _is_sequence_col(c) and c not in exclude and c not in group_cols]
    out = df
    if seq_cols and group_cols:
        out = _fill_groups(out, seq_cols, group_cols, order_col, chunk_rows, backward=not compat)
        if compat:
            out = _compat_carry(out, df, seq_cols, group_cols, order_col)
    elif seq_cols:
        out = _compat_carry(out, df, seq_cols, [order_col], order_col)
    if mean_cols:
        means = scalar_row(df, [F.avg(c) for c in mean_cols])
        out = out.withColumns({c: F.coalesce(F.col(c).cast("double"), means(i))
                               for i, c in enumerate(mean_cols)})
    return out


def _fill_groups(df: DataFrame, cols: list[str], group_cols: list[str], order_col: str, chunk_rows: int,
                 backward: bool) -> DataFrame:
    """Forward fill inside each group, then (``backward``) its leading nulls from its first value: in one window per group
    where the largest fits ``chunk_rows``, else chunk by chunk."""
    if largest_group(df, group_cols) > chunk_rows:
        return _fill_chunks(df, cols, group_cols, order_col, chunk_rows, backward)
    ties = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    w = Window.partitionBy(*group_cols).orderBy(F.col(order_col).asc_nulls_last(), F.xxhash64(*ties))
    past, whole = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = lambda c: [F.first(c, ignorenulls=True).over(whole)] if backward else []
    return cluster_by(df, group_cols).withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(past), *first(c)) for c in cols})


def _fill_chunks(df: DataFrame, cols: list[str], group_cols: list[str], order_col: str, chunk_rows: int,
                 backward: bool) -> DataFrame:
    """Forward fill inside each group, then (``backward``) its leading nulls from its first value.

    A group is cut into chunks.  A chunk is filled by itself; what is null at its start takes the last
    value of the chunks before it, from a frame of one row per chunk.
    """
    idx = row_index(df, [order_col], group_cols).withColumn(CHUNK, F.floor(F.col(POS) / chunk_rows))
    keys = group_cols + [CHUNK]
    ff = Window.partitionBy(*keys).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    # one struct per chunk and column: its first and last value that is not null
    ends = idx.groupBy(*keys).agg(*[
        F.struct(F.min_by(c, F.when(F.col(c).isNotNull(), F.col(POS))).alias("first"),
                 F.max_by(c, F.when(F.col(c).isNotNull(), F.col(POS))).alias("last")).alias(c) for c in cols])
    w = Window.partitionBy(*group_cols).orderBy(CHUNK)
    past, whole = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = {c: F.last(F.col(c)["last"], ignorenulls=True).over(past) for c in cols}
    if backward:
        carry = {c: F.coalesce(v, F.first(F.col(c)["first"], ignorenulls=True).over(whole)) for c, v in carry.items()}
    carry = ends.select(*keys, *[v.alias(f"__carry_{c}") for c, v in carry.items()])
    filled = cluster_by(idx, keys).withColumns({c: F.last(c, ignorenulls=True).over(ff) for c in cols})
    return (null_safe(filled, carry, keys, "left").withColumns({c: F.coalesce(c, f"__carry_{c}") for c in cols})
            .drop(POS, CHUNK, *[f"__carry_{c}" for c in cols]))


def _compat_carry(filled: DataFrame, raw: DataFrame, cols: list[str], group_cols: list[str],
                  order_col: str) -> DataFrame:
    """Nulls that lead a group take the last value of the groups before it in key order, those that lead the whole frame its
    first value.  Both come from one frame of one row per group, written once."""
    at = lambda c: F.when(F.col(c).isNotNull(), F.col(order_col))
    ends = raw.groupBy(*group_cols).agg(
        F.array(*[F.max_by(F.col(c).cast("double"), at(c)) for c in cols]).alias("__last"),
        F.array(*[F.min_by(F.col(c).cast("double"), at(c)) for c in cols]).alias("__first"))
    w = Window.orderBy(*group_cols)  # one row per group
    past, whole = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = materialize(materialize(ends).select(*group_cols, F.array(*[
        F.coalesce(F.last(F.col("__last")[i], ignorenulls=True).over(past), F.first(F.col("__first")[i], ignorenulls=True).over(whole))
        for i in range(len(cols))]).alias("__carry")))
    kinds = dict(filled.dtypes)
    return (null_safe(filled, carry, group_cols, "left")
            .withColumns({c: F.coalesce(F.col(c), F.col("__carry")[i].cast(kinds[c])) for i, c in enumerate(cols)}).drop("__carry"))


DERIVED_FROM_DATE = ("year", "month", "day", "day_of_week", "quarter", "week_of_year", "is_weekend",
                     "is_holiday", "month_sin", "month_cos", "day_sin", "day_cos",
                     "day_of_week_sin", "day_of_week_cos")


def create_all_features(df: DataFrame, target: str = "sales", date_col: str = "date",
                        group_cols: list[str] | None = None, categorical_cols: list[str] | None = None,
                        compat_fill: bool = False, closed: str = "right",
                        chunk_rows: int | None = CHUNK_ROWS, lags=LAGS, windows=ROLLING_WINDOWS,
                        functions=ROLLING_FUNCTIONS, checkpoint: bool = False) -> DataFrame:
    """Date parts -> lags -> rolling -> cyclical -> interactions -> fill.

    One lazy plan unless ``checkpoint``: then the windowed frame is written to
    the shared checkpoint folder once, because the fill reads it up to three
    times (rows, per-group ends, means).
    """
    from retailcast.functions.calendar import cyclical_features, date_parts, interaction_features

    out = date_parts(df, date_col)
    out = lag_and_rolling(out, target, group_cols, date_col, lags, windows, functions, closed, chunk_rows)
    out = cyclical_features(out, date_col)
    if categorical_cols:
        out = interaction_features(out, categorical_cols)
    if checkpoint:
        out = materialize(out)  # readers of several results write the filled frame too
    return fill_missing(out, group_cols, date_col, compat=compat_fill, exclude=DERIVED_FROM_DATE,
                        chunk_rows=chunk_rows or CHUNK_ROWS)
