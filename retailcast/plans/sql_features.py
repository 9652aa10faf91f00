"""SQL text for the feature queries, generated from the same parameter lists."""

from __future__ import annotations

from retailcast.config import LAGS, ROLLING_FUNCTIONS, ROLLING_WINDOWS
from retailcast.plans.registry import rnd

TWO_PI = "6.283185307179586"
_SQL_FUNC = {"mean": "avg({t})", "std": "stddev_samp({t})", "min": "min({t})", "max": "max({t})",
             "median": "quantile_cont({t}, 0.5)"}


def lag_exprs(target: str, part: str = "store_id", order: str = "date", lags=LAGS) -> dict[str, str]:
    return {f"{target}_lag_{k}": f"lag({target}, {k}) OVER (PARTITION BY {part} ORDER BY {order})"
            for k in lags}


def rolling_exprs(target: str, part: str = "store_id", order: str = "date", windows=ROLLING_WINDOWS,
                  functions=ROLLING_FUNCTIONS) -> dict[str, str]:
    out = {}
    for w in windows:
        for f in dict.fromkeys(functions):
            out[f"{target}_rolling_{w}_{f}"] = (
                f"{_SQL_FUNC[f].format(t=target)} OVER (PARTITION BY {part} ORDER BY {order} "
                f"ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)")
    return out


DATE_PART_SQL = {
    "year": "CAST(year(date) AS INTEGER)",
    "month": "CAST(month(date) AS INTEGER)",
    "day": "CAST(day(date) AS INTEGER)",
    "day_of_week": "CAST(isodow(date) - 1 AS INTEGER)",
    "quarter": "CAST(quarter(date) AS INTEGER)",
    "week_of_year": "CAST(weekofyear(date) AS INTEGER)",
    "is_weekend": "CAST(isodow(date) >= 6 AS TINYINT)",
    "is_holiday": "CAST(CASE WHEN date IN (SELECT date FROM rc_holidays) THEN 1 ELSE 0 END AS TINYINT)",
}

CYCLICAL_SQL = {
    "month_sin": f"sin((month(date) - 1) * {TWO_PI} / 12)",
    "month_cos": f"cos((month(date) - 1) * {TWO_PI} / 12)",
    "day_sin": f"sin(day(date) * {TWO_PI} / 31)",
    "day_cos": f"cos(day(date) * {TWO_PI} / 31)",
    "day_of_week_sin": f"sin((isodow(date) - 1) * {TWO_PI} / 7)",
    "day_of_week_cos": f"cos((isodow(date) - 1) * {TWO_PI} / 7)",
}

BASE_COLS = ["date", "store_id", "sales", "quantity_sold", "profit", "has_promotion", "customer_traffic"]
MEAN_FILL = ["sales", "quantity_sold", "profit", "has_promotion", "customer_traffic"]


def feature_frame_sql(compat: bool = False, rounded: bool = True) -> tuple[str, str]:
    """(extra CTEs, final SELECT) computing the full feature frame with fills."""
    seq = {**lag_exprs("sales"), **rolling_exprs("sales")}
    raw_cols = ",\n  ".join([f"{e} AS {n}" for n, e in DATE_PART_SQL.items()] +
                            [f"{e} AS {n}" for n, e in seq.items()] +
                            [f"{e} AS {n}" for n, e in CYCLICAL_SQL.items()])
    ctes = (f"rc_feat_raw AS (SELECT {', '.join(BASE_COLS)},\n  {raw_cols}\nFROM rc_store_days),\n"
            "rc_feat_means AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in MEAN_FILL) +
            " FROM rc_feat_raw)")
    if compat:
        w_ff = "OVER (ORDER BY store_id, date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        w_bf = "OVER (ORDER BY store_id, date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    else:
        w_ff = "OVER (PARTITION BY store_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        w_bf = "OVER (PARTITION BY store_id ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    r = rnd if rounded else (lambda e, d: e)
    sel = ["date", "store_id"]
    sel += [f"{r(f'coalesce(CAST({c} AS DOUBLE), m_{c})', 3)} AS {c}" for c in MEAN_FILL]
    sel += list(DATE_PART_SQL)
    sel += [f"{r(f'coalesce(last_value({n} IGNORE NULLS) {w_ff}, first_value({n} IGNORE NULLS) {w_bf})', 3)} AS {n}"
            for n in seq]
    sel += [f"{r(n, 6)} AS {n}" for n in CYCLICAL_SQL]
    body = "SELECT " + ",\n  ".join(sel) + "\nFROM rc_feat_raw, rc_feat_means"
    return ctes, body


FEATURE_COLUMNS = (MEAN_FILL[1:] + list(DATE_PART_SQL) + list(lag_exprs("sales")) + list(rolling_exprs("sales"))
                   + list(CYCLICAL_SQL))


def feature_ctes() -> str:
    """CTEs ending in rc_features: the unrounded, filled feature frame."""
    ctes, body = feature_frame_sql(False, rounded=False)
    return f"{ctes},\nrc_features AS ({body})"
