"""Calendar functions as native Spark expressions (no Python UDFs).

Holidays are rules evaluated on the date itself (``is_holiday``), so no range of
years bounds them and no join is needed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# US federal holidays.  (name, month, weekday, nth, first year, last year);
# nth = -1 means the last one in the month, -2 the one before it
NTH_WEEKDAY_HOLIDAYS = [
    ("Martin Luther King Jr. Day", 1, "Mon", 3, 1986, None),
    ("Washington's Birthday", 2, "Mon", 3, 1971, None),
    ("Memorial Day", 5, "Mon", -1, 1971, None),
    ("Labor Day", 9, "Mon", 1, 1894, None),
    ("Columbus Day", 10, "Mon", 2, 1971, None),
    ("Veterans Day", 10, "Mon", 4, 1971, 1977),
    ("Thanksgiving", 11, "Thu", -1, 1870, 1938),
    ("Thanksgiving", 11, "Thu", -2, 1939, 1941),
    ("Thanksgiving", 11, "Thu", 4, 1942, None),
]
# (name, month, day, first year, last year); from OBSERVED_SINCE on also observed
# on the Friday before or the Monday after when on a weekend
FIXED_DATE_HOLIDAYS = [
    ("New Year's Day", 1, 1, 1871, None),
    ("Washington's Birthday", 2, 22, 1880, 1970),
    ("Memorial Day", 5, 30, 1888, 1970),
    ("Juneteenth National Independence Day", 6, 19, 2021, None),
    ("Independence Day", 7, 4, 1870, None),
    ("Veterans Day", 11, 11, 1938, 1970),
    ("Veterans Day", 11, 11, 1978, None),
    ("Christmas Day", 12, 25, 1870, None),
]
OBSERVED_SINCE = 1971
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
DOW_FACTORS = [0.9, 0.85, 0.85, 0.9, 1.1, 1.3, 1.2]  # Monday .. Sunday
# -----------------------------------------------------------------------------

_TWO_PI = 2.0 * math.pi


def weekday0(d: Column) -> Column:
    """Day of week with Monday = 0 .. Sunday = 6."""
    return F.weekday(d)


def date_parts(df: DataFrame, date_col: str = "date", parts=None, holidays: bool = True) -> DataFrame:
    """Add calendar parts named in ``parts`` (default: all of them).

    day_of_week is 0-6 with Monday = 0; week_of_year is the ISO week; is_weekend
    and is_holiday are 0/1 tinyint flags.
    """
    from retailcast.config import DATE_PARTS

    wanted = list(parts or DATE_PARTS)
    d = F.col(date_col)
    exprs = {
        "year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d),
        "day_of_week": weekday0(d), "quarter": F.quarter(d), "week_of_year": F.weekofyear(d),
        "is_weekend": (weekday0(d) >= 5).cast("tinyint"),
    }
    out = df.withColumns({p: exprs[p] for p in wanted if p in exprs})
    if holidays and "is_holiday" in wanted:
        out = holiday_flag(out, date_col, "is_holiday")
    return out


def cyclical_features(df: DataFrame, date_col: str = "date") -> DataFrame:
    """sin/cos encodings of month (0-11), day of month (1-31) and weekday (0-6)."""
    d = F.col(date_col)
    m = (F.month(d) - 1) * _TWO_PI / 12
    dm = F.dayofmonth(d) * _TWO_PI / 31
    w = weekday0(d) * _TWO_PI / 7
    return df.withColumns({
        "month_sin": F.sin(m), "month_cos": F.cos(m),
        "day_sin": F.sin(dm), "day_cos": F.cos(dm),
        "day_of_week_sin": F.sin(w), "day_of_week_cos": F.cos(w),
    })


def _nth_weekday(year: Column, month: int, dow: str, nth: int) -> Column:
    first = F.make_date(year, F.lit(month), F.lit(1))
    return F.date_add(F.next_day(F.date_sub(first, 1), dow), 7 * (nth - 1))


def _in_years(year: str, since: int, until: int | None) -> str:
    return f"{year} >= {since}" if until is None else f"{year} BETWEEN {since} AND {until}"


def _fixed_date(d: str) -> str:
    """Is the date itself a holiday with a fixed month and day (observed dates left out)?"""
    return "(" + " OR ".join(f"(month({d}) = {month} AND day({d}) = {day} AND {_in_years(f'year({d})', since, until)})"
                             for _name, month, day, since, until in FIXED_DATE_HOLIDAYS) + ")"


def is_holiday(d: str) -> Column:
    """Is the date a US federal holiday, actual or observed?  Null dates give null.

    ``d`` is the SQL text of a date.  The rules are parsed as one text: built of single columns they
    take longer to put together than many a query to run.
    """
    left, rules = f"day(last_day({d})) - day({d})", [_fixed_date(d)]
    for _name, month, dow, nth, since, until in NTH_WEEKDAY_HOLIDAYS:
        # the nth such weekday lies in days 7n-6 .. 7n, counted from the month's end if n < 0
        place = f"day({d}) BETWEEN {7 * nth - 6} AND {7 * nth}" if nth > 0 else f"{left} BETWEEN {-7 * nth - 7} AND {-7 * nth - 1}"
        rules.append(f"(month({d}) = {month} AND weekday({d}) = {WEEKDAYS.index(dow)} AND {place} AND {_in_years(f'year({d})', since, until)})")
    next_, before = f"date_add({d}, 1)", f"date_sub({d}, 1)"
    rules.append(f"(year({next_}) >= {OBSERVED_SINCE} AND ((weekday({d}) = 4 AND {_fixed_date(next_)}) OR (weekday({d}) = 0 AND {_fixed_date(before)})))")
    return F.expr(" OR ".join(rules))


def holiday_dimension(spark: SparkSession, years: tuple[int, int]) -> DataFrame:
    """Every US federal holiday of the given years, actual and observed dates: one column ``date``."""
    first, last = (F.make_date(F.lit(y), F.lit(m), F.lit(d)) for y, m, d in ((years[0], 1, 1), (years[1], 12, 31)))
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("date"))
    return days.where(is_holiday("date"))


def holiday_flag(df: DataFrame, date_col: str = "date", out_col: str = "is_holiday") -> DataFrame:
    """Add a 0/1 tinyint flag: is ``date_col`` a holiday (actual or observed)?  Null dates get 0."""
    d = f"CAST(`{date_col}` AS DATE)"
    return df.withColumn(out_col, F.coalesce(is_holiday(d), F.lit(False)).cast("tinyint"))


def day_of_week_factor(d: Column) -> Column:
    """Demand multiplier by weekday (Monday first)."""
    return F.element_at(F.array(*[F.lit(x) for x in DOW_FACTORS]), weekday0(d) + 1)


def seasonality_factor(d: Column, kind: Column, is_holiday: Column) -> Column:
    """Demand multiplier by seasonality type and date.

    holiday: Nov-Dec sinusoid peak, 1.3 on holidays, else 1; summer, winter and
    spring: yearly sinusoids; back_to_school: 1.4 in Aug-Sep else 0.9; fitness:
    1.5 in Jan, 1.3 in May-Jun, else 1; anything else 1.
    """
    doy = F.dayofyear(d).cast("double")
    m = F.month(d)
    return (F.when(kind == "holiday",
                   F.when(m.isin(11, 12), 1.5 + 0.3 * F.sin(_TWO_PI * (doy - 300) / 60))
                    .when(is_holiday.cast("boolean"), F.lit(1.3)).otherwise(F.lit(1.0)))
             .when(kind == "summer", 1.0 + 0.4 * F.sin(_TWO_PI * (doy - 80) / 365))
             .when(kind == "winter", 1.0 + 0.3 * F.sin(_TWO_PI * (doy + 90) / 365))
             .when(kind == "back_to_school", F.when(m.isin(8, 9), F.lit(1.4)).otherwise(F.lit(0.9)))
             .when(kind == "fitness", F.when(m == 1, F.lit(1.5)).when(m.isin(5, 6), F.lit(1.3))
                   .otherwise(F.lit(1.0)))
             .when(kind == "spring", 1.0 + 0.3 * F.sin(_TWO_PI * (doy - 20) / 365))
             .otherwise(F.lit(1.0)))


def clamp(c: Column, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), c))


def expected_traffic(base: Column, dow_factor: Column, is_holiday: Column,
                     weather: Column, event_impact: Column) -> Column:
    """base x weekday x holiday(1.3) x weather(clamped 0.5-1.2) x (1 + event impact), truncated."""
    hol = F.when(is_holiday.cast("boolean"), F.lit(1.3)).otherwise(F.lit(1.0))
    return (base * dow_factor * hol * clamp(weather, 0.5, 1.2) * (1 + event_impact)).cast("long")


# --- fixed values -----------------------------------------------------------
SIZE_FACTORS = {"large": 1.0, "medium": 0.7, "small": 0.5}
CONVERSION_RATE = 0.001
PROMOTION_LIFT = 3.0
# -----------------------------------------------------------------------------


def expected_quantity(traffic: Column, size: Column, price: Column, seasonality: Column,
                      discount: Column, noise: Column | None = None) -> Column:
    """traffic x 0.001 x size x 1/(1+price/100) x seasonality x (1+3 discount), truncated, >= 0."""
    size_f = F.coalesce(*[F.when(size == k, F.lit(v)) for k, v in SIZE_FACTORS.items()], F.lit(None))
    base = traffic * CONVERSION_RATE * size_f * (1.0 / (1.0 + price / 100.0))
    q = base * seasonality * (1 + discount * PROMOTION_LIFT)
    if noise is not None:
        q = q * noise
    return F.greatest(F.lit(0).cast("long"), q.cast("long"))


def sales_economics(df: DataFrame, price: str = "price", discount: str = "discount_percent",
                    quantity: str = "quantity_sold", margin: str = "margin") -> DataFrame:
    """actual price, revenue, cost and profit of a (price, discount, quantity, margin) row."""
    actual = F.col(price) * (1 - F.col(discount))
    revenue = F.col(quantity) * actual
    cost = F.col(quantity) * F.col(price) * (1 - F.col(margin))
    return df.withColumns({"actual_price": actual, "revenue": revenue, "cost": cost,
                           "profit": revenue - cost})


def days_of_supply(inventory: Column, quantity: Column) -> Column:
    return inventory / F.greatest(F.lit(1), quantity)


def expand_events(events: DataFrame, start_col: str = "start_date", duration_col: str = "duration",
                  lo: Column | None = None, hi: Column | None = None) -> DataFrame:
    """One row per day of each event (start .. start+duration-1), clipped to [lo, hi]."""
    days = F.sequence(F.col(start_col), F.date_add(F.col(start_col), F.col(duration_col) - 1))
    out = events.withColumn("date", F.explode(days))
    if lo is not None:
        out = out.where(F.col("date") >= lo)
    if hi is not None:
        out = out.where(F.col("date") <= hi)
    return out


def interaction_features(df: DataFrame, categorical_cols: list[str]) -> DataFrame:
    """``a_b_interaction`` = str(a) || '_' || str(b) for every pair; null if either is null."""
    cols = {}
    for i, a in enumerate(categorical_cols):
        for b in categorical_cols[i + 1:]:
            cols[f"{a}_{b}_interaction"] = F.concat(F.col(a).cast("string"), F.lit("_"),
                                                    F.col(b).cast("string"))
    return df.withColumns(cols) if cols else df


def iso_format(c: Column, fmt: str = "yyyy-MM-dd") -> Column:
    return F.date_format(c, fmt)


# --- fixed values: promotional events (name, month, day, days, discount) -----
# Black Friday starts the day after the fourth Thursday of November; the other
# events start on the given month and day (Cyber Monday therefore on 4 November,
# as in the original calendar).
PROMOTION_EVENTS = [
    ("Black Friday", 11, 4, 5, 0.25),
    ("Cyber Monday", 11, 4, 2, 0.20),
    ("Christmas Sale", 12, 15, 10, 0.15),
    ("New Year Sale", 1, 1, 7, 0.20),
    ("Presidents Day", 2, 15, 3, 0.15),
    ("Memorial Day", 5, 25, 3, 0.15),
    ("July 4th Sale", 7, 1, 5, 0.15),
    ("Labor Day", 9, 1, 3, 0.15),
    ("Back to School", 8, 1, 14, 0.10),
]
# -----------------------------------------------------------------------------


def promotion_calendar(spark: SparkSession, start: Column, end: Column) -> DataFrame:
    """Promotion days (date, promotion_type, discount_percent) for events starting in [start, end].

    Years come from ``sequence(year(start), year(end))``; each event expands to
    its duration, days after ``end`` are dropped.
    """
    years = spark.range(1).select(F.explode(F.sequence(F.year(start), F.year(end))).alias("y"))
    ev = F.array(*[F.struct(F.lit(n).alias("promotion_type"),
                            (_nth_weekday(F.col("y"), 11, "Thu", 4) + 1 if n == "Black Friday"
                             else F.make_date(F.col("y"), F.lit(m), F.lit(d))).alias("start_date"),
                            F.lit(dur).alias("duration"), F.lit(disc).alias("discount_percent"))
                   for n, m, d, dur, disc in PROMOTION_EVENTS])
    e = years.select(F.explode(ev).alias("e")).select("e.*")
    e = e.where((F.col("start_date") >= start) & (F.col("start_date") <= end))
    days = expand_events(e, "start_date", "duration", hi=end)
    return days.select("date", "promotion_type", "discount_percent")


def store_calendar(df: DataFrame, group_col: str = "store_id", date_col: str = "date") -> DataFrame:
    """Every day from each group's first to last date (a generator per group, no cross join)."""
    span = df.groupBy(group_col).agg(F.min(date_col).alias("__d0"), F.max(date_col).alias("__d1"))
    return span.select(group_col, F.explode(F.sequence("__d0", "__d1")).alias(date_col))


def densify(df: DataFrame, group_col: str = "store_id", date_col: str = "date") -> DataFrame:
    """Left-join the frame onto its per-group daily calendar; ``observed`` flags real rows."""
    cal = store_calendar(df, group_col, date_col)
    return cal.join(df.withColumn("observed", F.lit(True)), [group_col, date_col], "left") \
              .withColumn("observed", F.coalesce("observed", F.lit(False)))
