"""DuckDB SQL twins of the registered queries.

The retail inputs are derived from the driver tables by the CTEs below, written
once and shared by every oracle query.  They restate the mapping in
``retailcast.sources.retail`` and the holiday rules in
``retailcast.functions.calendar`` in plain SQL (generated from the same fixed
rule lists).
"""

from __future__ import annotations

from retailcast.functions.calendar import FIXED_DATE_HOLIDAYS, NTH_WEEKDAY_HOLIDAYS, OBSERVED_SINCE
from retailcast.sources.retail import COST_RATIO, PROMOTION_MIN_DISCOUNT

_ISO = {"Mon": 1, "Tue": 2, "Wed": 3, "Thu": 4, "Fri": 5, "Sat": 6, "Sun": 7}


def _nth_sql(month: int, dow: str, nth: int) -> str:
    iso = _ISO[dow]
    if nth > 0:
        first = f"make_date(y, {month}, 1)"
        return f"{first} + CAST(({iso} - isodow({first}) + 7) % 7 + {7 * (nth - 1)} AS INTEGER)"
    last = f"last_day(make_date(y, {month}, 1))"
    return f"{last} - CAST((isodow({last}) - {iso} + 7) % 7 + {7 * (-nth - 1)} AS INTEGER)"


def _holiday_cte() -> str:
    """Holidays of every year that the tables' dates touch, and of the years next to them."""
    nth = " UNION ALL ".join(f"SELECT {_nth_sql(month, dow, n)} AS d FROM rc_years WHERE y BETWEEN {since} AND {until or 9999}"
                             for _name, month, dow, n, since, until in NTH_WEEKDAY_HOLIDAYS)
    fixed = " UNION ALL ".join(f"SELECT make_date(y, {m}, {d}) AS d FROM rc_years WHERE y BETWEEN {since} AND {until or 9999}"
                               for _name, m, d, since, until in FIXED_DATE_HOLIDAYS)
    return ("rc_years AS (SELECT CAST(unnest(range(min(y) - 1, max(y) + 2)) AS INTEGER) AS y FROM ("
            "SELECT year(l_shipdate) AS y FROM lineitem UNION ALL SELECT year(o_orderdate) FROM orders)),\n"
            f"rc_fixed AS ({fixed}),\n"
            f"rc_holidays AS (SELECT DISTINCT d AS date FROM ({nth} UNION ALL SELECT d FROM rc_fixed UNION ALL "
            "SELECT CASE WHEN isodow(d) = 6 THEN d - 1 ELSE d + 1 END FROM rc_fixed "
            f"WHERE isodow(d) >= 6 AND year(d) >= {OBSERVED_SINCE}))")


FIXTURES = f"""{_holiday_cte()},
rc_raw_sales AS (
  SELECT l.l_quantity AS raw_quantity, CAST(l.l_shipdate AS DATE) AS date,
         coalesce(CAST(s.s_nationkey AS VARCHAR), 'unknown') AS store_id,
         CAST(l.l_partkey AS VARCHAR) AS product_id,
         coalesce(p.p_type, 'unknown') AS category,
         CAST(l.l_quantity AS BIGINT) AS quantity_sold,
         l.l_extendedprice / nullif(l.l_quantity, 0) AS unit_price,
         l.l_discount AS discount_percent,
         l.l_extendedprice * (1 - l.l_discount) AS revenue,
         l.l_extendedprice * {COST_RATIO} AS cost,
         l.l_extendedprice * (1 - l.l_discount) - l.l_extendedprice * {COST_RATIO} AS profit
  FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
                  LEFT JOIN part p ON l.l_partkey = p.p_partkey),
rc_sales AS (SELECT * EXCLUDE raw_quantity FROM rc_raw_sales WHERE raw_quantity > 0),
rc_promotions AS (
  SELECT date, product_id, max(discount_percent) AS discount_percent, 'Discount' AS promotion_type
  FROM rc_sales WHERE discount_percent >= {PROMOTION_MIN_DISCOUNT} GROUP BY date, product_id),
rc_traffic_raw AS (
  SELECT CAST(o.o_orderdate AS DATE) AS date, coalesce(CAST(c.c_nationkey AS VARCHAR), 'unknown') AS store_id,
         count(*) AS customer_traffic
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2),
rc_traffic AS (
  SELECT t.*, CAST(CASE WHEN h.date IS NULL THEN 0 ELSE 1 END AS TINYINT) AS is_holiday
  FROM rc_traffic_raw t LEFT JOIN rc_holidays h ON t.date = h.date),
rc_promo_summary AS (
  SELECT date, product_id, max(discount_percent) AS discount_percent, CAST(1 AS TINYINT) AS has_promotion
  FROM rc_promotions GROUP BY date, product_id),
rc_traffic_summary AS (
  SELECT date, store_id, CAST(sum(customer_traffic) AS BIGINT) AS customer_traffic,
         max(is_holiday) AS is_holiday
  FROM rc_traffic GROUP BY date, store_id),
rc_daily_base AS (
  SELECT date, store_id, product_id, category,
         CAST(sum(quantity_sold) AS BIGINT) AS quantity_sold, sum(revenue) AS sales, sum(cost) AS cost,
         sum(profit) AS profit, avg(discount_percent) AS discount_percent, avg(unit_price) AS unit_price
  FROM rc_sales GROUP BY date, store_id, product_id, category),
rc_daily AS (
  SELECT d.*, CAST(coalesce(p.has_promotion, 0) AS TINYINT) AS has_promotion,
         t.customer_traffic, t.is_holiday
  FROM rc_daily_base d
  LEFT JOIN rc_promo_summary p ON d.date = p.date AND d.product_id = p.product_id
  LEFT JOIN rc_traffic_summary t ON d.date = t.date AND d.store_id = t.store_id),
rc_store_days AS (
  SELECT date, store_id, sum(sales) AS sales, CAST(sum(quantity_sold) AS BIGINT) AS quantity_sold,
         sum(profit) AS profit, avg(has_promotion) AS has_promotion,
         max(customer_traffic) AS customer_traffic, max(is_holiday) AS is_holiday
  FROM rc_daily GROUP BY date, store_id)"""


def with_fixtures(body: str, extra_ctes: str = "") -> str:
    """Prefix a query body with the shared fixture CTEs (and optional extra CTEs)."""
    ctes = FIXTURES + ((",\n" + extra_ctes) if extra_ctes else "")
    return f"WITH {ctes}\n{body}"
