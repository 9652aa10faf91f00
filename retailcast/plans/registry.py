"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None).

Builders take ``(spark, sf_dir)`` and return a lazy DataFrame.  Every
computed column is aliased to the same name as in the SQL twin.  Doubles are
rounded identically on both sides (``present``) so that summation order does
not decide the comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# Presentation rounding adds a fixed 1e-8 before rounding.  Money values here are
# exact multiples of 1e-4, so many sit exactly on a rounding boundary, where the
# last-bit noise of a different summation order would decide the direction; the
# offset moves every such value off the boundary the same way on both sides.
ROUND_OFFSET = 1e-8


def rounded(c, digits: int = 4):
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col + F.lit(ROUND_OFFSET), digits)


def present(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double column to ``digits`` places (the SQL twin does the same)."""
    return df.select(*[rounded(f.name, digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def rnd(expr: str, digits: int = 4) -> str:
    return f"round(CAST({expr} AS DOUBLE) + {ROUND_OFFSET}, {digits})"
