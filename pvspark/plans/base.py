"""Query registry: every named query is a callable ``(spark, sf_dir) -> DataFrame`` plus, where the
result is SQL-expressible, the DuckDB SQL that must produce the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def r6(c) -> Column:
    """Doubles leave every query rounded to 6 places (the oracle does the same)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 6)


def round_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[r6(f.name).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
                       else F.col(f.name) for f in df.schema.fields])


# ---- DuckDB snippets shared by oracles ----------------------------------------------------

def int_guard(x: str) -> str:
    """Spark's ``try_cast(x AS INT)`` on strings: only integer literals parse ('45.0' -> NULL)."""
    return f"(CASE WHEN regexp_matches(trim({x}), '^[+-]?[0-9]+$') THEN TRY_CAST(trim({x}) AS INTEGER) END)"


def age_group_sql(a: str) -> str:
    return (f"(CASE WHEN {a} IS NULL THEN 'unknown' WHEN {a} < 18 THEN '0-17' WHEN {a} < 35 THEN '18-34' "
            f"WHEN {a} < 65 THEN '35-64' ELSE '65+' END)")
