"""Registered queries (Spark) and their DuckDB oracle text, keyed by the operator inventory names.

Every query reads the driver tables through the fixture views and runs over whole tables. Double
outputs are rounded to 6 digits on both sides so that summation-order differences between the
engines do not change the value hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.stats import round6

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def rounded(df: DataFrame) -> DataFrame:
    """Round every double/float column (top level) for the cross-engine comparison."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round6(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def r6(expr: str) -> str:
    """SQL side of ``round6``."""
    return f"round(cast({expr} AS DOUBLE), 6) + 0.0"


# SQL fragments shared by oracle texts -------------------------------------------------------

def sql_corr_strict(a: str, b: str) -> str:
    return (f"CASE WHEN count(*) = count({a}) AND count(*) = count({b}) "
            f"THEN covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0) END")


def sql_corr_pairwise(a: str, b: str) -> str:
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    a2, b2 = f"CASE WHEN {both} THEN {a} END", f"CASE WHEN {both} THEN {b} END"
    return f"covar_pop({a2}, {b2}) / nullif(stddev_pop({a2}) * stddev_pop({b2}), 0)"


def sql_rank_pct(v: str, part: str = "era", tb: str = "row_idx") -> str:
    over = f"PARTITION BY {part} " if part else ""
    return (f"CASE WHEN {v} IS NOT NULL THEN row_number() OVER ({over}ORDER BY {v} ASC NULLS LAST, {tb}) "
            f"/ count({v}) OVER ({'PARTITION BY ' + part if part else ''}) END")


def sql_unif(v: str, part: str = "era", tb: str = "row_idx") -> str:
    return (f"CASE WHEN {v} IS NOT NULL THEN (row_number() OVER (PARTITION BY {part} ORDER BY {v} ASC NULLS LAST, {tb}) "
            f"- 0.5) / count(*) OVER (PARTITION BY {part}) END")


def _era_corr_sql(view: str, pred: str = "prediction", target: str = "target", where: str = "") -> str:
    return f"""
SELECT era, {sql_corr_strict('r', target)} AS corr FROM (
  SELECT era, {target}, {sql_rank_pct(pred)} AS r FROM {view} {where}
) GROUP BY era"""


from . import suite_etl, suite_models, suite_queries, suite_registry, suite_vectors  # noqa: E402,F401  (registers the queries)
