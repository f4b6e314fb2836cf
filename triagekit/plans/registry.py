"""Named queries: each a (spark, sf_dir) -> DataFrame callable plus, where the
result is relational, an equivalent DuckDB SQL string over the same tables.

Float columns are rounded to 6 decimals on both sides (engines differ in the
last digits of float sums).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROUND_DIGITS = 6


@dataclass
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    doubles: list[str] = field(default_factory=list)
    ops: str = ""
    raw: list[str] = field(default_factory=list)  # passthrough floats: compared unrounded


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, doubles: list[str] | None = None, ops: str = "",
             raw: list[str] | None = None):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql, list(doubles or []), ops, list(raw or []))
        return fn
    return deco


def finish(df: DataFrame, raw: list[str] | None = None) -> DataFrame:
    """Round float columns to ROUND_DIGITS (floats widened to double); ``raw`` columns pass through."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in (raw or []):
            cols.append(F.round(F.col(f.name).cast("double"), ROUND_DIGITS).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def rounded_sql(q: Query) -> str | None:
    if q.sql is None:
        return None
    if not q.doubles:
        return q.sql
    rep = ", ".join(f"round(CAST({c} AS DOUBLE), {ROUND_DIGITS}) AS {c}" for c in q.doubles)
    return f"SELECT * REPLACE ({rep}) FROM (\n{q.sql}\n) AS q"


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    out = {}
    for name, q in REGISTRY.items():
        out[name] = (lambda fn, raw: (lambda spark, sf_dir: finish(fn(spark, sf_dir), raw)))(q.fn, q.raw)
    return out


def oracle_queries() -> dict[str, str]:
    _load()
    return {name: rounded_sql(q) for name, q in REGISTRY.items() if q.sql is not None}


def _load():
    # importing the query modules fills REGISTRY
    from . import queries_eval, queries_ml, queries_monitor, queries_outcomes, queries_profile, queries_reports, queries_robust  # noqa: F401
