"""The registry of checked queries: a Spark query and, where SQL can state it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


def r6(c) -> Column:
    """Six decimals, without a negative zero."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)


def rounded(df: DataFrame) -> DataFrame:
    """All double columns to six decimals, all whole numbers to long."""
    out = []
    for name, kind in df.dtypes:
        if kind in ("double", "float"):
            out.append(r6(F.col(name).cast("double")).alias(name))
        elif kind in ("int", "smallint", "tinyint"):
            out.append(F.col(name).cast("long").alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def load_all() -> tuple[dict[str, Query], dict[str, str]]:
    from ulasan.plans import (  # noqa: F401 - registration
        queries_learning,
        queries_profile,
        queries_sources,
        queries_text,
        queries_vectors,
    )

    return dict(QUERIES), dict(SQL)
