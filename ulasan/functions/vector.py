"""Vector columns over ARRAY<FLOAT>, computed in double."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def _d(v: Column) -> Column:
    return v.cast("array<double>")


def _sum(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x)


def _let(value: Column, body) -> Column:
    """Compute `value` once and use it in `body`; inside a lambda it would be computed per element."""
    return F.transform(F.array(value), body)[0]


def inner_product(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(_d(a), _d(b), lambda x, y: x * y))


def l2_norm(v: Column) -> Column:
    return F.sqrt(_sum(F.transform(_d(v), lambda x: x * x)))


def l2_normalize(v: Column) -> Column:
    """Unit length; a zero vector stays zero."""
    return _let(
        l2_norm(v), lambda n: F.when(n > 0, F.transform(_d(v), lambda x: x / n)).otherwise(_d(v))
    )


def cosine(a: Column, b: Column) -> Column:
    """Zero when either vector is zero."""
    return _let(
        l2_norm(a) * l2_norm(b),
        lambda scale: F.when(scale > 0, inner_product(a, b) / scale).otherwise(F.lit(0.0)),
    )


def squared_l2(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(_d(a), _d(b), lambda x, y: (x - y) * (x - y)))


def confidence(probability: Column) -> Column:
    return F.array_max(vector_to_array(probability))


def row_mean(v: Column) -> Column:
    return _sum(_d(v)) / F.size(v)


def row_std(v: Column) -> Column:
    """Population standard deviation of one vector."""
    return _let(
        row_mean(v),
        lambda mean: F.sqrt(_sum(F.transform(_d(v), lambda x: (x - mean) * (x - mean))) / F.size(v)),
    )
