"""Deterministic samples, heads and splits."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ulasan.functions.text import label_name
from ulasan.operators.ranking import hash_lowest, hash_tiles


def stratified_sample(
    df: DataFrame, n: int = 1000, label: str = "sentimen", key: str = "row_id", seed: int = 42
) -> DataFrame:
    """`min(class size, n // classes)` rows of each class; the whole table when `n` covers it."""

    def quota(group_n, total_n, n_groups):
        # Rows without a label belong to no class; they stay only when the whole table does.
        return (
            F.when(total_n <= n, group_n)
            .when(F.col("grp").isNull(), F.lit(0))
            .otherwise(F.least(group_n, F.floor(F.lit(n) / n_groups).cast("long")))
        )

    return hash_lowest(df, key, quota, by=label, seed=seed).filter("taken").select(*df.columns)


def random_sample(df: DataFrame, n: int, key: str = "row_id", seed: int = 42) -> DataFrame:
    """Exactly `min(n, rows)` rows, without replacement."""
    taken = hash_lowest(df, key, lambda rows, _t, _g: F.least(rows, F.lit(n)), seed=seed)
    return taken.filter("taken").select(*df.columns)


def random_index_samples(index: DataFrame, n: int = 10, seed: int = 42) -> DataFrame:
    """Sampled index rows with their label name."""
    return random_sample(index, n, "vec_id", seed).withColumn(
        "sentiment", label_name(F.col("sentimen"))
    )


def first_per_label(df: DataFrame, n: int = 3, label: str = "sentimen", key: str = "row_id") -> DataFrame:
    """The first rows of each label; each map task keeps `n` before the shuffle."""
    w = Window.partitionBy(label).orderBy(key)
    return df.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= n)


def head(df: DataFrame, n: int = 5, key: str = "row_id") -> DataFrame:
    return df.orderBy(key).limit(n)


def train_test_split(
    df: DataFrame,
    test_size: float = 0.2,
    label: str | None = "sentimen",
    key: str = "row_id",
    seed: int = 42,
) -> DataFrame:
    """Adds `is_test`: the first `ceil(test_size * n)` keys of each class in hash order.

    `label=None` splits the table as one class.
    """
    return hash_lowest(
        df,
        key,
        lambda n, _t, _g: F.ceil(F.lit(Decimal(str(test_size))) * n).cast("long"),
        by=label,
        seed=seed,
        flag="is_test",
    )


def folds(
    df: DataFrame, k: int = 3, label: str | None = "sentimen", key: str = "row_id", seed: int = 43
) -> DataFrame:
    """Adds `fold`: `k` stratified runs of the hash order."""
    return hash_tiles(df, key, k, by=label, seed=seed)
