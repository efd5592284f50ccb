"""Saving and loading: predictions, samples, vectors, indexes, classifiers, settings."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ulasan.operators.models import TrainedClassifier
from ulasan.operators.sampling import stratified_sample
from ulasan.settings import CleanRules, IndexParams, TrainParams


def write_json(spark: SparkSession, path: str, values: dict) -> None:
    """One JSON document through Spark, so any shared file system works."""
    row = spark.createDataFrame([(json.dumps(values),)], "value string")
    row.coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads("".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))


# --- predictions and samples --------------------------------------------------


def prediction_rows(scored: DataFrame) -> DataFrame:
    """The seven columns of a prediction file."""
    return scored.select(
        F.col("review").alias("original_text"),
        F.col("review_clean").alias("clean_text"),
        F.col("sentiment").alias("predicted_sentiment"),
        "confidence",
        F.col("probabilities.negative").alias("negative_probability"),
        F.col("probabilities.positive").alias("positive_probability"),
        "row_index",
    )


CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_predictions(scored: DataFrame, path: str) -> str:
    """CSV, or Parquet for a `.parquet` name; any other name gets `.csv` appended."""
    rows = prediction_rows(scored)
    if path.endswith(".parquet"):
        rows.write.mode("overwrite").parquet(path)
        return path
    if not path.endswith(".csv"):
        path += ".csv"
    write_csv(rows, path)
    return path


def write_sample(df: DataFrame, path: str, n: int = 100, key: str = "row_id", seed: int = 42) -> None:
    """A stratified sample as CSV, without the row key."""
    write_csv(stratified_sample(df, n, key=key, seed=seed).drop(key), path)


# --- vectors and indexes ------------------------------------------------------


def save_vectors(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_index(index: DataFrame, path: str, params: IndexParams = IndexParams()) -> None:
    """The vector table with its metadata columns, and one info document."""
    index.write.mode("overwrite").parquet(f"{path}/vectors")
    first = index.select(F.size("unit_vec")).head()
    write_json(
        index.sparkSession,
        f"{path}/info",
        {"dimension": first[0] if first else 0, "params": asdict(params)},
    )


def load_index(spark: SparkSession, path: str) -> tuple[DataFrame, IndexParams]:
    info = read_json(spark, f"{path}/info")
    return spark.read.parquet(f"{path}/vectors"), IndexParams(**info["params"])


# --- classifiers and settings ---------------------------------------------------


def save_classifier(trained: TrainedClassifier, path: str) -> None:
    """Model, F-scores, history, and the held-out rows, so evaluation still works after loading."""
    if trained.model is None:
        raise ValueError("no trained model to save")
    spark = trained.test.sparkSession
    trained.model.write().overwrite().save(f"{path}/model")
    trained.test.write.mode("overwrite").parquet(f"{path}/held_out")
    if trained.scores is not None:
        trained.scores.write.mode("overwrite").parquet(f"{path}/scores")
    write_json(
        spark,
        f"{path}/info",
        {
            "params": asdict(trained.params),
            "history": trained.history,
            "selected": trained.selected,
            "has_scores": trained.scores is not None,
        },
    )


def load_classifier(spark: SparkSession, path: str) -> TrainedClassifier:
    info = read_json(spark, f"{path}/info")
    return TrainedClassifier(
        PipelineModel.load(f"{path}/model"),
        TrainParams(**info["params"]),
        info["history"],
        spark.read.parquet(f"{path}/scores") if info["has_scores"] else None,
        info["selected"],
        spark.read.parquet(f"{path}/held_out"),
    )


def save_settings(spark: SparkSession, rules: CleanRules, path: str) -> None:
    write_json(spark, path, rules.to_dict())


def load_settings(spark: SparkSession, path: str, current: CleanRules = CleanRules()) -> CleanRules:
    """Stored values over the current ones; absent keys keep the current value."""
    return current.updated(read_json(spark, path))
