"""End-to-end jobs: train on a review table, score texts, add neighbours, save and load a run."""

from __future__ import annotations

import time
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ulasan.operators import features as ft
from ulasan.operators import models, prepare, vectors
from ulasan.operators.models import TrainedClassifier
from ulasan.operators.sampling import stratified_sample
from ulasan.settings import CleanRules, IndexParams, TrainParams
from ulasan.sources import stores


@dataclass
class TrainedRun:
    """What a training job leaves behind; `index` is None when it was skipped."""

    rules: CleanRules
    encoder: PipelineModel
    classifier: TrainedClassifier
    index: DataFrame | None
    index_params: IndexParams
    n_rows: int
    dim: int
    seconds: float | None = None


def train_job(
    df: DataFrame,
    rules: CleanRules = CleanRules(),
    params: TrainParams = TrainParams(),
    index_params: IndexParams = IndexParams(),
    sample: int | None = None,
    skip_index: bool = False,
    with_cv: bool = True,
    save_path: str | None = None,
) -> TrainedRun:
    """Validate, sample, prepare, encode, train and index `(row_id, review, sentimen)` rows.

    Each stage raises when it cannot go on. The prepared rows are written once to the shared folder, with
    their token counts, so the later stages neither clean again nor depend on the executors that did. The
    index weighs those counts when it is read; its texts and vectors are not stored a second time.
    """
    start = time.perf_counter()
    check = prepare.validate(df).head()
    if not check["is_valid"]:
        raise ValueError(f"invalid dataset: {check.asDict()}")
    if sample:
        df = stratified_sample(df, sample)
    encoder, encoded = ft.fit_and_encode(prepare.prepare(df, rules), params.dim)
    n_rows = encoded.count()
    classifier = models.train(encoded, params, with_cv=with_cv)
    index = None
    if not skip_index:
        index = vectors.build_index(
            ft.to_array(encoded).withColumnRenamed("row_id", "vec_id"),
            params=index_params,
            check=False,
        )
    run = TrainedRun(rules, encoder, classifier, index, index_params, n_rows, params.dim)
    if save_path:
        save_run(run, save_path)
    run.seconds = time.perf_counter() - start
    return run


def score(run: TrainedRun, df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Score all rows of `(row_index, review)` in one plan; rejects come second, with a reason."""
    cleaned = prepare.flag_rejects(prepare.with_clean(df, run.rules))
    kept = cleaned.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    rejects = cleaned.filter(F.col("reject_reason").isNotNull()).select(
        "row_index", "review", "reject_reason"
    )
    scored = models.predict(run.classifier.model, ft.encode(run.encoder, kept)).drop("features")
    return scored, rejects


def score_text(spark: SparkSession, run: TrainedRun, text: str) -> DataFrame:
    """One text through the same plan; no row when it is too short."""
    row = spark.createDataFrame([(0, text)], "row_index long, review string")
    return score(run, row)[0]


def search_texts(run: TrainedRun, queries: DataFrame, k: int = 5) -> DataFrame:
    """Ranked index rows for `(query_id, review)` texts, cleaned like the training text."""
    if run.index is None:
        raise ValueError("the run has no index")
    cleaned = prepare.with_clean(queries, run.rules)
    vecs = ft.to_array(ft.encode(run.encoder, cleaned), out="query_vec").select("query_id", "query_vec")
    hits = vectors.search(run.index, vecs, k, run.index_params)
    return vectors.ranked_hits(hits, run.index.drop("unit_vec"))


def score_with_neighbours(
    run: TrainedRun, df: DataFrame, k: int = 2, cap: int | None = None
) -> DataFrame:
    """Scored rows with their nearest reviews nested in rank order.

    `cap` asks for neighbours of the first rows only; at most `k` hits are nested per row.
    """
    scored, _ = score(run, df)
    asking = df if cap is None else vectors.capped_queries(df, cap)
    queries = asking.select(F.col("row_index").alias("query_id"), "review")
    hits = search_texts(run, queries, k)
    nested = hits.groupBy(F.col("query_id").alias("row_index")).agg(
        F.sort_array(
            F.collect_list(F.struct("rank", "vec_id", "similarity", "text", "sentiment"))
        ).alias("similar_reviews")
    )
    return scored.join(nested, "row_index", "left")


def run_info(spark: SparkSession, run: TrainedRun) -> DataFrame:
    """One row of sizes, flags and held-out quality."""
    quality = models.evaluate(run.classifier).head()
    row = {
        "is_trained": True,
        "dataset_size": run.n_rows,
        "embedding_dim": run.dim,
        "n_selected": len(run.classifier.selected),
        "index_built": run.index is not None,
        "model_type": run.classifier.params.model_type,
        "test_accuracy": quality["accuracy"],
        "f1_score": quality["f1_score"],
        "seconds": run.seconds,
    }
    schema = (
        "is_trained boolean, dataset_size long, embedding_dim int, n_selected int, "
        "index_built boolean, model_type string, test_accuracy double, f1_score double, seconds double"
    )
    return spark.createDataFrame([tuple(row.values())], schema)


def save_run(run: TrainedRun, path: str) -> None:
    """Classifier, encoder, index, cleaning settings and sizes under one folder."""
    spark = run.classifier.test.sparkSession
    stores.save_classifier(run.classifier, f"{path}/classifier")
    run.encoder.write().overwrite().save(f"{path}/encoder")
    if run.index is not None:
        stores.save_index(run.index, f"{path}/index", run.index_params)
    stores.save_settings(spark, run.rules, f"{path}/settings")
    stores.write_json(
        spark,
        f"{path}/info",
        {
            "n_rows": run.n_rows,
            "dim": run.dim,
            "has_index": run.index is not None,
            "index_params": asdict(run.index_params),
        },
    )


def load_run(spark: SparkSession, path: str) -> TrainedRun:
    info = stores.read_json(spark, f"{path}/info")
    index = stores.load_index(spark, f"{path}/index")[0] if info["has_index"] else None
    return TrainedRun(
        stores.load_settings(spark, f"{path}/settings"),
        PipelineModel.load(f"{path}/encoder"),
        stores.load_classifier(spark, f"{path}/classifier"),
        index,
        IndexParams(**info["index_params"]),
        info["n_rows"],
        info["dim"],
    )
