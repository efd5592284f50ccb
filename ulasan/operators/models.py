"""Classifiers on Spark ML: fit, cross-validate, predict, explain."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ulasan.functions.text import label_name
from ulasan.operators import features as ft
from ulasan.operators import metrics
from ulasan.operators.ranking import beside
from ulasan.operators.sampling import folds, train_test_split
from ulasan.session import stored
from ulasan.settings import TrainParams

DEFAULTS = TrainParams()


@dataclass
class TrainedClassifier:
    """A slicer and classifier, the F-scores behind it, its history and its held-out rows."""

    model: PipelineModel
    params: TrainParams
    history: dict
    scores: DataFrame | None = None
    selected: list[int] = field(default_factory=list)
    test: DataFrame | None = None


def make_classifier(params: TrainParams, n_train: int, features: str = "selected", label: str = "sentimen"):
    """The classifier named by `model_type`; an unknown name gives default logistic regression.

    A penalty of `1 / (C * n)` on the mean loss has the same optimum as weight C on the summed loss.
    """
    p = dict(params.params)
    kind = params.model_type.lower()
    if kind not in ("logistic_regression", "svm", "random_forest"):
        warnings.warn(f"unknown model type {kind}, using logistic regression")
        kind, p = "logistic_regression", dict(DEFAULTS.params)
    columns = {"featuresCol": features, "labelCol": label}
    if kind == "random_forest":
        return RandomForestClassifier(
            numTrees=p.get("n_estimators", 100),
            maxDepth=p.get("max_depth", 5),
            seed=params.seed,
            **columns,
        )
    penalty = 1.0 / (p.get("C", 1.0) * max(n_train, 1))
    steps = p.get("max_iter", 1000)
    if kind == "svm":
        return LinearSVC(
            regParam=penalty, maxIter=steps, tol=p.get("tol", 1e-4), standardization=False, **columns
        )
    return LogisticRegression(
        regParam=penalty,
        elasticNetParam=0.0,
        maxIter=steps,
        tol=p.get("tol", 1e-6),
        standardization=False,
        **columns,
    )


def _accuracy(scored: DataFrame) -> float:
    return metrics.accuracy(scored, "sentimen", "prediction").head()[0] or 0.0


CELLS_PER_TASK = 4_000_000


def _gathered(df: DataFrame, rows: int, width: int) -> DataFrame:
    """`df` in no more tasks than its cells are worth: each step of a fit is a job over all of them."""
    parts = max(1, -(-rows * width // CELLS_PER_TASK))
    return df.coalesce(parts) if parts < df.rdd.getNumPartitions() else df


def cross_validate(train: DataFrame, params: TrainParams = DEFAULTS, key: str = "row_id") -> DataFrame:
    """Accuracy of every fold: `fold, n_test, accuracy`. Folds are fitted side by side.

    `train` has `selected` vectors; folds are stratified runs of the hash order.
    """
    k = params.cv_folds
    folded = folds(train.select(key, "sentimen", "selected"), k, "sentimen", key, params.seed + 1)
    folded = folded.persist(StorageLevel.MEMORY_AND_DISK)
    sizes = {r["fold"]: r["count"] for r in folded.groupBy("fold").count().collect()}
    total = sum(sizes.values())

    @inheritable_thread_target(train.sparkSession)
    def one(i: int):
        fit_on, held = folded.filter(F.col("fold") != i), folded.filter(F.col("fold") == i)
        model = make_classifier(params, total - sizes.get(i, 0)).fit(fit_on)
        return i, sizes.get(i, 0), _accuracy(model.transform(held))

    with ThreadPool(k) as pool:
        rows = pool.map(one, [i for i in range(k) if sizes.get(i)])
    folded.unpersist()
    return train.sparkSession.createDataFrame(rows, "fold int, n_test long, accuracy double")


def cv_summary(scores: DataFrame) -> DataFrame:
    """Mean accuracy with its population deviation and twice that."""
    return scores.agg(
        F.count("*").alias("n_folds"),
        F.avg("accuracy").alias("val_accuracy"),
        F.stddev_pop("accuracy").alias("val_std"),
        (F.stddev_pop("accuracy") * 2).alias("val_margin"),
    )


def train(
    df: DataFrame, params: TrainParams = DEFAULTS, key: str = "row_id", with_cv: bool = True
) -> TrainedClassifier:
    """Split, select features, fit, cross-validate and measure. `df` has `key, sentimen, features`.

    The selector sees the training rows only, unless `leaky_selection` asks for all rows.
    """
    label = "sentimen" if params.stratify else None
    split = train_test_split(
        df.select(key, "sentimen", "features"), params.test_size, label, key, params.seed
    )
    data = stored(split, "training")
    n_features = data.select(F.size(vector_to_array("features"))).head()
    n_features = n_features[0] if n_features else 0
    data = _gathered(data, data.count(), n_features)
    fit_rows, held = data.filter(~F.col("is_test")), data.filter("is_test")
    sizes = {r["is_test"]: r["count"] for r in data.groupBy("is_test").count().collect()}
    n_train, n_test = sizes.get(False, 0), sizes.get(True, 0)
    if n_train == 0:
        raise ValueError("no training rows")

    scores = None
    if params.k_features:
        scores = ft.f_scores(data if params.leaky_selection else fit_rows)
        selected = ft.selected_indices(scores, min(params.k_features, n_features))
    else:
        selected = list(range(n_features))
    slicer = VectorSlicer(inputCol="features", outputCol="selected", indices=selected)
    sliced = slicer.transform(fit_rows)

    @inheritable_thread_target(df.sparkSession)
    def whole():
        return make_classifier(params, n_train).fit(sliced)

    @inheritable_thread_target(df.sparkSession)
    def by_folds():
        return [tuple(r) for r in cross_validate(sliced, params, key).orderBy("fold").collect()] if with_cv else []

    # The folds' models don't depend on the whole one: all are fitted side by side.
    with ThreadPool(2) as pool:
        fitted, folded = pool.apply_async(whole), pool.apply_async(by_folds)
        classifier, fold_rows = fitted.get(), folded.get()
    model = PipelineModel(stages=[slicer, classifier])

    history = {
        "train_accuracy": _accuracy(model.transform(fit_rows)),
        "test_accuracy": _accuracy(model.transform(held)) if n_test else None,
        "n_samples": n_train + n_test,
        "n_train": n_train,
        "n_test": n_test,
        "n_features": n_features,
        "n_selected": len(selected),
    }
    if with_cv:
        by_fold = df.sparkSession.createDataFrame(fold_rows, "fold int, n_test long, accuracy double")
        history["cv_scores"] = [r[2] for r in fold_rows]
        row = cv_summary(by_fold).head()
        history["val_accuracy"], history["val_std"] = row["val_accuracy"], row["val_std"]
    return TrainedClassifier(model, params, history, scores, selected, held)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds `prediction, sentiment, confidence, probabilities`; both last are null for a linear SVM."""
    out = model.transform(df).drop("selected", "rawPrediction")
    label = F.col("prediction").cast("int")
    if "probability" in out.columns:
        p = vector_to_array("probability")
        conf, neg, pos = F.array_max(p), p[0], p[1]
    else:
        conf = neg = pos = F.lit(None).cast("double")
    return out.select(
        *df.columns,
        label.alias("prediction"),
        label_name(label).alias("sentiment"),
        conf.alias("confidence"),
        F.struct(neg.alias("negative"), pos.alias("positive")).alias("probabilities"),
    )


def evaluate(trained: TrainedClassifier) -> DataFrame:
    """Accuracy, weighted scores, matrix cells and AUC of the held-out rows, in one row."""
    if trained.test is None:
        raise ValueError("no held-out rows")
    scored = predict(trained.model, trained.test)
    main = metrics.evaluation(scored, "sentimen", "prediction")
    auc = metrics.roc_auc(
        scored.withColumn("score", F.col("probabilities.positive")).filter(F.col("score").isNotNull()),
        "sentimen",
        "score",
    )
    return beside(main, auc)


def feature_importance(trained: TrainedClassifier, top_k: int = 20) -> DataFrame:
    """Largest importances: |coefficient| times F for linear models, impurity for a forest.

    `feature` is the index in the full vector, `position` the one among the selected features.
    """
    clf = trained.model.stages[-1]
    linear = hasattr(clf, "coefficients")
    weights = (clf.coefficients if linear else clf.featureImportances).toArray()
    rows = [(i, int(f), float(w)) for i, (f, w) in enumerate(zip(trained.selected, weights))]
    table = (trained.test if trained.scores is None else trained.scores).sparkSession.createDataFrame(
        rows, "position int, feature int, weight double"
    )
    size = F.abs("weight")
    if linear and trained.scores is not None:
        table = table.join(trained.scores, "feature", "left")
        size = size * F.col("f_score")
    return (
        table.select(
            "position",
            "feature",
            size.alias("importance"),
            (F.col("weight") if linear else F.lit(None).cast("double")).alias("coefficient"),
        )
        .orderBy(F.col("importance").desc_nulls_last(), "position")
        .limit(top_k)
    )


def model_info(trained: TrainedClassifier) -> dict:
    clf = trained.model.stages[-1]
    return {
        "model_type": trained.params.model_type,
        "classifier_type": type(clf).__name__,
        "has_feature_selector": trained.scores is not None,
        "n_features": len(trained.selected),
        "n_classes": clf.numClasses,
        "history": trained.history,
    }
