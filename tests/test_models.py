import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ulasan.operators import features as ft
from ulasan.operators import models as md
from ulasan.settings import TrainParams
from ulasan.sources import stores
from ulasan.session import scratch_path

N, D = 600, 12


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(11)
    x = rng.normal(size=(N, D))
    y = (x[:, 0] * 2 - x[:, 3] + rng.normal(size=N) > 0.4).astype(int)
    return x, y


@pytest.fixture(scope="module")
def points(spark, data):
    x, y = data
    rows = [(i, int(y[i]), [float(v) for v in x[i]]) for i in range(N)]
    df = spark.createDataFrame(rows, "row_id long, sentimen int, v array<double>")
    return df.select("row_id", "sentimen", array_to_vector("v").alias("features")).cache()


def f_by_hand(x, y):
    groups = [x[y == c] for c in (0, 1)]
    between = sum(len(g) * (g.mean(0) - x.mean(0)) ** 2 for g in groups)
    within = sum(((g - g.mean(0)) ** 2).sum(0) for g in groups)
    return between / (within / (len(x) - 2))


def test_f_scores_and_selection(points, data):
    want = f_by_hand(*data)
    scores = ft.f_scores(points)
    got = {r["feature"]: r["f_score"] for r in scores.collect()}
    assert np.allclose([got[i] for i in range(D)], want)
    assert ft.selected_indices(scores, 3) == sorted(np.argsort(-want)[:3].tolist())
    assert ft.selected_indices(scores, 99) == list(range(D))
    report = ft.selection_report(scores, 3).head()
    assert (report["n_before"], report["n_after"], report["pct_removed"]) == (12, 3, 75.0)
    assert report["f_threshold"] == pytest.approx(np.sort(want)[-3])


def test_constant_features_come_last(spark):
    rows = [(0, [1.0, 5.0, 0.0]), (0, [1.0, 6.0, 0.0]), (1, [1.0, 9.0, 1.0]), (1, [1.0, 8.0, 1.0])]
    df = spark.createDataFrame(rows, "sentimen int, v array<double>")
    df = df.select("sentimen", array_to_vector("v").alias("features"))
    order = [r["feature"] for r in ft.select_k_best(ft.f_scores(df), None).collect()]
    assert order == [2, 1, 0]  # infinite, finite, undefined


def test_logistic_regression_reaches_the_optimum(points, data):
    x, y = data
    model = md.make_classifier(TrainParams(), N).fit(points.withColumnRenamed("features", "selected"))
    a, w = np.hstack([x, np.ones((N, 1))]), np.zeros(D + 1)
    penalty = np.diag([1.0] * D + [0.0])
    for _ in range(50):  # Newton steps on the summed log loss plus |w|^2 / 2
        p = 1 / (1 + np.exp(-a @ w))
        hess = a.T @ (a * (p * (1 - p))[:, None]) + penalty
        w -= np.linalg.solve(hess, a.T @ (p - y) + penalty @ w)
    assert np.allclose(model.coefficients.toArray(), w[:-1], atol=1e-3)
    assert model.intercept == pytest.approx(w[-1], abs=1e-3)


def test_train_history_predict_importance(points):
    run = md.train(points, TrainParams(k_features=4))
    h = run.history
    assert h["n_train"] + h["n_test"] == N and h["n_selected"] == 4 and len(h["cv_scores"]) == 3
    assert h["val_accuracy"] == pytest.approx(np.mean(h["cv_scores"]))
    assert h["val_std"] == pytest.approx(np.std(h["cv_scores"]))
    assert h["test_accuracy"] > 0.75 and {0, 3} <= set(run.selected)
    best = md.feature_importance(run, 2).collect()
    assert best[0]["feature"] == 0 and run.selected[best[0]["position"]] == 0
    assert best[0]["importance"] >= best[1]["importance"]
    out = md.predict(run.model, points).collect()
    assert len(out) == N and all(abs(sum(r["probabilities"]) - 1) < 1e-12 for r in out)
    quality = md.evaluate(run).head()
    assert quality["accuracy"] == pytest.approx(h["test_accuracy"]) and 0.5 < quality["auc"] <= 1
    assert md.model_info(run)["n_features"] == 4


def test_selector_sees_training_rows_only_unless_asked(points, data):
    x, y = data
    run = md.train(points, TrainParams(k_features=4), with_cv=False)
    held = {r["row_id"] for r in run.test.collect()}
    keep = [i for i in range(N) if i not in held]
    got = {r["feature"]: r["f_score"] for r in run.scores.collect()}
    assert np.allclose([got[i] for i in range(D)], f_by_hand(x[keep], y[keep]))
    leaky = md.train(points, TrainParams(k_features=4, leaky_selection=True), with_cv=False)
    got = {r["feature"]: r["f_score"] for r in leaky.scores.collect()}
    assert np.allclose([got[i] for i in range(D)], f_by_hand(x, y))


def test_svm_forest_and_fallback(points):
    svm = md.train(points, TrainParams(model_type="svm"), with_cv=False)
    row = md.predict(svm.model, points).head()
    assert row["confidence"] is None and row["sentiment"] in ("Negative", "Positive")
    assert md.evaluate(svm).head()["auc"] is None
    forest = md.train(points, TrainParams(model_type="random_forest", params={"n_estimators": 5}), with_cv=False)
    assert md.evaluate(forest).head()["accuracy"] > 0.6
    top = md.feature_importance(forest, 3).collect()
    assert len(top) == 3 and top[0]["coefficient"] is None
    with pytest.warns(UserWarning):
        other = md.make_classifier(TrainParams(model_type="boosted"), N)
    assert type(other).__name__ == "LogisticRegression"


def test_classifier_survives_saving(spark, points):
    run = md.train(points, TrainParams(k_features=4), with_cv=False)
    path = scratch_path(spark, "classifier")
    stores.save_classifier(run, path)
    back = stores.load_classifier(spark, path)
    assert back.history == run.history and back.selected == run.selected and back.params == run.params
    assert md.evaluate(back).head() == md.evaluate(run).head()


def test_projection_matches_svd(points, data):
    x, _ = data
    out, ratio = ft.project_2d(points, 1000)
    got = {r["row_id"]: (r["pc1"], r["pc2"]) for r in out.collect()}
    c = x - x.mean(0)
    _, s, vt = np.linalg.svd(c, full_matrices=False)
    want = c @ vt[:2].T
    assert np.allclose(np.abs([got[i] for i in range(N)]), np.abs(want), atol=1e-8)
    assert np.allclose(ratio, (s**2 / (s**2).sum())[:2])


def test_text_encoder_matches_the_formula(spark):
    texts = ["baik sekali baik", "buruk sekali", "baik", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, review_clean string")
    model = ft.fit_text_encoder(df, 64)
    got = {r["i"]: np.array(r["a"]) for r in ft.encode(model, df).select("i", vector_to_array("features").alias("a")).collect()}
    place = {w: model.stages[1].indexOf(w) for w in ("baik", "sekali", "buruk")}
    assert len(set(place.values())) == 3
    idf = {"baik": np.log(5 / 3), "sekali": np.log(5 / 3), "buruk": np.log(5 / 2)}
    for i, t in enumerate(texts):
        want = np.zeros(64)
        for w in t.split():
            want[place[w]] += idf[w]
        norm = np.linalg.norm(want)
        assert np.allclose(got[i], want / norm if norm else want)


def test_user_encoder_is_loaded_per_task(spark):
    def load():
        return lambda texts: [[len(t), t.count("a")] for t in texts]

    df = spark.range(500).select("id", F.concat(F.lit("a"), F.col("id")).alias("review_clean"))
    out = ft.encode_with(df, load, batch_size=7).collect()
    assert len(out) == 500 and all(r["embedding"] == [len(r["review_clean"]), 1.0] for r in out)
