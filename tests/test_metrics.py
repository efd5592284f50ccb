import numpy as np
import pytest

from ulasan.operators import metrics


def scored(spark, actual, predicted, score=None):
    score = score if score is not None else [0.0] * len(actual)
    rows = [(int(a), int(p), float(s)) for a, p, s in zip(actual, predicted, score)]
    return spark.createDataFrame(rows, "actual int, predicted int, score double")


@pytest.mark.parametrize("digits", [1, 8])
def test_auc_equals_all_pairs(spark, digits):
    rng = np.random.default_rng(5)
    a = (rng.random(1500) < 0.3).astype(int)
    s = np.round(rng.random(1500) * 0.6 + a * 0.3, digits)
    pos, neg = s[a == 1], s[a == 0]
    diff = pos[:, None] - neg[None, :]
    want = ((diff > 0) + 0.5 * (diff == 0)).mean()
    assert metrics.roc_auc(scored(spark, a, a, s)).head()["auc"] == pytest.approx(want, abs=1e-12)


def test_auc_of_one_class_is_null(spark):
    assert metrics.roc_auc(scored(spark, [1, 1], [1, 0], [0.1, 0.2])).head()["auc"] is None


def test_zero_division_gives_zero(spark):
    df = scored(spark, [0, 0, 1], [0, 0, 0])
    report = {r["entry"]: r for r in metrics.classification_report(df).collect()}
    assert report["Positive"]["precision"] == 0 and report["Positive"]["f1_score"] == 0
    assert report["Negative"]["recall"] == 1 and report["accuracy"]["precision"] == pytest.approx(2 / 3)
    cells = {(r["actual"], r["predicted"]): r["n"] for r in metrics.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 0}
    assert metrics.binary_scores(df).head()["recall"] == 0
    assert metrics.weighted_scores(df).head()["recall"] == pytest.approx(2 / 3)
