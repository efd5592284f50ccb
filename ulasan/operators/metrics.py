"""Classifier metrics over a table of (actual, predicted, score) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ulasan.functions.text import label_name
from ulasan.operators.ranking import running_sums
from ulasan.session import stored

LABELS = (0, 1)


def _ratio(a: Column, b: Column) -> Column:
    """Zero on a zero divisor."""
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def confusion_counts(scored: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """The four cells of the matrix as columns `n00 n01 n10 n11` (actual, then predicted)."""
    a, p = F.col(actual), F.col(predicted)
    return scored.agg(
        *[F.count_if((a == i) & (p == j)).alias(f"n{i}{j}") for i in LABELS for j in LABELS]
    )


def confusion_matrix(scored: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Long form, zero cells kept."""
    cells = F.array(
        *[
            F.struct(
                F.lit(i).alias("actual"), F.lit(j).alias("predicted"), F.col(f"n{i}{j}").alias("n")
            )
            for i in LABELS
            for j in LABELS
        ]
    )
    return confusion_counts(scored, actual, predicted).select(F.inline(cells))


def accuracy(scored: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    hit = (F.col(actual) == F.col(predicted)).cast("double")
    return scored.agg(F.avg(hit).alias("accuracy"))


def _class_columns() -> dict[int, dict[str, Column]]:
    n = {(i, j): F.col(f"n{i}{j}") for i in LABELS for j in LABELS}
    out = {}
    for c in LABELS:
        o = 1 - c
        precision = _ratio(n[c, c], n[c, c] + n[o, c])
        recall = _ratio(n[c, c], n[c, c] + n[c, o])
        out[c] = {
            "precision": precision,
            "recall": recall,
            "f1_score": _ratio(2 * precision * recall, precision + recall),
            "support": n[c, c] + n[c, o],
        }
    return out


def _averages() -> dict[str, dict[str, Column]]:
    per = _class_columns()
    total = per[0]["support"] + per[1]["support"]
    names = ("precision", "recall", "f1_score")
    return {
        "macro avg": {m: (per[0][m] + per[1][m]) / 2 for m in names} | {"support": total},
        "weighted avg": {
            m: _ratio(per[0][m] * per[0]["support"] + per[1][m] * per[1]["support"], total)
            for m in names
        }
        | {"support": total},
    }


def weighted_scores(scored: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    row = _averages()["weighted avg"]
    return confusion_counts(scored, actual, predicted).select(
        row["precision"].alias("precision"),
        row["recall"].alias("recall"),
        row["f1_score"].alias("f1_score"),
    )


def binary_scores(scored: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    row = _class_columns()[1]
    return confusion_counts(scored, actual, predicted).select(
        row["precision"].alias("precision"),
        row["recall"].alias("recall"),
        row["f1_score"].alias("f1_score"),
    )


def classification_report(
    scored: DataFrame, actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """One row per class, then accuracy, macro average and weighted average."""
    per, avg = _class_columns(), _averages()
    total = avg["macro avg"]["support"]
    acc = _ratio(F.col("n00") + F.col("n11"), total)
    rows = [(label_name(F.lit(c)), per[c]) for c in LABELS]
    rows.append(
        (F.lit("accuracy"), {"precision": acc, "recall": acc, "f1_score": acc, "support": total})
    )
    rows += [(F.lit(name), cols) for name, cols in avg.items()]
    entries = F.array(
        *[
            F.struct(name.alias("entry"), *[c.alias(m) for m, c in cols.items()])
            for name, cols in rows
        ]
    )
    return confusion_counts(scored, actual, predicted).select(F.inline(entries))


def roc_auc(scored: DataFrame, actual: str = "actual", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve; null with one class only.

    Equal scores are merged first and stored, so the rows are scored once. The count of negatives
    below each score comes from running sums over ranges whose number follows the scores, so nearly
    distinct scores do not meet in one task.
    """
    by_score = scored.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(actual) == 1).alias("pos"), F.count_if(F.col(actual) == 0).alias("neg")
    )
    below = running_sums(stored(by_score, "scores"), "score", ["neg"])
    wins = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return below.agg(F.when(pairs > 0, wins / pairs).alias("auc"))


def evaluation(scored: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Accuracy and weighted scores with the four matrix cells, in one row."""
    row = _averages()["weighted avg"]
    total = row["support"]
    return confusion_counts(scored, actual, predicted).select(
        _ratio(F.col("n00") + F.col("n11"), total).alias("accuracy"),
        row["precision"].alias("precision"),
        row["recall"].alias("recall"),
        row["f1_score"].alias("f1_score"),
        "n00",
        "n01",
        "n10",
        "n11",
    )
