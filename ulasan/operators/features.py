"""Text to vectors, feature scores, feature selection and a two-dimensional projection."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, PCA, HashingTF, Normalizer, RegexTokenizer, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ulasan.operators.ranking import beside
from ulasan.operators.sampling import random_sample
from ulasan.session import stored


def fit_and_encode(df: DataFrame, dim: int = 768, col: str = "review_clean") -> tuple[PipelineModel, DataFrame]:
    """Hashed TF-IDF of unit length, the default text encoder, and `df` encoded by it as `features`.

    Texts are cut into tokens once: the counts are stored with the rows of `df`, and weights, training and
    index read those.
    """
    tokens = RegexTokenizer(inputCol=col, outputCol="tokens", pattern=" ", minTokenLength=1)
    counts = HashingTF(inputCol="tokens", outputCol="tf", numFeatures=dim)
    counted = stored(counts.transform(tokens.transform(df)).drop("tokens"), "token-counts")
    if counted.isEmpty():
        raise ValueError("no rows to encode")
    weights = IDF(inputCol="tf", outputCol="tfidf").fit(counted)
    unit = Normalizer(inputCol="tfidf", outputCol="features", p=2.0)
    model = PipelineModel(stages=[tokens, counts, weights, unit])
    return model, unit.transform(weights.transform(counted)).drop("tf", "tfidf")


def fit_text_encoder(df: DataFrame, dim: int = 768, col: str = "review_clean") -> PipelineModel:
    return fit_and_encode(df.select(col), dim, col)[0]


def encode(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds the unit vector `features`; the working columns are dropped."""
    return model.transform(df).drop("tokens", "tf", "tfidf")


def to_array(df: DataFrame, features: str = "features", out: str = "embedding") -> DataFrame:
    return df.withColumn(out, vector_to_array(features, "float32")).drop(features)


def to_vector(df: DataFrame, col: str = "embedding", out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(col).cast("array<double>")))


def encode_with(
    df: DataFrame,
    load: Callable[[], Callable[[list[str]], list]],
    col: str = "review_clean",
    out: str = "embedding",
    batch_size: int = 128,
) -> DataFrame:
    """Encode with a user's model: `load()` runs once per task and returns texts -> vectors."""

    place, names = df.columns.index(col), [*df.columns, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        for whole in batches:
            for at in range(0, whole.num_rows, batch_size):
                b = whole.slice(at, batch_size)
                vecs = np.asarray(model(b.column(place).to_pylist()), np.float32).reshape(b.num_rows, -1)
                ends = (np.arange(b.num_rows + 1) * vecs.shape[1]).astype(np.int32)
                made = pa.ListArray.from_arrays(pa.array(ends), pa.array(vecs.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*b.columns, made], names)

    schema = df.withColumn(out, F.lit(None).cast("array<float>")).schema
    return df.mapInArrow(run, schema)


def f_scores(df: DataFrame, features: str = "features", label: str = "sentimen") -> DataFrame:
    """ANOVA F of every feature: `feature, f_score`, null where it is undefined.

    Each task folds its rows into one mean and variance vector per class; what follows is as small
    as classes times features.
    """
    per_class = df.groupBy(F.col(label).alias("cls")).agg(
        F.count("*").alias("n"),
        Summarizer.metrics("mean", "variance").summary(F.col(features)).alias("m"),
    )
    cells = per_class.select(
        "n",
        F.posexplode(
            F.arrays_zip(
                vector_to_array("m.mean").alias("mean"), vector_to_array("m.variance").alias("var")
            )
        ).alias("feature", "c"),
    ).select("feature", "n", "c.mean", "c.var")
    grand = cells.groupBy("feature").agg(
        F.sum("n").alias("total"),
        F.count("*").alias("classes"),
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("center"),
    )
    shift = F.col("mean") - F.col("center")
    sums = cells.join(grand, "feature").groupBy("feature", "total", "classes").agg(
        F.sum(F.col("n") * shift * shift).alias("between"),
        F.sum((F.col("n") - 1) * F.col("var")).alias("within"),
    )
    df_between, df_within = F.col("classes") - 1, F.col("total") - F.col("classes")
    ratio = (F.col("between") / df_between) / (F.col("within") / df_within)
    defined = (df_between > 0) & (df_within > 0)
    score = (
        F.when(defined & (F.col("within") > 0), ratio)
        .when(defined & (F.col("between") > 0), F.lit(float("inf")))
    )
    return sums.select("feature", score.alias("f_score"))


def select_k_best(scores: DataFrame, k: int | None) -> DataFrame:
    """The `k` features of largest F, undefined scores last, ties to the lower index.

    `k=None` keeps every feature.
    """
    ranked = scores.orderBy(F.col("f_score").desc_nulls_last(), "feature")
    return ranked.limit(k) if k else ranked


def selected_indices(scores: DataFrame, k: int | None) -> list[int]:
    """Feature indices in their own order; at most one number per feature."""
    return sorted(r["feature"] for r in select_k_best(scores, k).select("feature").collect())


def selection_report(scores: DataFrame, k: int | None) -> DataFrame:
    """Dimensions before and after, percent removed, and the smallest selected F."""
    before = scores.agg(F.count("*").alias("n_before"))
    after = select_k_best(scores, k).agg(
        F.count("*").alias("n_after"), F.min("f_score").alias("f_threshold")
    )
    return beside(before, after).select(
        "n_before",
        "n_after",
        ((F.col("n_before") - F.col("n_after")) * 100.0 / F.col("n_before")).alias("pct_removed"),
        "f_threshold",
    )


def project_2d(
    df: DataFrame, n: int = 1000, key: str = "row_id", features: str = "features", seed: int = 42
) -> tuple[DataFrame, list[float]]:
    """Centred first two principal components of a sample, and their explained-variance ratios."""
    sample = random_sample(df, n, key, seed)
    center = StandardScaler(withMean=True, withStd=False, inputCol=features, outputCol="_centered")
    model = Pipeline(
        stages=[center, PCA(k=2, inputCol="_centered", outputCol="_pc")]
    ).fit(sample)
    points = model.transform(sample).withColumn("_pc", vector_to_array("_pc"))
    rest = [c for c in df.columns if c != features]
    out = points.select(*rest, F.col("_pc")[0].alias("pc1"), F.col("_pc")[1].alias("pc2"))
    return out, [float(x) for x in model.stages[1].explainedVariance]
