"""Encoding, selection, training, scoring and streaming.

Where the result itself cannot be stated in SQL, the query returns facts about it that can: that
coefficients meet the optimality conditions, or that a loaded model repeats the saved one.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ulasan.functions import text as tx
from ulasan.functions.vector import l2_norm
from ulasan.operators import features as ft
from ulasan.operators import models as md
from ulasan.operators import prepare as prep
from ulasan.plans import jobs
from ulasan.plans import sqltext as s
from ulasan.plans.catalog import query, rounded
from ulasan.plans.queries_profile import WITH
from ulasan.session import scratch_path
from ulasan.settings import TrainParams
from ulasan.sources import stores
from ulasan.sources import tables as src
from ulasan.streaming import scoring as st

_RUNS: dict[tuple[str, str], jobs.TrainedRun] = {}


def trained(spark, sf) -> jobs.TrainedRun:
    """One training run per session and data folder, shared by the queries that score with it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _RUNS:
        _RUNS[key] = jobs.train_job(src.reviews(spark, sf).drop("toxic"), with_cv=False)
    return _RUNS[key]


def points(spark, sf):
    """The vector table as `(row_id, sentimen, features)`."""
    vecs = src.vectors(spark, sf).withColumnRenamed("vec_id", "row_id")
    return ft.to_vector(vecs).select("row_id", "sentimen", "features")


def documents(spark, sf):
    return src.table(spark, sf, "documents", "doc_id").select(
        F.col("doc_id").alias("row_index"), F.col("text").alias("review")
    )


CLEANED = f"WITH c AS (SELECT doc_id, {s.clean_full('text')} AS t FROM documents) "


# --- encoding -------------------------------------------------------------------


@query("m1_text_vectors", CLEANED + f"SELECT doc_id, {s.words('t')} AS n_tokens, {s.words('t')} > 0 AS is_unit FROM c")
def m1(spark, sf):
    docs = prep.with_clean(src.table(spark, sf, "documents", "doc_id").select("doc_id", "text"), source="text")
    model = ft.fit_text_encoder(docs)
    out = model.transform(docs)
    n_tokens = F.aggregate(vector_to_array("tf"), F.lit(0.0), lambda a, x: a + x)
    norm = l2_norm(vector_to_array("features"))
    return out.select(
        "doc_id", n_tokens.cast("long").alias("n_tokens"), (F.abs(norm - 1) < 1e-9).alias("is_unit")
    )


VOWELS = "aeiou"


def _load_vowel_counter():
    def encode(texts):
        return [[t.count(v) for v in VOWELS] for t in texts]

    return encode


@query(
    "m1_user_encoder",
    CLEANED + "SELECT doc_id, pos, CAST(length(t) - length(replace(t, substring('aeiou', CAST(pos + 1 AS INTEGER), 1), '')) "
    "AS DOUBLE) AS x FROM c, (SELECT range AS pos FROM range(5)) p",
)
def m1_user(spark, sf):
    """A user's encoder, loaded once per task; here it counts vowels."""
    docs = prep.with_clean(src.table(spark, sf, "documents", "doc_id").select("doc_id", "text"), source="text")
    vecs = ft.encode_with(docs.select("doc_id", "review_clean"), _load_vowel_counter)
    return rounded(vecs.select("doc_id", F.posexplode("embedding").alias("pos", "x")))


# --- selection --------------------------------------------------------------------

SCORES = (
    "WITH x AS (SELECT vec_id, CAST(label >= 5 AS INTEGER) AS c, unnest(range(len(embedding))) AS feature, "
    "unnest(embedding::DOUBLE[]) AS v FROM embeddings), "
    "g AS (SELECT feature, c, count(*) AS n, avg(v) AS m, coalesce(var_samp(v), 0) AS s FROM x GROUP BY 1, 2), "
    "t AS (SELECT feature, sum(n) AS total, count(*) AS k, sum(n * m) / sum(n) AS gm FROM g GROUP BY 1), "
    "f AS (SELECT feature, (sum(n * (m - gm) * (m - gm)) / (any_value(k) - 1)) / "
    "(sum((n - 1) * s) / (any_value(total) - any_value(k))) AS f_score FROM g JOIN t USING (feature) GROUP BY 1), "
    "r AS (SELECT *, row_number() OVER (ORDER BY f_score DESC NULLS LAST, feature) AS rn FROM f) "
)


@query("m3_f_scores", SCORES + f"SELECT feature, {s.r6('f_score')} AS f_score FROM f")
def m3(spark, sf):
    return rounded(ft.f_scores(points(spark, sf)))


@query("m4_select_k_best", SCORES + f"SELECT feature, {s.r6('f_score')} AS f_score FROM r WHERE rn <= 20")
def m4(spark, sf):
    return rounded(ft.select_k_best(ft.f_scores(points(spark, sf)), 20))


@query(
    "m5_selection_report",
    SCORES
    + "SELECT (SELECT count(*) FROM f) AS n_before, count(*) AS n_after, "
    + s.r6("((SELECT count(*) FROM f) - count(*)) * 100.0 / (SELECT count(*) FROM f)")
    + f" AS pct_removed, {s.r6('min(f_score)')} AS f_threshold FROM r WHERE rn <= 20",
)
def m5(spark, sf):
    return rounded(ft.selection_report(ft.f_scores(points(spark, sf)), 20))


# --- classifiers --------------------------------------------------------------------


def _fit(spark, sf, **params):
    data = points(spark, sf).withColumnRenamed("features", "selected")
    model = md.make_classifier(TrainParams(**params), data.count()).fit(data)
    return model, data


@query("m6_logistic_regression")
def m6(spark, sf):
    model, data = _fit(spark, sf)
    p = vector_to_array("probability")
    return model.transform(data).select("row_id", F.col("prediction").cast("int"), p[1].alias("positive"))


@query(
    "m6_logistic_optimality",
    "SELECT pos AS feature, TRUE AS is_flat FROM (SELECT DISTINCT unnest(range(len(embedding))) AS pos FROM embeddings) "
    "UNION ALL SELECT -1, TRUE",
)
def m6_optimality(spark, sf):
    """The gradient of mean log loss plus `|w|^2 / (2 C n)` vanishes in every coefficient.

    Feature -1 is the intercept, which has no penalty.
    """
    model, data = _fit(spark, sf)
    n = data.count()
    out = model.transform(data)
    miss = vector_to_array("probability")[1] - F.col("sentimen")
    x = F.posexplode(vector_to_array("selected")).alias("feature", "x")
    slopes = out.select(miss.alias("miss"), x).groupBy("feature").agg((F.sum(F.col("miss") * F.col("x")) / n).alias("g"))
    weights = spark.createDataFrame(
        [(i, float(w)) for i, w in enumerate(model.coefficients)], "feature int, w double"
    )
    slopes = slopes.join(weights, "feature").select("feature", (F.col("g") + F.col("w") / n).alias("g"))
    base = out.agg(F.avg(miss).alias("g")).select(F.lit(-1).alias("feature"), "g")
    return slopes.unionByName(base).select(
        F.col("feature").cast("long").alias("feature"), (F.abs("g") < 1e-4).alias("is_flat")
    )


@query("m7_linear_svm")
def m7(spark, sf):
    data = points(spark, sf)
    run = md.train(data, TrainParams(model_type="svm", k_features=20), with_cv=False)
    return md.predict(run.model, data).select("row_id", "prediction", "sentiment", "confidence")


@query(
    "m7_m8_names_follow_labels",
    "SELECT vec_id AS row_id, TRUE AS svm_is_valid, TRUE AS forest_is_valid FROM embeddings",
)
def m7_m8(spark, sf):
    """A linear SVM gives labels without confidence; a forest gives both."""
    data = points(spark, sf)
    named = F.col("sentiment") == tx.label_name(F.col("prediction"))
    svm = md.train(data, TrainParams(model_type="svm", k_features=20), with_cv=False)
    forest = md.train(
        data, TrainParams(model_type="random_forest", params={"n_estimators": 10}, k_features=20), with_cv=False
    )
    a = md.predict(svm.model, data).select(
        "row_id", (named & F.col("confidence").isNull()).alias("svm_is_valid")
    )
    b = md.predict(forest.model, data).select(
        "row_id", (named & (F.col("confidence") >= 0.5)).alias("forest_is_valid")
    )
    return a.join(b, "row_id")


@query("m8_random_forest")
def m8(spark, sf):
    data = points(spark, sf)
    params = TrainParams(model_type="random_forest", params={"n_estimators": 20}, k_features=20)
    run = md.train(data, params, with_cv=False)
    return md.predict(run.model, data).select("row_id", "prediction", "sentiment", "confidence")


@query("m9_unknown_model_falls_back", "SELECT count(*) AS n_rows, count(*) AS n_same FROM embeddings")
def m9(spark, sf):
    model, data = _fit(spark, sf)
    other, _ = _fit(spark, sf, model_type="boosted")
    a = model.transform(data).select("row_id", F.col("prediction").alias("a"))
    b = other.transform(data).select("row_id", F.col("prediction").alias("b"))
    return a.join(b, "row_id").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("a") == F.col("b")).alias("n_same")
    )


@query("m10_cross_validation")
def m10(spark, sf):
    data = points(spark, sf).withColumnRenamed("features", "selected")
    return md.cross_validate(data)


@query(
    "m10_cross_validation_sizes",
    "SELECT fold, count(*) AS n_test, TRUE AS is_share FROM (SELECT CASE WHEN rn <= (n + 2) // 3 THEN 0 "
    "WHEN rn <= (2 * n + 2) // 3 THEN 1 ELSE 2 END AS fold FROM (SELECT row_number() OVER (PARTITION BY label >= 5 "
    "ORDER BY md5(CAST(vec_id AS VARCHAR) || ':43'), vec_id) AS rn, count(*) OVER (PARTITION BY label >= 5) AS n "
    "FROM embeddings)) GROUP BY 1",
)
def m10_sizes(spark, sf):
    scores = md.cross_validate(points(spark, sf).withColumnRenamed("features", "selected"))
    return scores.select("fold", "n_test", F.col("accuracy").between(0.0, 1.0).alias("is_share"))


@query("m10_cross_validation_summary")
def m10_summary(spark, sf):
    return md.cv_summary(md.cross_validate(points(spark, sf).withColumnRenamed("features", "selected")))


@query(
    "m11_train",
    "SELECT CAST(sum(n) AS BIGINT) AS n_samples, CAST(sum(n - t) AS BIGINT) AS n_train, CAST(sum(t) AS BIGINT) AS n_test, "
    "20 AS n_selected, TRUE AS has_accuracies FROM (SELECT count(*) AS n, CAST(ceil(0.2 * count(*)) AS BIGINT) AS t "
    "FROM embeddings GROUP BY label >= 5)",
)
def m11(spark, sf):
    h = md.train(points(spark, sf), TrainParams(k_features=20)).history
    good = all(0 <= h[k] <= 1 for k in ("train_accuracy", "val_accuracy", "test_accuracy")) and len(h["cv_scores"]) == 3
    row = (h["n_samples"], h["n_train"], h["n_test"], h["n_selected"], good)
    return spark.createDataFrame(
        [row], "n_samples long, n_train long, n_test long, n_selected int, has_accuracies boolean"
    )


@query("m12_predict", "SELECT vec_id AS row_id, TRUE AS is_valid FROM embeddings")
def m12(spark, sf):
    """Probabilities add to one, confidence is the larger, and the name follows the label."""
    data = points(spark, sf)
    run = md.train(data, TrainParams(k_features=20), with_cv=False)
    out = md.predict(run.model, data)
    neg, pos = F.col("probabilities.negative"), F.col("probabilities.positive")
    valid = (
        (F.abs(neg + pos - 1) < 1e-12)
        & (F.col("confidence") == F.greatest(neg, pos))
        & ((F.col("prediction") == 1) == (pos > 0.5))
        & (F.col("sentiment") == tx.label_name(F.col("prediction")))
    )
    return out.select("row_id", valid.alias("is_valid"))


@query("m13_feature_importance")
def m13(spark, sf):
    return md.feature_importance(trained(spark, sf).classifier)


# Of each class the lowest fifth of the hash order is held out.
FITTED_ON = (
    "WITH fitted AS (SELECT vec_id, label, embedding FROM (SELECT *, row_number() OVER (PARTITION BY label >= 5 ORDER BY "
    "md5(CAST(vec_id AS VARCHAR) || ':42'), vec_id) AS nth, count(*) OVER (PARTITION BY label >= 5) AS n FROM embeddings) "
    "WHERE nth > ceil(0.2 * n)), "
)


@query(
    "m13_importance_is_weighted_f",
    FITTED_ON
    + SCORES.removeprefix("WITH ").replace("FROM embeddings", "FROM fitted")
    + f"SELECT feature, {s.r6('f_score')} AS f_score FROM r WHERE rn <= 20",
)
def m13_weighted(spark, sf):
    """The features chosen on the training rows, and their importance for each unit of coefficient: F."""
    run = md.train(points(spark, sf), TrainParams(k_features=20), with_cv=False)
    table = md.feature_importance(run, 20)
    return rounded(table.select("feature", (F.col("importance") / F.abs("coefficient")).alias("f_score")))


@query("m14_projection")
def m14(spark, sf):
    return ft.project_2d(points(spark, sf))[0]


@query(
    "m14_projection_is_centred",
    "SELECT least(count(*), 1000) AS n_points, TRUE AS is_centred, TRUE AS is_ordered FROM embeddings",
)
def m14_centred(spark, sf):
    projected, ratio = ft.project_2d(points(spark, sf))
    return projected.agg(
        F.count("*").alias("n_points"),
        ((F.abs(F.avg("pc1")) < 1e-9) & (F.abs(F.avg("pc2")) < 1e-9)).alias("is_centred"),
        (
            (F.var_pop("pc1") >= F.var_pop("pc2"))
            & (F.abs(F.corr("pc1", "pc2")) < 1e-6)
            & F.lit(ratio[0] >= ratio[1])
        ).alias("is_ordered"),
    )


HELD_OUT = (
    WITH
    + f", d AS (SELECT min(row_id) AS row_id, review, sentimen FROM reviews GROUP BY review, sentimen), "
    f"c AS (SELECT *, {s.clean_full('review')} AS t FROM d), k AS (SELECT * FROM c WHERE length(t) >= 5), "
    "held AS (SELECT sentimen, CAST(ceil(0.2 * count(*)) AS BIGINT) AS n FROM k GROUP BY 1) "
)


@query("e7_evaluate_model")
def e7_model(spark, sf):
    return md.evaluate(trained(spark, sf).classifier)


@query(
    "e7_evaluate_model_counts",
    HELD_OUT
    + "SELECT CAST(sum(n) FILTER (WHERE sentimen = 0) AS BIGINT) AS n_negative, "
    "CAST(sum(n) FILTER (WHERE sentimen = 1) AS BIGINT) AS n_positive, TRUE AS adds_up, TRUE AS has_auc FROM held",
)
def e7_counts(spark, sf):
    row = md.evaluate(trained(spark, sf).classifier)
    hits = (F.col("n00") + F.col("n11")) / (F.col("n00") + F.col("n01") + F.col("n10") + F.col("n11"))
    return row.select(
        (F.col("n00") + F.col("n01")).alias("n_negative"),
        (F.col("n10") + F.col("n11")).alias("n_positive"),
        (F.abs(F.col("accuracy") - hits) < 1e-12).alias("adds_up"),
        F.col("auc").between(0.0, 1.0).alias("has_auc"),
    )


# --- saved models -----------------------------------------------------------------

def _agreement(a, b, key):
    left = a.select(key, F.col("prediction").alias("p"), F.col("confidence").alias("c"))
    right = b.select(key, F.col("prediction").alias("q"), F.col("confidence").alias("d"))
    same = (F.col("p") == F.col("q")) & (F.abs(F.col("c") - F.col("d")) < 1e-12)
    return left.join(right, key).agg(F.count("*").alias("n_rows"), F.count_if(same).alias("n_same"))


@query("s10_save_classifier", HELD_OUT + "SELECT CAST(sum(n) AS BIGINT) AS n_held_out, 500 AS n_selected, 768 AS n_scores FROM held")
def s10(spark, sf):
    path = scratch_path(spark, "classifier")
    stores.save_classifier(trained(spark, sf).classifier, path)
    loaded = stores.load_classifier(spark, path)
    n_scores = loaded.scores.agg(F.count("*")).scalar()
    return loaded.test.agg(
        F.count("*").alias("n_held_out"),
        F.lit(len(loaded.selected)).alias("n_selected"),
        n_scores.cast("int").alias("n_scores"),
    )


@query(
    "s11_load_classifier",
    HELD_OUT + "SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n) AS BIGINT) AS n_same FROM held",
)
def s11(spark, sf):
    run, path = trained(spark, sf).classifier, scratch_path(spark, "classifier")
    stores.save_classifier(run, path)
    loaded = stores.load_classifier(spark, path)
    return _agreement(md.predict(run.model, run.test), md.predict(loaded.model, loaded.test), "row_id")


SCORABLE = CLEANED + ", k AS (SELECT * FROM c WHERE length(t) >= 3) "


def _saved_run(spark, sf):
    path = scratch_path(spark, "run")
    jobs.save_run(trained(spark, sf), path)
    return jobs.load_run(spark, path)


@query("s12_save_run", HELD_OUT + "SELECT count(*) AS n_rows, 768 AS dim, count(*) AS n_vectors, TRUE AS same_rules FROM k")
def s12(spark, sf):
    run = _saved_run(spark, sf)
    return run.index.agg(
        F.lit(run.n_rows).cast("long").alias("n_rows"),
        F.lit(run.dim).alias("dim"),
        F.count("*").alias("n_vectors"),
        F.lit(run.rules == trained(spark, sf).rules).alias("same_rules"),
    )


@query("s13_load_run", SCORABLE + "SELECT count(*) AS n_rows, count(*) AS n_same FROM k")
def s13(spark, sf):
    docs = documents(spark, sf)
    before = jobs.score(trained(spark, sf), docs)[0]
    after = jobs.score(_saved_run(spark, sf), docs)[0]
    return _agreement(before, after, "row_index")


# --- jobs ---------------------------------------------------------------------------


@query("q1_train_job", HELD_OUT + "SELECT count(*) AS dataset_size, 768 AS embedding_dim, 500 AS n_selected, TRUE AS index_built FROM k")
def q1(spark, sf):
    run = jobs.train_job(src.reviews(spark, sf).drop("toxic"))
    return jobs.run_info(spark, run).select("dataset_size", "embedding_dim", "n_selected", "index_built")


@query("q2_score_one_text")
def q2(spark, sf):
    """The longest document as a single text."""
    row = documents(spark, sf).orderBy(F.length("review").desc(), "row_index").limit(1)
    return jobs.score(trained(spark, sf), row)[0]


@query(
    "q2_score_longest_text",
    CLEANED
    + "SELECT doc_id AS row_index, c.t AS review_clean, TRUE AS is_named FROM c JOIN documents d USING (doc_id) "
    "ORDER BY length(d.text) DESC, doc_id LIMIT 1",
)
def q2_longest(spark, sf):
    return q2(spark, sf).select(
        "row_index", "review_clean", F.col("sentiment").isin("Negative", "Positive").alias("is_named")
    )


@query("q3_score_file", SCORABLE + "SELECT doc_id AS row_index, t AS review_clean FROM k")
def q3(spark, sf):
    scored, _ = jobs.score(trained(spark, sf), documents(spark, sf))
    return scored.select("row_index", "review_clean").filter(F.col("confidence") >= 0.5)


@query("q3_scores")
def q3_scores(spark, sf):
    scored, _ = jobs.score(trained(spark, sf), documents(spark, sf))
    return stores.prediction_rows(scored)


@query(
    "q3_rejects",
    "WITH t AS (SELECT doc_id AS row_index, CASE WHEN length(text) < 300 THEN lang WHEN length(text) < 400 THEN NULL "
    f"ELSE text END AS review FROM documents), c AS (SELECT *, {s.clean_full('review')} AS t FROM t) "
    f"SELECT row_index, review, CASE WHEN NOT {s.filled('review')} THEN 'blank' ELSE 'too_short' END AS reject_reason "
    f"FROM c WHERE NOT {s.filled('review')} OR length(t) < 3",
)
def q3_rejects(spark, sf):
    n = F.length("text")
    rows = src.table(spark, sf, "documents", "doc_id").select(
        F.col("doc_id").alias("row_index"),
        F.when(n < 300, F.col("lang")).when(n < 400, None).otherwise(F.col("text")).alias("review"),
    )
    return jobs.score(trained(spark, sf), rows)[1]


@query("q4_score_with_neighbours", SCORABLE + "SELECT doc_id AS row_index, 2 AS n_similar, TRUE AS in_order FROM k")
def q4(spark, sf):
    out = jobs.score_with_neighbours(trained(spark, sf), documents(spark, sf), 2)
    hits = F.col("similar_reviews")
    ordered = (hits[0]["rank"] == 1) & (hits[0]["similarity"] >= hits[1]["similarity"])
    return out.select("row_index", F.size(hits).alias("n_similar"), ordered.alias("in_order"))


@query(
    "v4_text_search",
    HELD_OUT + "SELECT row_id AS query_id, TRUE AS found_itself FROM k",
)
def v4(spark, sf):
    """Every review of the index as a query: the best hit has its own cleaned text or the same score."""
    run = trained(spark, sf)
    queries = run.index.select(F.col("vec_id").alias("query_id"), "review")
    own = run.index.select(F.col("vec_id").alias("query_id"), F.col("review_clean").alias("own"))
    hits = jobs.search_texts(run, queries, 1).join(own, "query_id")
    same = (F.col("clean_text") == F.col("own")) | (F.abs(F.col("similarity") - 1) < 1e-6)
    return hits.select("query_id", same.alias("found_itself"))


@query(
    "a19_run_info_sizes",
    HELD_OUT
    + "SELECT TRUE AS is_trained, (SELECT count(*) FROM k) AS dataset_size, 768 AS embedding_dim, 500 AS n_selected, "
    "TRUE AS index_built, 'logistic_regression' AS model_type",
)
def a19_sizes(spark, sf):
    info = jobs.run_info(spark, trained(spark, sf))
    return info.select("is_trained", "dataset_size", "embedding_dim", "n_selected", "index_built", "model_type")


@query("a19_run_info")
def a19(spark, sf):
    return jobs.run_info(spark, trained(spark, sf))


# --- streaming ------------------------------------------------------------------------


def _document_stream(spark, sf):
    schema = src.table(spark, sf, "documents").schema
    cores = spark.sparkContext.defaultParallelism
    docs = st.read_dataset(spark, f"{sf}/documents.parquet", schema, spread_to=cores)
    return docs.select(F.col("doc_id").alias("row_index"), F.col("text").alias("review"))


@query("st1_stream_clean", SCORABLE + "SELECT doc_id AS row_index, t AS review_clean FROM k")
def st1_clean(spark, sf):
    out = scratch_path(spark, "stream")
    cleaned = st.clean_stream(_document_stream(spark, sf)).select("row_index", "review_clean")
    st.write_stream(cleaned, out, scratch_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(out)


@query("st1_stream_score", SCORABLE + "SELECT count(*) AS n_rows, count(*) AS n_same FROM k")
def st1_score(spark, sf):
    run, out = trained(spark, sf), scratch_path(spark, "stream")
    scored = st.score_stream(run, _document_stream(spark, sf))
    st.write_stream(scored, out, scratch_path(spark, "progress")).awaitTermination()
    batch, _ = jobs.score(run, documents(spark, sf))
    return _agreement(spark.read.parquet(out), batch, "row_index")
