"""Profiles, samples, splits and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ulasan.functions import text as tx
from ulasan.operators import metrics
from ulasan.operators import prepare as prep
from ulasan.operators import profile as pf
from ulasan.operators import sampling as sm
from ulasan.plans import sqltext as s
from ulasan.plans.catalog import query, rounded
from ulasan.plans.queries_text import SCORED, WITH_MIXED, mixed, scored
from ulasan.sources.tables import reviews, table

WITH = f"WITH {s.REVIEWS} "
LENGTHS = (
    f"WITH {s.REVIEWS}, lengths AS (SELECT row_id, sentimen, length(review) AS review_length, "
    f"{s.words('review')} AS review_word_count FROM reviews) "
)


def lengths(spark, sf):
    t = F.col("review")
    return reviews(spark, sf).select(
        "row_id",
        "sentimen",
        tx.char_length(t).alias("review_length"),
        tx.word_count(t).alias("review_word_count"),
    )


@query(
    "a1_dataset_info",
    WITH_MIXED
    + f"""SELECT CAST(m.sentimen AS VARCHAR) AS label,
    CASE WHEN m.sentimen = '1' THEN 'Positive' ELSE 'Negative' END AS label_name, count(*) AS n,
    {s.r6('count(*) * 100.0 / any_value(t.n_rows)')} AS pct, any_value(t.n_rows) AS n_rows,
    any_value(t.n_missing) AS n_missing, {s.r6('any_value(t.mean_length)')} AS mean_length,
    {s.r6('any_value(t.median_length)')} AS median_length, any_value(t.min_length) AS min_length,
    any_value(t.max_length) AS max_length
    FROM mixed m, (SELECT count(*) AS n_rows, CAST(sum(CAST(review IS NULL AS INT) + CAST(translate IS NULL AS INT))
        AS BIGINT) AS n_missing, avg(length(review)) AS mean_length, median(length(review)) AS median_length,
        min(length(review)) AS min_length, max(length(review)) AS max_length FROM mixed) t
    WHERE m.sentimen IN ('0', '1') GROUP BY m.sentimen""",
)
def a1(spark, sf):
    info = pf.dataset_info(mixed(spark, sf)).filter(F.col("label").isin("0", "1"))
    name = F.when(F.col("label") == "1", "Positive").otherwise("Negative")
    return rounded(info.withColumn("label_name", name))


@query(
    "a2_dataset_statistics",
    WITH_MIXED
    + f"""SELECT metric, item, {s.r6('CAST(value AS DOUBLE)')} AS value FROM (
    SELECT 'total_samples' AS metric, '' AS item, CAST(count(*) AS DOUBLE) AS value FROM mixed
    UNION ALL SELECT 'columns', '', 4
    UNION ALL SELECT 'missing_values', 'row_id', count(*) FILTER (WHERE row_id IS NULL) FROM mixed
    UNION ALL SELECT 'missing_values', 'review', count(*) FILTER (WHERE review IS NULL) FROM mixed
    UNION ALL SELECT 'missing_values', 'sentimen', count(*) FILTER (WHERE sentimen IS NULL) FROM mixed
    UNION ALL SELECT 'missing_values', 'translate', count(*) FILTER (WHERE translate IS NULL) FROM mixed
    UNION ALL SELECT 'label_count', sentimen, count(*) FROM mixed GROUP BY sentimen
    UNION ALL SELECT 'text', 'mean_length', avg(length(review)) FROM mixed
    UNION ALL SELECT 'text', 'median_length', median(length(review)) FROM mixed
    UNION ALL SELECT 'text', 'min_length', min(length(review)) FROM mixed
    UNION ALL SELECT 'text', 'max_length', max(length(review)) FROM mixed)""",
)
def a2(spark, sf):
    return rounded(pf.dataset_statistics(mixed(spark, sf)))


def _text_statistics_sql(text: str, source: str) -> str:
    used, n_words = f"FILTER (WHERE {text} <> '')", s.words(text)
    return f"""SELECT count(*) AS total_texts, count(*) FILTER (WHERE NOT {s.filled(text)}) AS empty_texts,
    {s.r6(f"coalesce(avg(length({text})) {used}, 0)")} AS avg_length,
    {s.r6(f"coalesce(median(length({text})) {used}, 0)")} AS median_length,
    coalesce(min(length({text})) {used}, 0) AS min_length, coalesce(max(length({text})) {used}, 0) AS max_length,
    {s.r6(f"coalesce(avg({n_words}) {used}, 0)")} AS avg_words,
    {s.r6(f"coalesce(median({n_words}) {used}, 0)")} AS median_words FROM {source}"""


@query("a3_text_statistics", WITH_MIXED + _text_statistics_sql("review", "mixed"))
def a3(spark, sf):
    return rounded(pf.text_statistics(mixed(spark, sf)))


@query("a3_text_statistics_documents", _text_statistics_sql("text", "documents"))
def a3_documents(spark, sf):
    return rounded(pf.text_statistics(table(spark, sf, "documents", "doc_id").select("text"), "text"))


@query(
    "a4_value_counts", WITH_MIXED + "SELECT sentimen, count(*) AS n FROM mixed WHERE sentimen IS NOT NULL GROUP BY 1"
)
def a4(spark, sf):
    return pf.value_counts(mixed(spark, sf), "sentimen")


@query(
    "a5_value_shares",
    WITH_MIXED
    + f"""SELECT length(review) > 1000 AS is_long, count(*) AS n,
    {s.r6('count(*) * 100.0 / any_value(known)')} AS pct_known, {s.r6('count(*) * 100.0 / any_value(total)')} AS pct_all
    FROM mixed, (SELECT count(review) AS known, count(*) AS total FROM mixed)
    WHERE review IS NOT NULL GROUP BY 1""",
)
def a5(spark, sf):
    flag = mixed(spark, sf).select((F.length("review") > 1000).alias("is_long"))
    known = pf.value_shares(flag, "is_long").withColumnRenamed("pct", "pct_known")
    total = pf.value_shares(flag, "is_long", over_all_rows=True).drop("n")
    return rounded(known.join(total.withColumnRenamed("pct", "pct_all"), "is_long"))


@query(
    "a6_class_balance",
    WITH
    + f"""SELECT min(n) AS smallest_class, max(n) AS largest_class, {s.r6('min(n) / max(n)')} AS balance_ratio,
    min(n) / max(n) < 0.8 AS is_imbalanced
    FROM (SELECT sentimen, count(*) AS n FROM reviews GROUP BY 1)""",
)
def a6(spark, sf):
    return rounded(pf.class_balance(reviews(spark, sf)))


@query(
    "a7_missing_values",
    WITH_MIXED
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_missing FROM mixed"
        for c in ("row_id", "review", "sentimen", "translate")
    ),
)
def a7(spark, sf):
    return pf.missing_values(mixed(spark, sf))


def _describe_sql(col: str, source: str) -> str:
    q = ", ".join(f"{s.r6(f'quantile_cont({col}, {p})')} AS p{int(p * 100)}" for p in (0.25, 0.5, 0.75))
    return (
        f"SELECT '{col}' AS column_name, count({col}) AS count, {s.r6(f'avg({col})')} AS mean, "
        f"{s.r6(f'stddev_samp({col})')} AS std, {s.r6(f'min({col})::DOUBLE')} AS min, {q}, "
        f"{s.r6(f'max({col})::DOUBLE')} AS max FROM {source}"
    )


@query(
    "a8_describe_numeric",
    LENGTHS + " UNION ALL ".join(_describe_sql(c, "lengths") for c in ("review_length", "review_word_count", "sentimen")),
)
def a8(spark, sf):
    cols = ["review_length", "review_word_count", "sentimen"]
    return rounded(pf.describe_numeric(lengths(spark, sf), cols))


@query("a8_describe_double", " UNION ALL ".join(_describe_sql(c, "lineitem") for c in ("l_extendedprice", "l_quantity")))
def a8_double(spark, sf):
    return rounded(pf.describe_numeric(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"]))


def _top(col: str, source: str) -> str:
    return (
        f"SELECT '{col}' AS column_name, sum(n)::BIGINT AS count, count(*) AS \"unique\", "
        f"first(v ORDER BY n DESC, v) AS top, max(n) AS freq FROM (SELECT {col} AS v, count(*) AS n FROM {source} "
        f"WHERE {col} IS NOT NULL GROUP BY 1)"
    )


@query("a9_describe_text", _top("text", "documents") + " UNION ALL " + _top("lang", "documents"))
def a9(spark, sf):
    docs = table(spark, sf, "documents")
    return pf.describe_text(docs, "text").unionByName(pf.describe_text(docs, "lang"))


@query(
    "a10_lengths_by_label",
    LENGTHS
    + f"""SELECT sentimen, count(*) AS n, min(review_length) AS min,
    {s.r6('quantile_cont(review_length, 0.25)')} AS q1, {s.r6('median(review_length)')} AS median,
    {s.r6('quantile_cont(review_length, 0.75)')} AS q3, max(review_length) AS max FROM lengths GROUP BY 1""",
)
def a10(spark, sf):
    out = pf.quartiles_by_label(lengths(spark, sf), "review_length")
    return rounded(out).withColumn("sentimen", F.col("sentimen").cast("int"))


def _histogram_sql(source: str, col: str, bins: int, by: str | None = None) -> str:
    grp = by or "'all'"
    return f""", v AS (SELECT {grp} AS g, CAST({col} AS DOUBLE) AS x FROM {source} WHERE {col} IS NOT NULL),
    e AS (SELECT g, CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
        CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM v GROUP BY g),
    w AS (SELECT *, (hi - lo) / {bins} AS width FROM e),
    c AS (SELECT v.g, CAST(least(floor((x - lo) / width), {bins - 1}) AS BIGINT) AS bin, count(*) AS n
        FROM v JOIN w ON v.g = w.g GROUP BY 1, 2)
    SELECT {f'w.g AS {by},' if by else ''} b.bin, {s.r6('lo + b.bin * width')} AS bin_start,
        {s.r6('lo + (b.bin + 1) * width')} AS bin_end, coalesce(c.n, 0) AS n
    FROM w CROSS JOIN (SELECT range AS bin FROM range({bins})) b LEFT JOIN c ON c.g = w.g AND c.bin = b.bin"""


@query("a11_histogram", LENGTHS + _histogram_sql("lengths", "review_length", 50))
def a11(spark, sf):
    return rounded(pf.histogram(lengths(spark, sf), "review_length", 50))


@query("a11_histogram_by_label", LENGTHS + _histogram_sql("lengths", "review_word_count", 30, "sentimen"))
def a11_label(spark, sf):
    out = rounded(pf.histogram(lengths(spark, sf), "review_word_count", 30, "sentimen"))
    return out.withColumn("sentimen", F.col("sentimen").cast("int"))


@query("a11_histogram_double", "WITH one AS (SELECT 1)" + _histogram_sql("lineitem", "l_extendedprice", 50))
def a11_double(spark, sf):
    return rounded(pf.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 50))


VALUES = (
    "WITH x AS (SELECT vec_id, unnest(embedding::DOUBLE[]) AS x FROM embeddings), "
    "rows AS (SELECT vec_id, count(*) AS d, avg(x) AS m, stddev_pop(x) AS sd, sqrt(sum(x * x)) AS norm FROM x GROUP BY 1) "
)


@query(
    "a12_embedding_statistics",
    VALUES
    + f"""SELECT (SELECT count(*) FROM rows) AS n_vectors, (SELECT max(d) FROM rows) AS dimension,
    {s.r6('avg(x)')} AS mean, {s.r6('stddev_pop(x)')} AS std, {s.r6('min(x)')} AS min, {s.r6('max(x)')} AS max,
    (SELECT {s.r6('avg(norm)')} FROM rows) AS norm_mean, (SELECT {s.r6('stddev_pop(norm)')} FROM rows) AS norm_std
    FROM x""",
)
def a12(spark, sf):
    return rounded(pf.embedding_statistics(table(spark, sf, "embeddings")))


@query("a13_embedding_rows", VALUES + f"SELECT vec_id, {s.r6('m')} AS row_mean, {s.r6('sd')} AS row_std FROM rows")
def a13(spark, sf):
    return rounded(pf.embedding_row_statistics(table(spark, sf, "embeddings")))


@query("a13_embedding_rows_histogram", VALUES + _histogram_sql("rows", "round(sd, 9)", 50))
def a13_histogram(spark, sf):
    rows = pf.embedding_row_statistics(table(spark, sf, "embeddings"))
    return rounded(pf.histogram(rows.withColumn("row_std", F.round("row_std", 9)), "row_std", 50))


# --- scored rows --------------------------------------------------------------

BATCH = (
    f"WITH {SCORED}, batch AS (SELECT s.doc_id AS row_index, d.text, "
    "CASE WHEN predicted = 1 THEN 'Positive' ELSE 'Negative' END AS sentiment, confidence "
    "FROM scored s JOIN documents d USING (doc_id)) "
)


def batch(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return scored(spark, sf).join(docs, "doc_id").select(
        F.col("doc_id").alias("row_index"),
        "text",
        tx.label_name(F.col("predicted")).alias("sentiment"),
        "confidence",
    )


@query(
    "a15_batch_summary",
    BATCH
    + f"""SELECT count(*) AS n_rows, count(*) FILTER (WHERE sentiment = 'Positive') AS n_positive,
    count(*) FILTER (WHERE sentiment = 'Negative') AS n_negative,
    {s.r6("count(*) FILTER (WHERE sentiment = 'Positive') * 100.0 / count(*)")} AS pct_positive,
    {s.r6("count(*) FILTER (WHERE sentiment = 'Negative') * 100.0 / count(*)")} AS pct_negative,
    {s.r6('avg(confidence)')} AS avg_confidence, count(*) FILTER (WHERE confidence < 0.6) AS n_low_confidence
    FROM batch""",
)
def a15(spark, sf):
    return rounded(pf.batch_summary(batch(spark, sf), 0.6))


@query(
    "a15_batch_first_rows",
    BATCH
    + f"""SELECT row_index, CASE WHEN length(text) > 80 THEN substring(text, 1, 80) || '...' ELSE text END
    AS text_preview, sentiment, {s.r6('confidence')} AS confidence FROM batch ORDER BY row_index LIMIT 5""",
)
def a15_rows(spark, sf):
    return rounded(pf.batch_first_rows(batch(spark, sf)))


def _split_sql(source: str = "reviews", by: str | None = "sentimen", key: str = "row_id") -> str:
    return s.lowest(source, key, "ceil(0.2 * group_n)", by)


@query(
    "a16_split_distribution",
    WITH
    + f"""SELECT split, sentimen, n, {s.r6('n * 100.0 / sum(n) OVER (PARTITION BY split)')} AS pct FROM (
    SELECT CASE WHEN taken THEN 'test' ELSE 'train' END AS split, sentimen, count(*) AS n
    FROM {_split_sql()} GROUP BY 1, 2)""",
)
def a16(spark, sf):
    split = sm.train_test_split(reviews(spark, sf).select("row_id", "sentimen"))
    return rounded(pf.split_distribution(split)).withColumn("sentimen", F.col("sentimen").cast("int"))


@query(
    "a17_corpus_report",
    WITH
    + f""", c AS (SELECT *, {s.clean_full('review')} AS review_clean FROM reviews)
    SELECT count(*) AS total_reviews, count(*) FILTER (WHERE sentimen = 1) AS n_positive,
    count(*) FILTER (WHERE sentimen = 0) AS n_negative,
    {s.r6('count(*) FILTER (WHERE sentimen = 1) * 100.0 / count(*)')} AS pct_positive,
    {s.r6('count(*) FILTER (WHERE sentimen = 0) * 100.0 / count(*)')} AS pct_negative,
    {s.r6('avg(length(review_clean))')} AS avg_length, {s.r6(f"avg({s.words('review_clean')})")} AS avg_words
    FROM c""",
)
def a17(spark, sf):
    return rounded(pf.corpus_report(prep.with_clean(reviews(spark, sf, True))))


@query(
    "a20_confidence_by_outcome",
    f"""WITH {SCORED} SELECT quality = predicted AS correct, quality AS label, count(*) AS n,
    {s.r6('avg(confidence)')} AS avg_confidence, {s.r6('min(confidence)')} AS min_confidence,
    {s.r6('max(confidence)')} AS max_confidence FROM scored GROUP BY 1, 2""",
)
def a20(spark, sf):
    out = pf.confidence_by_outcome(scored(spark, sf), "quality", "predicted")
    return rounded(out).withColumn("label", F.col("label").cast("int"))


# --- samples and splits -------------------------------------------------------


@query(
    "r1_stratified_sample",
    WITH
    + "SELECT row_id, review, sentimen FROM "
    + s.lowest(
        "reviews",
        "row_id",
        "(CASE WHEN (SELECT count(*) FROM reviews) <= 120 THEN group_n ELSE "
        "least(group_n, 120 // (SELECT count(DISTINCT sentimen) FROM reviews)) END)",
        "sentimen",
    )
    + " WHERE taken",
)
def r1(spark, sf):
    return sm.stratified_sample(reviews(spark, sf), 120).select("row_id", "review", "sentimen")


@query("r2_random_sample", WITH + "SELECT row_id, sentimen FROM " + s.lowest("reviews", "row_id", "50") + " WHERE taken")
def r2(spark, sf):
    return sm.random_sample(reviews(spark, sf).select("row_id", "sentimen"), 50)


@query(
    "r3_first_per_label",
    WITH
    + "SELECT row_id, sentimen, pos FROM (SELECT *, CAST(row_number() OVER (PARTITION BY sentimen ORDER BY row_id) "
    "AS INTEGER) AS pos FROM reviews) WHERE pos <= 3",
)
def r3(spark, sf):
    return sm.first_per_label(reviews(spark, sf).select("row_id", "sentimen"))


@query(
    "r4_random_index_samples",
    "SELECT vec_id, sentimen, CASE WHEN sentimen = 1 THEN 'Positive' ELSE 'Negative' END AS sentiment FROM "
    + s.lowest("(SELECT *, CAST(label >= 5 AS INTEGER) AS sentimen FROM embeddings)", "vec_id", "10")
    + " WHERE taken",
)
def r4(spark, sf):
    index = table(spark, sf, "embeddings").select(
        "vec_id", (F.col("label") >= 5).cast("int").alias("sentimen")
    )
    return sm.random_index_samples(index)


@query("r5_head", "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 5")
def r5(spark, sf):
    return sm.head(table(spark, sf, "documents").select("doc_id", "text"), 5, "doc_id")


@query("m2_split", WITH + f"SELECT row_id, sentimen, taken AS is_test FROM {_split_sql()}")
def m2(spark, sf):
    return sm.train_test_split(reviews(spark, sf).select("row_id", "sentimen"))


@query("m2_split_unstratified", WITH + f"SELECT row_id, sentimen, taken AS is_test FROM {_split_sql(by=None)}")
def m2_plain(spark, sf):
    return sm.train_test_split(reviews(spark, sf).select("row_id", "sentimen"), label=None)


@query(
    "m10_folds",
    WITH
    + """SELECT row_id, sentimen, CASE WHEN rn <= (n + 2) // 3 THEN 0 WHEN rn <= (2 * n + 2) // 3 THEN 1 ELSE 2 END AS fold
    FROM (SELECT *, row_number() OVER (PARTITION BY sentimen ORDER BY md5(CAST(row_id AS VARCHAR) || ':43'), row_id) AS rn,
    count(*) OVER (PARTITION BY sentimen) AS n FROM reviews)""",
)
def m10_folds(spark, sf):
    return sm.folds(reviews(spark, sf).select("row_id", "sentimen"))


# --- metrics ------------------------------------------------------------------

CELLS = (
    f"WITH {SCORED}, m AS (SELECT count(*) FILTER (WHERE quality = 0 AND predicted = 0)::DOUBLE AS a, "
    "count(*) FILTER (WHERE quality = 0 AND predicted = 1)::DOUBLE AS b, "
    "count(*) FILTER (WHERE quality = 1 AND predicted = 0)::DOUBLE AS c, "
    "count(*) FILTER (WHERE quality = 1 AND predicted = 1)::DOUBLE AS d FROM scored), "
    "pr AS (SELECT *, coalesce(a / nullif(a + c, 0), 0) AS p0, coalesce(d / nullif(b + d, 0), 0) AS p1, "
    "coalesce(a / nullif(a + b, 0), 0) AS r0, coalesce(d / nullif(c + d, 0), 0) AS r1 FROM m), "
    "f AS (SELECT *, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0, "
    "coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1, a + b + c + d AS n FROM pr) "
)


def outcome(spark, sf):
    return scored(spark, sf).select(
        F.col("quality").alias("actual"), "predicted", F.col("p").alias("score")
    )


@query(
    "e1_confusion_matrix",
    f"WITH {SCORED} SELECT g.actual, g.predicted, count(s.doc_id) AS n FROM (SELECT a.actual, p.predicted FROM "
    "(VALUES (0), (1)) a(actual), (VALUES (0), (1)) p(predicted)) g LEFT JOIN scored s "
    "ON s.quality = g.actual AND s.predicted = g.predicted GROUP BY 1, 2",
)
def e1(spark, sf):
    return metrics.confusion_matrix(outcome(spark, sf))


@query("e2_accuracy", f"WITH {SCORED} SELECT {s.r6('avg(CAST(quality = predicted AS DOUBLE))')} AS accuracy FROM scored")
def e2(spark, sf):
    return rounded(metrics.accuracy(outcome(spark, sf)))


def _weighted(m: str) -> str:
    return s.r6(f"({m}0 * (a + b) + {m}1 * (c + d)) / n")


@query(
    "e3_weighted_scores",
    CELLS + f"SELECT {_weighted('p')} AS precision, {_weighted('r')} AS recall, {_weighted('f')} AS f1_score FROM f",
)
def e3(spark, sf):
    return rounded(metrics.weighted_scores(outcome(spark, sf)))


@query("e4_binary_scores", CELLS + f"SELECT {s.r6('p1')} AS precision, {s.r6('r1')} AS recall, {s.r6('f1')} AS f1_score FROM f")
def e4(spark, sf):
    return rounded(metrics.binary_scores(outcome(spark, sf)))


@query(
    "e5_roc_auc",
    f"""WITH {SCORED}, g AS (SELECT p, count(*) FILTER (WHERE quality = 1) AS pos, count(*) FILTER (WHERE quality = 0) AS neg
    FROM scored GROUP BY p), c AS (SELECT *, sum(neg) OVER (ORDER BY p) - neg AS below FROM g)
    SELECT {s.r6('sum(pos * (below + neg / 2.0))::DOUBLE / (sum(pos)::DOUBLE * sum(neg)::DOUBLE)')} AS auc FROM c""",
)
def e5(spark, sf):
    return rounded(metrics.roc_auc(outcome(spark, sf)))


@query(
    "e5_roc_auc_distinct_scores",
    f"""WITH o AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS actual, l_extendedprice * (1 - l_discount) AS score FROM lineitem),
    g AS (SELECT score, count(*) FILTER (WHERE actual = 1) AS pos, count(*) FILTER (WHERE actual = 0) AS neg
    FROM o GROUP BY score), c AS (SELECT *, sum(neg) OVER (ORDER BY score) - neg AS below FROM g)
    SELECT {s.r6('sum(pos * (below + neg / 2.0))::DOUBLE / (sum(pos)::DOUBLE * sum(neg)::DOUBLE)')} AS auc FROM c""",
)
def e5_lines(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("actual"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("score"),
    )
    return rounded(metrics.roc_auc(rows))


@query(
    "e6_classification_report",
    CELLS
    + " UNION ALL ".join(
        f"SELECT '{name}' AS entry, {s.r6(p)} AS precision, {s.r6(r)} AS recall, {s.r6(f)} AS f1_score, "
        f"CAST({n} AS BIGINT) AS support FROM f"
        for name, p, r, f, n in (
            ("Negative", "p0", "r0", "f0", "a + b"),
            ("Positive", "p1", "r1", "f1", "c + d"),
            ("accuracy", "(a + d) / n", "(a + d) / n", "(a + d) / n", "n"),
            ("macro avg", "(p0 + p1) / 2", "(r0 + r1) / 2", "(f0 + f1) / 2", "n"),
            (
                "weighted avg",
                "(p0 * (a + b) + p1 * (c + d)) / n",
                "(r0 * (a + b) + r1 * (c + d)) / n",
                "(f0 * (a + b) + f1 * (c + d)) / n",
                "n",
            ),
        )
    ),
)
def e6(spark, sf):
    return rounded(metrics.classification_report(outcome(spark, sf)))


@query(
    "e7_evaluation",
    CELLS
    + f"SELECT {s.r6('(a + d) / n')} AS accuracy, {_weighted('p')} AS precision, {_weighted('r')} AS recall, "
    f"{_weighted('f')} AS f1_score, a::BIGINT AS n00, b::BIGINT AS n01, c::BIGINT AS n10, d::BIGINT AS n11 FROM f",
)
def e7(spark, sf):
    return rounded(metrics.evaluation(outcome(spark, sf)))
