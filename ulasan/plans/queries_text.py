"""Cleaning, filters and label queries over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ulasan.functions import text as tx
from ulasan.operators import prepare as prep
from ulasan.plans import sqltext as s
from ulasan.plans.catalog import query, rounded
from ulasan.settings import CleanRules
from ulasan.sources.tables import reviews, table

# Cases that the tables do not hold are made from their own columns, on both sides.
MIXED = (
    "mixed AS (SELECT row_id, CASE WHEN toxic = 1 THEN NULL WHEN sentimen = 0 THEN ' \t ' ELSE review END "
    "AS review, CASE WHEN toxic = 1 AND sentimen = 0 THEN 'unknown' WHEN toxic = 1 THEN '1.0' "
    "ELSE CAST(sentimen AS VARCHAR) END AS sentimen, CASE WHEN length(review) > 1000 THEN review END "
    "AS translate FROM reviews)"
)
WITH_MIXED = f"WITH {s.REVIEWS}, {MIXED} "


def mixed(spark, sf):
    r = reviews(spark, sf)
    toxic, bad = F.col("toxic") == 1, F.col("sentimen") == 0
    return r.select(
        "row_id",
        F.when(toxic, None).when(bad, " \t ").otherwise(F.col("review")).alias("review"),
        F.when(toxic & bad, "unknown")
        .when(toxic, "1.0")
        .otherwise(F.col("sentimen").cast("string"))
        .alias("sentimen"),
        F.when(F.length("review") > 1000, F.col("review")).alias("translate"),
    )


def doubled(spark, sf):
    """Every mixed row twice, the second under another id."""
    m = mixed(spark, sf)
    return m.unionByName(m.withColumn("row_id", F.col("row_id") + 1_000_000_000))


DOUBLED = (
    "doubled AS (SELECT * FROM mixed UNION ALL SELECT row_id + 1000000000, review, sentimen, translate "
    "FROM mixed)"
)
DEDUPED = (
    "deduped AS (SELECT min(row_id) AS row_id, review, sentimen, translate FROM doubled "
    "GROUP BY review, sentimen, translate)"
)


def documents(spark, sf):
    return table(spark, sf, "documents", "doc_id").select("doc_id", "text")


def over_documents(name, column, sql, before="", after=""):
    """Register one text expression applied to every whole document, set between two phrases."""

    @query(
        name,
        f"SELECT doc_id, {sql('t')} AS result FROM (SELECT doc_id, '{before}' || text || '{after}' AS t FROM documents)",
    )
    def run(spark, sf):
        whole = F.concat(F.lit(before), F.col("text"), F.lit(after))
        return documents(spark, sf).select("doc_id", column(whole).alias("result"))


@query(
    "x1_blank_to_empty",
    WITH_MIXED + f"SELECT row_id, {s.clean_full('review')} AS result FROM mixed",
)
def x1(spark, sf):
    return mixed(spark, sf).select("row_id", tx.clean_full(F.col("review")).alias("result"))


over_documents("x2_lowercase", F.lower, lambda t: f"lower({t})")
over_documents(
    "x3_remove_urls",
    tx.remove_urls,
    s.urls,
    "see https://a.example/x?y=1~keep#keep and http://b.example ", " http://c.example/~u",
)
over_documents(
    "x4_remove_emails",
    tx.remove_emails,
    s.emails,
    "a@b.example @start end@ x@@y\tz@w ", " last@one.example",
)
over_documents("x5_letters_only", tx.letters_only, lambda t: s.repl(t, r"[^a-zA-Z\t\n\f\r\x0b ]", " "))
over_documents(
    "x6_cap_runs",
    lambda t: tx.cap_runs(F.regexp_replace(F.lower(t), "[^a-z]", " ")),
    lambda t: s.repl(s.caps(s.repl(f"lower({t})", "[^a-z]", " ")), " {3,}", "  "),
    "bagussss sooo aaab ", " zzzz",
)
over_documents(
    "x7_collapse_spaces",
    tx.collapse_spaces,
    lambda t: f"trim({s.repl(t, r'[\t\n\f\r\x0b ]+', ' ')})",
    "  a \t b\n\n", "   ",
)
over_documents(
    "x8_slang",
    lambda t: tx.map_slang(tx.collapse_spaces(t)),
    lambda t: s.slang(f"trim({s.repl(t, r'[\t\n\f\r\x0b ]+', ' ')})"),
    "emg gak bgt gt gitu ", " knp kenapa gaaak Udah",
)
over_documents("x9_char_length", tx.char_length, lambda t: f"length({t})")
over_documents("x10_word_count", tx.word_count, s.words)
over_documents("p5_clean_full", tx.clean_full, s.clean_full)
over_documents("p6_clean_basic", tx.clean_basic, s.clean_basic)
over_documents(
    "p11_stopwords",
    lambda t: tx.drop_stopwords(tx.clean_basic(t)),
    lambda t: s.stopwords(s.clean_basic(t)),
    "Yang bagus dan itu ", " para mbak",
)
over_documents(
    "p12_clean_and_stopwords",
    lambda t: tx.clean(t, CleanRules(remove_stopwords=True)),
    lambda t: s.stopwords(s.clean_full(t)),
)


@query(
    "p17_preview",
    "SELECT doc_id, CASE WHEN length(text) > 80 THEN substring(text, 1, 80) || '...' ELSE text END AS p80, "
    "CASE WHEN length(text) > 100 THEN substring(text, 1, 100) || '...' ELSE text END AS p100 FROM documents",
)
def p17(spark, sf):
    t = F.col("text")
    return documents(spark, sf).select(
        "doc_id", tx.preview(t, 80).alias("p80"), tx.preview(t, 100).alias("p100")
    )


@query(
    "p1_validate",
    WITH_MIXED
    + f"""SELECT '' AS missing_cols, count(*) AS n_rows,
    count(*) FILTER (WHERE NOT {s.filled('review')}) AS n_empty,
    count(*) FILTER (WHERE coalesce(try_cast(sentimen AS DOUBLE) NOT IN (0, 1), TRUE)) AS n_bad_labels,
    count(*) FILTER (WHERE coalesce(try_cast(sentimen AS DOUBLE) NOT IN (0, 1), TRUE)) = 0 AS is_valid
    FROM mixed""",
)
def p1(spark, sf):
    return prep.validate(mixed(spark, sf))


@query("p2_dedup_rows", WITH_MIXED + f", {DOUBLED}, {DEDUPED} SELECT * FROM deduped")
def p2(spark, sf):
    return prep.dedup_rows(doubled(spark, sf), "row_id")


@query("p3_drop_null_reviews", WITH_MIXED + "SELECT * FROM mixed WHERE review IS NOT NULL")
def p3(spark, sf):
    return prep.drop_null_reviews(mixed(spark, sf))


@query(
    "p4_drop_any_null",
    WITH_MIXED + "SELECT * FROM mixed WHERE review IS NOT NULL AND sentimen IS NOT NULL AND translate IS NOT NULL",
)
def p4(spark, sf):
    return prep.drop_any_null(mixed(spark, sf))


@query(
    "p7_min_length",
    f"WITH c AS (SELECT doc_id, {s.clean_full('text')} AS review_clean FROM documents) "
    "SELECT doc_id, length(review_clean) AS n FROM c WHERE length(review_clean) >= 500",
)
def p7(spark, sf):
    docs = prep.with_clean(documents(spark, sf), source="text")
    return prep.min_length(docs, 500).select("doc_id", tx.char_length(F.col("review_clean")).alias("n"))


@query(
    "p8_coerce_labels",
    WITH_MIXED
    + "SELECT row_id, CAST(trunc(try_cast(sentimen AS DOUBLE)) AS INTEGER) AS sentimen FROM mixed "
    "WHERE try_cast(sentimen AS DOUBLE) IS NOT NULL",
)
def p8(spark, sf):
    return prep.coerce_labels(mixed(spark, sf)).select("row_id", "sentimen")


@query("p9_cast_labels", "SELECT doc_id, CAST(CAST(quality AS VARCHAR) AS INTEGER) AS sentimen FROM labels")
def p9(spark, sf):
    text = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("sentimen"))
    return prep.cast_labels(text)


PREPARED = (
    WITH_MIXED
    + f", {DOUBLED}, {DEDUPED}, cleaned AS (SELECT *, {s.clean_full('review')} AS review_clean FROM deduped "
    "WHERE review IS NOT NULL) "
)


@query(
    "p10_prepare",
    PREPARED
    + "SELECT row_id, CAST(trunc(try_cast(sentimen AS DOUBLE)) AS INTEGER) AS sentimen, review_clean "
    "FROM cleaned WHERE length(review_clean) >= 5 AND try_cast(sentimen AS DOUBLE) IS NOT NULL",
)
def p10(spark, sf):
    return prep.prepare(doubled(spark, sf)).select("row_id", "sentimen", "review_clean")


@query(
    "p10_prepare_counts",
    PREPARED
    + """SELECT (SELECT count(*) FROM doubled) AS n_input,
    (SELECT count(*) FROM doubled) - (SELECT count(*) FROM deduped) AS n_duplicates,
    (SELECT count(*) FROM deduped WHERE review IS NULL) AS n_null,
    (SELECT count(*) FROM cleaned WHERE length(review_clean) < 5) AS n_short,
    (SELECT count(*) FROM cleaned WHERE length(review_clean) >= 5
        AND try_cast(sentimen AS DOUBLE) IS NULL) AS n_bad_label,
    (SELECT count(*) FROM cleaned WHERE length(review_clean) >= 5
        AND try_cast(sentimen AS DOUBLE) IS NOT NULL) AS n_output""",
)
def p10_counts(spark, sf):
    return prep.prepare_counts(doubled(spark, sf))


@query(
    "p10_prepare_basic",
    WITH_MIXED
    + f", {DOUBLED}, {DEDUPED}, cleaned AS (SELECT *, {s.clean_basic('review')} AS review_clean FROM deduped "
    "WHERE review IS NOT NULL AND translate IS NOT NULL) SELECT row_id, review_clean, "
    "CAST(trunc(try_cast(sentimen AS DOUBLE)) AS INTEGER) AS sentimen FROM cleaned "
    "WHERE length(review_clean) > 5",
)
def p10_basic(spark, sf):
    numbers = prep.coerced_label()
    rows = doubled(spark, sf).withColumn("sentimen", numbers)
    return prep.prepare(rows, CleanRules(profile="basic")).select("row_id", "review_clean", "sentimen")


SHORTENED = (
    "WITH t AS (SELECT d.doc_id AS row_id, CASE WHEN l.toxic = 1 THEN d.lang WHEN l.quality = 0 THEN ' ' "
    "ELSE d.text END AS review FROM documents d JOIN labels l USING (doc_id)), "
    f"c AS (SELECT *, {s.clean_full('review')} AS review_clean FROM t) "
)


def shortened(spark, sf):
    docs = table(spark, sf, "documents", "doc_id").select("doc_id", "text", "lang")
    labels = table(spark, sf, "labels")
    return docs.join(labels, "doc_id").select(
        F.col("doc_id").alias("row_id"),
        F.when(F.col("toxic") == 1, F.col("lang"))
        .when(F.col("quality") == 0, " ")
        .otherwise(F.col("text"))
        .alias("review"),
    )


@query(
    "p13_too_short",
    SHORTENED
    + f"SELECT row_id, review_clean, CASE WHEN NOT {s.filled('review')} THEN 'blank' "
    "WHEN length(review_clean) < 3 THEN 'too_short' END AS reject_reason FROM c",
)
def p13(spark, sf):
    flagged = prep.flag_rejects(prep.with_clean(shortened(spark, sf)))
    return flagged.select("row_id", "review_clean", "reject_reason")


@query("p14_skip_blank", WITH_MIXED + f"SELECT row_id, review FROM mixed WHERE {s.filled('review')}")
def p14(spark, sf):
    return prep.skip_blank(mixed(spark, sf)).select("row_id", "review")


@query(
    "p15_label_names",
    "SELECT vec_id, CASE WHEN label = 1 THEN 'Positive' ELSE 'Negative' END AS name, "
    "CASE label WHEN 1 THEN 'Positive' WHEN 0 THEN 'Negative' END AS strict_name FROM embeddings",
)
def p15(spark, sf):
    label = F.col("label")
    return table(spark, sf, "embeddings").select(
        "vec_id", tx.label_name(label).alias("name"), tx.label_name_strict(label).alias("strict_name")
    )


SCORED = (
    "scored AS (SELECT doc_id, quality, toxic, p, greatest(p, 1 - p) AS confidence, "
    "CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS predicted FROM (SELECT *, "
    "CAST((doc_id * 7919) % 101 AS DOUBLE) / 101 AS p FROM labels))"
)


def scored(spark, sf):
    """A fixed score per labelled row, as a model would give."""
    p = F.pmod(F.col("doc_id") * 7919, F.lit(101)).cast("double") / 101
    rows = table(spark, sf, "labels").withColumn("p", p)
    return rows.withColumn("confidence", F.greatest("p", 1 - F.col("p"))).withColumn(
        "predicted", F.when(F.col("p") >= 0.5, 1).otherwise(0)
    )


@query(
    "p16_low_confidence",
    f"WITH {SCORED} SELECT doc_id, {s.r6('confidence')} AS confidence, confidence < 0.6 AS low_confidence FROM scored",
)
def p16(spark, sf):
    flagged = prep.low_confidence(scored(spark, sf), 0.6)
    return rounded(flagged.select("doc_id", "confidence", "low_confidence"))
