"""Vector functions, joins, exact search and near duplicates."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ulasan.functions import vector as vf
from ulasan.operators import vectors as vx
from ulasan.operators.ranking import beside
from ulasan.plans import sqltext as s
from ulasan.plans.catalog import query, rounded
from ulasan.plans.queries_text import SCORED, scored
from ulasan.session import stored
from ulasan.settings import IndexParams
from ulasan.sources import tables as src

E = "e AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)"
NEXT = f"WITH {E}, pairs AS (SELECT a.vec_id, a.e AS a, b.e AS b FROM e a JOIN e b ON b.vec_id = a.vec_id + 1) "


def embeddings(spark, sf):
    return src.table(spark, sf, "embeddings").select("vec_id", "embedding")


def neighbours(spark, sf):
    """Each vector beside the vector of the next id."""
    a = embeddings(spark, sf).withColumnRenamed("embedding", "a")
    b = embeddings(spark, sf).select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    return a.join(b, "vec_id")


@query(
    "x11_l2_normalize",
    f"""SELECT vec_id, pos, {s.r6('x')} AS x FROM (SELECT vec_id, unnest(range(len(e))) AS pos,
    unnest(list_transform(e, lambda y: CASE WHEN n > 0 THEN y / n ELSE y END)) AS x
    FROM (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS n FROM (SELECT vec_id,
    list_transform(embedding::DOUBLE[], lambda y: y * (vec_id % 3)) AS e FROM embeddings)))""",
)
def x11(spark, sf):
    scaled = F.transform(F.col("embedding").cast("array<double>"), lambda y: y * (F.col("vec_id") % 3))
    unit = embeddings(spark, sf).select("vec_id", vf.l2_normalize(scaled).alias("u"))
    return rounded(unit.select("vec_id", F.posexplode("u").alias("pos", "x")))


@query(
    "x12_vector_norm",
    f"WITH {E} SELECT vec_id, {s.r6('sqrt(list_inner_product(e, e)) * (1 + vec_id % 7)')} AS norm FROM e",
)
def x12(spark, sf):
    scaled = F.transform(F.col("embedding").cast("array<double>"), lambda y: y * (1 + F.col("vec_id") % 7))
    return rounded(embeddings(spark, sf).select("vec_id", vf.l2_norm(scaled).alias("norm")))


@query("x13_inner_product", NEXT + f"SELECT vec_id, {s.r6('list_inner_product(a, b)')} AS value FROM pairs")
def x13(spark, sf):
    value = vf.inner_product(F.col("a"), F.col("b"))
    return rounded(neighbours(spark, sf).select("vec_id", value.alias("value")))


@query("x14_cosine", NEXT + f"SELECT vec_id, {s.r6('list_cosine_similarity(a, b)')} AS value FROM pairs")
def x14(spark, sf):
    return rounded(neighbours(spark, sf).select("vec_id", vf.cosine(F.col("a"), F.col("b")).alias("value")))


@query("x15_squared_l2", NEXT + f"SELECT vec_id, {s.r6('list_distance(a, b) * list_distance(a, b)')} AS value FROM pairs")
def x15(spark, sf):
    return rounded(neighbours(spark, sf).select("vec_id", vf.squared_l2(F.col("a"), F.col("b")).alias("value")))


@query("x16_confidence", f"WITH {SCORED} SELECT doc_id, {s.r6('confidence')} AS confidence FROM scored")
def x16(spark, sf):
    p = array_to_vector(F.array(1 - F.col("p"), F.col("p")))
    return rounded(scored(spark, sf).select("doc_id", vf.confidence(p).alias("confidence")))


# --- index and joins ------------------------------------------------------------


def index(spark, sf):
    return vx.build_index(src.vectors(spark, sf), check=False)


def all_queries(spark, sf):
    """Every vector asks for its neighbours."""
    return index(spark, sf).select(
        F.col("vec_id").alias("query_id"), F.col("unit_vec").alias("query_vec")
    )


def _top_sql(score: str, order: str, name: str, k: int = 5, tables: str = s.UNIT) -> str:
    return (
        f"WITH {tables}, hits AS (SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, {s.r6('v')} AS {name} FROM "
        f"(SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(v, 12) {order}, vec_id) AS rank FROM "
        f"(SELECT q.vec_id AS query_id, x.vec_id, {score} AS v FROM unit q, unit x)) WHERE rank <= {k}) "
    )


@query(
    "v1_build_index",
    f"WITH {s.UNIT} SELECT vec_id, label, sentimen, pos, {s.r6('x')} AS x FROM (SELECT vec_id, label, sentimen, "
    "unnest(range(len(u))) AS pos, unnest(u) AS x FROM unit)",
)
def v1(spark, sf):
    built = vx.build_index(src.vectors(spark, sf))
    out = built.select("vec_id", "label", "sentimen", F.posexplode("unit_vec").alias("pos", "x"))
    x = (F.round(F.col("x").cast("double"), 6) + F.lit(0.0)).alias("x")
    return out.select("vec_id", "label", "sentimen", F.col("pos").cast("long").alias("pos"), x)


def _hits(df, name):
    return df.select("query_id", "rank", "vec_id", (F.round(name, 6) + F.lit(0.0)).alias(name))


@query(
    "v2_top_k_cosine",
    _top_sql("list_cosine_similarity(q.u, x.u)", "DESC", "similarity") + "SELECT * FROM hits",
)
def v2(spark, sf):
    return _hits(vx.search(index(spark, sf), all_queries(spark, sf), 5), "similarity")


@query(
    "v2_top_k_cosine_blocks",
    _top_sql("list_cosine_similarity(q.u, x.u)", "DESC", "similarity") + "SELECT * FROM hits",
)
def v2_blocks(spark, sf):
    """The same search as if the query set were too large to be sent to every task."""
    params = IndexParams(max_query_rows=64)
    return _hits(vx.search(index(spark, sf), all_queries(spark, sf), 5, params), "similarity")


@query(
    "v2_top_k_inner_product",
    _top_sql(
        "list_inner_product(q.u, x.u)",
        "DESC",
        "similarity",
        tables="unit AS (SELECT vec_id, label, list_transform(embedding::DOUBLE[], lambda y: y * (1 + vec_id % 7)) AS u "
        "FROM embeddings)",
    )
    + "SELECT * FROM hits",
)
def v2_ip(spark, sf):
    scaled = F.transform(F.col("embedding").cast("array<double>"), lambda y: y * (1 + F.col("vec_id") % 7))
    raw = src.vectors(spark, sf).withColumn("unit_vec", scaled)
    queries = raw.select(
        F.col("vec_id").alias("query_id"), F.col("unit_vec").alias("query_vec")
    )
    return _hits(vx.search(raw, queries, 5, IndexParams(normalize=False)), "similarity")


@query(
    "v3_top_k_l2",
    _top_sql("list_distance(q.u, x.u) * list_distance(q.u, x.u)", "", "distance") + "SELECT * FROM hits",
)
def v3(spark, sf):
    params = IndexParams(index_type="l2", normalize=False)
    return _hits(vx.search(index(spark, sf), all_queries(spark, sf), 5, params), "distance")


META = "meta AS (SELECT doc_id AS vec_id, text AS review, n_chars FROM documents)"


def metadata(spark, sf):
    return src.table(spark, sf, "documents").select(
        F.col("doc_id").alias("vec_id"), F.col("text").alias("review"), "n_chars"
    )


@query(
    "j1_hits_with_metadata",
    _top_sql("list_cosine_similarity(q.u, x.u)", "DESC", "similarity", 3, f"{s.UNIT}, {META}")
    + "SELECT h.*, m.review, m.n_chars FROM hits h JOIN meta m USING (vec_id)",
)
def j1(spark, sf):
    hits = _hits(vx.search(index(spark, sf), all_queries(spark, sf), 3), "similarity")
    return vx.attach_metadata(hits, metadata(spark, sf))


@query(
    "j2_align_table_and_vectors",
    f"WITH {META} SELECT m.vec_id, m.n_chars, len(e.embedding) AS dimension FROM embeddings e JOIN meta m USING (vec_id)",
)
def j2(spark, sf):
    meta = metadata(spark, sf).select("vec_id", "n_chars")
    joined = vx.align(embeddings(spark, sf), meta, "vec_id", check=False)
    return joined.select("vec_id", "n_chars", F.size("embedding").cast("long").alias("dimension"))


@query(
    "j2_alignment_counts",
    "SELECT count(*) FILTER (WHERE e.vec_id IS NOT NULL AND d.doc_id IS NOT NULL) AS n_both, "
    "count(*) FILTER (WHERE d.doc_id IS NULL) AS n_left_only, count(*) FILTER (WHERE e.vec_id IS NULL) AS n_right_only "
    "FROM embeddings e FULL JOIN documents d ON e.vec_id = d.doc_id",
)
def j2_counts(spark, sf):
    return vx.alignment(embeddings(spark, sf), metadata(spark, sf), "vec_id")


@query(
    "v5_ranked_hits",
    _top_sql("list_cosine_similarity(q.u, x.u)", "DESC", "similarity", 5, f"{s.UNIT}, {META}")
    + "SELECT h.*, m.review AS text, '' AS clean_text, CASE WHEN u.sentimen = 1 THEN 'Positive' ELSE 'Negative' END "
    "AS sentiment, u.sentimen AS sentiment_label FROM hits h JOIN meta m USING (vec_id) JOIN unit u USING (vec_id)",
)
def v5(spark, sf):
    hits = _hits(vx.search(index(spark, sf), all_queries(spark, sf), 5), "similarity")
    meta = metadata(spark, sf).join(src.vectors(spark, sf).select("vec_id", "sentimen"), "vec_id")
    return vx.ranked_hits(hits, meta.withColumn("review_clean", F.lit(None).cast("string")))


@query(
    "r6_first_rows_similarity_cap",
    f"WITH {s.UNIT}, hits AS (SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, {s.r6('v')} AS similarity FROM "
    "(SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(v, 12) DESC, vec_id) AS rank FROM "
    "(SELECT q.vec_id AS query_id, x.vec_id, list_cosine_similarity(q.u, x.u) AS v FROM unit q, unit x "
    "WHERE q.vec_id < 10)) WHERE rank <= 3) SELECT * FROM hits",
)
def r6(spark, sf):
    asking = vx.capped_queries(index(spark, sf), 10, "vec_id")
    queries = asking.select(F.col("vec_id").alias("query_id"), F.col("unit_vec").alias("query_vec"))
    return _hits(vx.search(index(spark, sf), queries, 3), "similarity")


# --- near duplicates ------------------------------------------------------------

# Every vector gets an exact copy under another id, so that copies take part as well.
COPIED = (
    f"{s.UNIT}, copied AS (SELECT vec_id, u FROM unit UNION ALL SELECT vec_id + 1000000, u FROM unit)"
)
PAIRS = (
    f"WITH {COPIED}, g AS (SELECT u, min(vec_id) AS rep FROM copied GROUP BY u), "
    "p AS (SELECT least(a.rep, b.rep) AS i, greatest(a.rep, b.rep) AS j, list_cosine_similarity(a.u, b.u) AS v "
    "FROM g a JOIN g b ON a.rep < b.rep WHERE list_cosine_similarity(a.u, b.u) > 0.35 "
    "UNION ALL SELECT g.rep, c.vec_id, 1.0 FROM copied c JOIN g USING (u) WHERE c.vec_id > g.rep) "
    f"SELECT i, j, {s.r6('v')} AS similarity FROM p"
)
KNN = (
    f"WITH {COPIED}, r AS (SELECT a.vec_id AS i, b.vec_id AS j, list_cosine_similarity(a.u, b.u) AS v, row_number() OVER "
    "(PARTITION BY a.vec_id ORDER BY round(list_cosine_similarity(a.u, b.u), 12) DESC, b.vec_id) AS rank "
    f"FROM copied a, copied b) SELECT i, j, {s.r6('v')} AS similarity FROM r WHERE rank BETWEEN 2 AND 10 AND v > 0.35 AND i < j"
)


def copied_index(spark, sf):
    idx = index(spark, sf)
    copies = idx.withColumn("vec_id", F.col("vec_id") + 1_000_000)
    return idx.unionByName(copies)


def _pairs(df):
    return df.select("i", "j", (F.round("similarity", 6) + F.lit(0.0)).alias("similarity"))


@query("v6_near_duplicates", PAIRS)
def v6(spark, sf):
    return _pairs(vx.near_duplicates(copied_index(spark, sf), 0.35))


@query("v6_near_duplicates_cells", PAIRS)
def v6_cells(spark, sf):
    """The same join in several chunks, as on large tables."""
    idx = stored(copied_index(spark, sf), "copied")
    params = IndexParams(max_query_rows=max(1, idx.count() // 5))
    return _pairs(vx.near_duplicates(idx, 0.35, params=params))


@query(
    "v6_near_duplicates_kinds",
    f"WITH {COPIED}, g AS (SELECT u, min(vec_id) AS rep FROM copied GROUP BY u) "
    "SELECT 'near' AS kind, count(*) AS n FROM g a JOIN g b ON a.rep < b.rep WHERE list_cosine_similarity(a.u, b.u) > 0.35 "
    "HAVING count(*) > 0 UNION ALL SELECT 'copy', count(*) FROM copied c JOIN g USING (u) WHERE c.vec_id > g.rep",
)
def v6_kinds(spark, sf):
    return vx.near_duplicates(copied_index(spark, sf), 0.35).groupBy("kind").agg(F.count("*").alias("n"))


# Every vector beside one that is shrunk or stretched in places, at a cosine of about 0.97.
BENT = (
    "bent AS (SELECT vec_id + 1000000 AS vec_id, list_transform(range(1, len(e) + 1), "
    "lambda i: CASE (i + vec_id) % 4 WHEN 0 THEN e[i] * 0.6 WHEN 1 THEN e[i] * 1.2 ELSE e[i] END) AS e FROM e)"
)


@query(
    "v6_banded_recall",
    f"WITH {E}, {BENT}, every AS (SELECT * FROM e UNION ALL SELECT * FROM bent) "
    "SELECT count(*) AS n_exact, TRUE AS is_recalled, TRUE AS is_exact FROM every a JOIN every b ON a.vec_id < b.vec_id "
    "WHERE list_cosine_similarity(a.e, b.e) > 0.9",
)
def v6_banded(spark, sf):
    """Of all pairs above 0.9 the banded form finds at least 95 %, and no others."""
    bent = F.transform(
        "embedding",
        lambda x, i: F.when(F.pmod(i + 1 + F.col("vec_id"), F.lit(4)) == 0, x * 0.6)
        .when(F.pmod(i + 1 + F.col("vec_id"), F.lit(4)) == 1, x * 1.2)
        .otherwise(x),
    )
    e = embeddings(spark, sf).withColumn("embedding", F.col("embedding").cast("array<double>"))
    every = e.unionByName(e.select((F.col("vec_id") + 1_000_000).alias("vec_id"), bent.alias("embedding")))
    idx = stored(vx.build_index(every, check=False), "bent")
    exact = vx.near_duplicates(idx, 0.9).select("i", "j", F.lit(1).alias("e"))
    banded = vx.near_duplicates(idx, 0.9, mode="banded").select("i", "j", F.lit(1).alias("b"))
    both = exact.join(banded, ["i", "j"], "full").agg(
        F.count("e").alias("n_exact"), F.count("b").alias("n"), F.count_if((F.col("e") == 1) & (F.col("b") == 1)).alias("hit")
    )
    return both.select(
        "n_exact", (F.col("hit") >= 0.95 * F.col("n_exact")).alias("is_recalled"), (F.col("hit") == F.col("n")).alias("is_exact")
    )


@query("v6_near_duplicates_knn10", KNN)
def v6_knn(spark, sf):
    return _pairs(vx.near_duplicates(copied_index(spark, sf), 0.35, mode="knn10"))


@query(
    "j3_similarity_join",
    f"WITH {s.UNIT} SELECT a.vec_id AS i, b.vec_id AS j, {s.r6('list_cosine_similarity(a.u, b.u)')} AS similarity "
    "FROM unit a JOIN unit b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.u, b.u) > 0.3",
)
def j3(spark, sf):
    return _pairs(vx.near_duplicates(index(spark, sf), 0.3))


@query(
    "a14_index_statistics",
    f"WITH {s.UNIT} SELECT sentimen AS label, count(*) AS n, any_value(t.total) AS total_vectors, "
    "any_value(t.dim) AS dimension, 'inner_product' AS index_type, any_value(t.total) * any_value(t.dim) * 4 AS approx_bytes "
    "FROM unit, (SELECT count(*) AS total, max(len(u)) AS dim FROM unit) t GROUP BY sentimen",
)
def a14(spark, sf):
    return rounded(vx.index_statistics(index(spark, sf))).withColumn("label", F.col("label").cast("int"))


@query(
    "a18_pairwise_statistics",
    f"WITH {s.UNIT}, sample AS (SELECT vec_id, u FROM {s.lowest('unit', 'vec_id', '1000')} WHERE taken) "
    f"SELECT (SELECT count(*) FROM sample) AS sample_size, count(*) AS n_pairs, {s.r6('avg(v)')} AS avg_similarity, "
    f"{s.r6('stddev_pop(v)')} AS std_similarity, {s.r6('min(v)')} AS min_similarity, {s.r6('max(v)')} AS max_similarity "
    "FROM (SELECT list_cosine_similarity(a.u, b.u) AS v FROM sample a, sample b WHERE a.vec_id <> b.vec_id)",
)
def a18(spark, sf):
    return rounded(vx.pairwise_statistics(index(spark, sf)))


@query("v7_cluster_centers")
def v7(spark, sf):
    return vx.cluster_centers(index(spark, sf), 10)


@query("v8_search_benchmark")
def v8(spark, sf):
    return vx.benchmark_search(index(spark, sf))




@query(
    "v7_closest_items",
    "SELECT CAST(range AS INTEGER) AS cluster_id, TRUE AS is_closest FROM range(10)",
)
def v7_closest(spark, sf):
    """No row of the index has a greater inner product with a centre than the row given for it."""
    idx = index(spark, sf)
    centers = vx.cluster_centers(idx, 10)
    given = centers.select("cluster_id", "centroid", F.col("closest_item_index").alias("vec_id"))
    chosen = given.join(idx.select("vec_id", "unit_vec"), "vec_id").select(
        "cluster_id", vf.inner_product(F.col("centroid"), F.col("unit_vec")).alias("own")
    )
    # Ten centres beside every row, folded to one maximum per centre.
    all_centers = given.agg(F.collect_list(F.struct("cluster_id", "centroid")).alias("centers"))
    best = (
        beside(idx.select("unit_vec"), all_centers)
        .select("unit_vec", F.explode("centers").alias("c"))
        .groupBy(F.col("c.cluster_id").alias("cluster_id"))
        .agg(F.max(vf.inner_product(F.col("c.centroid"), F.col("unit_vec"))).alias("best"))
    )
    return chosen.join(best, "cluster_id").select(
        "cluster_id", (F.col("own") >= F.col("best") - 1e-6).alias("is_closest")
    )


@query(
    "v7_closest_items_l2",
    "SELECT CAST(range AS INTEGER) AS cluster_id, TRUE AS is_closest FROM range(10)",
)
def v7_closest_l2(spark, sf):
    """No row of an index by distance is nearer to a centre than the row given for it."""
    idx = index(spark, sf)
    centers = vx.cluster_centers(idx, 10, params=IndexParams(index_type="l2"))
    given = centers.select("cluster_id", "centroid", F.col("closest_item_index").alias("vec_id"))
    chosen = given.join(idx.select("vec_id", "unit_vec"), "vec_id").select(
        "cluster_id", vf.squared_l2(F.col("centroid"), F.col("unit_vec")).alias("own")
    )
    all_centers = given.agg(F.collect_list(F.struct("cluster_id", "centroid")).alias("centers"))
    best = (
        beside(idx.select("unit_vec"), all_centers)
        .select("unit_vec", F.explode("centers").alias("c"))
        .groupBy(F.col("c.cluster_id").alias("cluster_id"))
        .agg(F.min(vf.squared_l2(F.col("c.centroid"), F.col("unit_vec"))).alias("best"))
    )
    return chosen.join(best, "cluster_id").select(
        "cluster_id", (F.col("own") <= F.col("best") + 1e-6).alias("is_closest")
    )


@query(
    "v8_search_benchmark_shape",
    "SELECT least(count(*), 100) AS n_queries, 5 AS k, TRUE AS is_consistent FROM embeddings",
)
def v8_shape(spark, sf):
    row = vx.benchmark_search(index(spark, sf))
    rate = F.abs(F.col("queries_per_second") * F.col("avg_time_per_query") - 1) < 1e-9
    return row.select("n_queries", "k", rate.alias("is_consistent"))
