"""The registered queries of these operators, with SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ulasan.llm import bpe, chat, crf, minhash, mixing, packing, phrases, ptolemy, rules, secrets, simhash, toxicity, urls
from ulasan.session import stored

URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = rules.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return found.select("doc_id", *(F.col(f"_base.{c}").alias(c) for c in base), "base_failed", "kept")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path(), window=1024, end_id=0)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return crf.score(docs, crf.fit(docs, read(spark, sf_dir, "labels")), bar=0.3)


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = secrets.train(stored(secrets.samples_from(docs), "secret-samples"))
    found = secrets.scan(docs, model)
    count = lambda k: F.size(F.filter("_base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{name}") for k, name in enumerate(secrets.KINDS[:3])),
        F.sha2(secrets.spelled(F.col("_base")), 256).alias("base_sha256"),
        secrets.spelled(F.col("_spans")).alias("spans"),
    )


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(read(spark, sf_dir, "conversations"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")), bar=0.5)


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"), URL_RULES)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), weights=(5.0, 2.0, 1.0), most=3.0)


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.compare_with_edits(read(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.collocations(read(spark, sf_dir, "documents"), longest=4, least=30, top=2000)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = ptolemy.cluster(read(spark, sf_dir, "embeddings"), k=16, rounds=3, dims=64, scale=64.0, seed=1)
    spelled = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    inertia = F.col("inertia").cast("long")
    # One row for each of the 16 centroids.
    per_cluster = F.broadcast(
        centroids.select(
            "cluster",
            inertia.alias("cluster_inertia"),
            F.sum(inertia).over(Window.partitionBy(F.lit(1))).alias("inertia"),
            spelled.alias("centroid_sha256"),
        )
    )
    return found.join(per_cluster, "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op13_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encode_and_decode(read(spark, sf_dir, "documents"), tokenizer_path())
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(bpe.joined_ids(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


OP6_SQL = """
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
    FROM conversations WHERE conv_id IS NOT NULL
),
p AS (
    SELECT conv_id, place,
           string_agg(md5(role || chr(1) || text), ',') OVER (PARTITION BY conv_id ORDER BY place) AS prefix,
           count(*) OVER (PARTITION BY conv_id) AS n,
           string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '')
               OVER (PARTITION BY conv_id, (place - 1) // 4096 ORDER BY place) AS rendered,
           (place - 1) // 4096 AS part
    FROM t
),
longer AS (SELECT prefix, max(n) AS longest FROM p GROUP BY prefix),
ends AS (
    SELECT p.prefix, min(conv_id) AS conv_id, count(*) AS n_same, any_value(n) AS n_turns
    FROM p JOIN longer USING (prefix) WHERE place = n AND longest = n GROUP BY p.prefix
)
SELECT e.conv_id, p.part, e.n_turns, e.n_same, p.rendered
FROM ends e JOIN p ON p.conv_id = e.conv_id
WHERE p.place = p.n OR p.place % 4096 = 0
"""

_OP12_ROUND = """
a{i} AS MATERIALIZED (
    SELECT id, any_value(vec_id) AS vec_id, min(row(d, c)) AS best, any_value(v) AS v
    FROM (SELECT k.id, k.vec_id, k.v, m.c,
                 CAST(list_inner_product(k.v, k.v) + list_inner_product(m.v, m.v) - 2 * list_inner_product(k.v, m.v) AS BIGINT) AS d
          FROM kept k CROSS JOIN m{i} m)
    GROUP BY id
)"""
_OP12_MOVE = """
m{j} AS MATERIALIZED (
    SELECT m{i}.c, coalesce(n.v, m{i}.v) AS v
    FROM m{i} LEFT JOIN (
        SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY place) AS v
        FROM (SELECT best[2] AS c, place, sum(CAST(v[place] AS BIGINT)) AS s, count(*) AS n
              FROM (SELECT best, v, unnest(range(1, 65)) AS place FROM a{i})
              GROUP BY best[2], place)
        GROUP BY c) n USING (c)
)"""
OP12_SQL = (
    """
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
m0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
    FROM (SELECT sha256('1:' || CAST(vec_id AS VARCHAR)) AS h, v FROM kept ORDER BY h, v LIMIT 16)
),"""
    + ",".join(_OP12_ROUND.format(i=i) + "," + _OP12_MOVE.format(i=i, j=i + 1) for i in range(3))
    + ","
    + _OP12_ROUND.format(i=3)
    + """,
hashed AS (SELECT c, sha256(array_to_string(list_transform(v, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS h FROM m3)
SELECT vec_id, CAST(best[2] AS INTEGER) AS cluster, best[1] AS distance,
       CAST(sum(best[1]) OVER (PARTITION BY best[2]) AS BIGINT) AS cluster_inertia,
       CAST(sum(best[1]) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM a3 JOIN hashed ON hashed.c = best[2]
"""
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup,
        op2_quality_rules,
        op3_packing,
        op4_quality_classifier,
        op5_secret_scans,
        op6_chat_formatting,
        op7_toxicity,
        op8_url_filters,
        op9_mixing,
        op10_document_fingerprints,
        op11_phrase_collocations,
        op12_centroid_clustering,
        op13_bpe_encoding,
    )
}
SQL: dict[str, str] = {"op6_chat_formatting": OP6_SQL, "op12_centroid_clustering": OP12_SQL}
