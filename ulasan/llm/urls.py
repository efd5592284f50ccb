"""URL filters: host and path rules, and boosted trees on lexical features for other urls."""

from __future__ import annotations

import math
import string
from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ulasan.session import stored

FEATURES = (
    "length", "host_length", "path_length", "depth", "labels", "digit_share", "entropy", "parameters",
    "marks", "longest_part", "secure", "suffix_rate", "suffix_seen",
)


# --- parts and rules ----------------------------------------------------------


def host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, ASCII lower case; else empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host_: Column, path_: Column, rules: Sequence[tuple[str, str]], most: int = 1000) -> Column:
    """The longest rule `(verdict, "host/path")` that fits, as struct `(rule, verdict)`; else null.

    A rule fits its host and all subdomains if the path starts with the rule's. Rules are one chain of
    conditions in the plan, which is meant for lists of up to `most`.
    """
    if len(rules) > most:
        raise ValueError(f"at most {most} rules, got {len(rules)}")
    chain = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host_ == name) | host_.endswith("." + name)) & path_.startswith("/" + rest)
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        chain = F.when(fits, value) if chain is None else chain.when(fits, value)
    return chain if chain is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


# --- features -----------------------------------------------------------------


def entropy(text: Column) -> Column:
    """Bits per character of the characters' distribution, for text split by a pattern."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    n = F.greatest(F.size(chars), F.lit(1)).cast("double")
    counts = F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)) / n)
    return F.aggregate(counts, F.lit(0.0), lambda a, p: a - p * F.log2(p))


def suffix(host_: Column) -> Column:
    return F.substring_index(host_, ".", -1)


def suffix_statistics(labelled: DataFrame, most: int = 1000, smoothing: float = 20.0) -> tuple[DataFrame, float]:
    """`(suffix, suffix_rate, suffix_seen)` of the `most` commonest suffixes of `(url, label)`, and the
    overall rate that all others get. Rates lean to the overall rate where a suffix is rare."""
    rows = labelled.select(suffix(host(F.col("url"))).alias("suffix"), "label")
    overall = float(rows.agg(F.avg("label")).first()[0] or 0.0)
    stats = (
        rows.groupBy("suffix")
        .agg(F.count("*").alias("n"), F.sum("label").alias("bad"))
        .orderBy(F.desc("n"), "suffix")
        .limit(most)
        .select(
            "suffix",
            ((F.col("bad") + smoothing * overall) / (F.col("n") + smoothing)).alias("suffix_rate"),
            F.log1p("n").alias("suffix_seen"),
        )
    )
    return stored(stats, "suffixes"), overall


def with_features(rows: DataFrame, suffixes: DataFrame, overall: float) -> DataFrame:
    """`rows` (with `url`) plus `FEATURES`; the suffix table has a bounded number of rows."""
    url = F.coalesce(F.col("url"), F.lit(""))
    h, p = host(F.col("url")), path(F.col("url"))
    length = F.length(url)
    share = lambda c: c / F.greatest(length, F.lit(1))
    tail = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    out = rows.withColumns(
        {
            "length": F.log1p(length),
            "host_length": F.length(h),
            "path_length": F.log1p(F.length(p)),
            "depth": F.regexp_count(p, F.lit("/[^/]")),
            "labels": F.regexp_count(h, F.lit(r"[^.]+")),
            "digit_share": share(F.regexp_count(url, F.lit("[0-9]"))),
            "entropy": entropy(h),
            "parameters": F.when(tail == "", 0).otherwise(F.regexp_count(tail, F.lit("&")) + 1),
            "marks": F.regexp_count(url, F.lit(r"[-_%@~+]")),
            "longest_part": F.array_max(F.transform(F.split(h, r"\."), lambda x: F.length(x))),
            "secure": url.startswith("https").cast("int"),
            "suffix": suffix(h),
        }
    )
    out = out.join(F.broadcast(suffixes), "suffix", "left")
    return out.withColumns(
        {
            "suffix_rate": F.coalesce("suffix_rate", F.lit(overall)),
            "suffix_seen": F.coalesce("suffix_seen", F.lit(0.0)),
        }
    ).drop("suffix")


# --- the filter ---------------------------------------------------------------


class UrlFilter:
    """Boosted trees with the suffix table they were fitted on; without a model all urls are allowed."""

    def __init__(self, model: GBTClassificationModel | None, suffixes: DataFrame | None, overall: float):
        self.model, self.suffixes, self.overall = model, suffixes, overall

    def score(self, rows: DataFrame) -> DataFrame:
        """`rows` plus `block_score`, the probability that the url is one to block."""
        if self.model is None:
            return rows.withColumn("block_score", F.lit(self.overall))
        assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
        featured = with_features(rows, self.suffixes, self.overall)
        scored = self.model.transform(assembler.transform(featured))
        kept = [F.col(c) for c in rows.columns]
        return scored.select(*kept, vector_to_array("probability")[1].alias("block_score"))


def fit(
    labelled: DataFrame, max_rows: int = 20_000, trees: int = 10, depth: int = 3, seed: int = 42
) -> UrlFilter:
    """Fit on `(url, label)`, label 1 for urls to block. Null labels are left out.

    Suffix statistics cover all labelled rows; the trees are fitted on at most about `max_rows` of
    them, chosen by a hash of the url. With one class only, its rate is the score of every url.
    """
    rows = labelled.where("label IS NOT NULL").select("url", F.col("label").cast("double").alias("label"))
    found = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    if len(found) < 2:
        return UrlFilter(None, None, float(next(iter(found), 0.0)))
    suffixes, overall = suffix_statistics(rows)
    limit = math.ceil(min(1.0, max_rows / sum(found.values())) * (1 << 30))
    some = rows.where(F.pmod(F.xxhash64(F.lit(seed), "url"), F.lit(1 << 30)) < limit)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    data = stored(
        assembler.transform(with_features(some, suffixes, overall)).select("_features", "label"), "url-rows"
    )
    learner = GBTClassifier(
        featuresCol="_features", labelCol="label", maxIter=trees, maxDepth=depth, maxBins=32, seed=seed
    )
    return UrlFilter(learner.fit(data), suffixes, overall)


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    bar: float = 0.5,
    **options,
) -> DataFrame:
    """`(page_id, host, path, rule, verdict, block_score)` per row of `pages`.

    Urls that a rule decides are the labelled ones: the trees learn from them and decide the others.
    A null url, or one without `://`, has empty parts and no rule, and is judged like any other.
    Repeated rows give repeated results; an empty table gives none; other columns are not read.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    rows = rows.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    rows = stored(rows.withColumn("hit", rule_of(F.col("host"), F.col("path"), rules)), "urls")
    labelled = rows.where("hit IS NOT NULL").select(
        "url", (F.col("hit.verdict") == "block").cast("int").alias("label")
    )
    scored = fit(labelled, **options).score(rows)
    learned = F.when(F.col("block_score") > bar, "block").otherwise("allow")
    return scored.select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", learned).alias("verdict"), "block_score",
    )
