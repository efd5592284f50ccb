import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ulasan.operators import metrics
from ulasan.operators import prepare as prep
from ulasan.operators import profile as pf
from ulasan.operators import ranking as rk
from ulasan.operators import sampling as sm


def md5(key, seed):
    return hashlib.md5(f"{key}:{seed}".encode()).hexdigest()


@pytest.fixture(scope="module")
def skewed(spark):
    """Labels with a hot class, a small one and rows without a label."""
    label = F.when(F.col("id") % 100 == 0, 0).when(F.col("id") % 100 == 1, None).otherwise(1)
    return spark.range(20_000).select(F.col("id").alias("row_id"), label.alias("sentimen")).cache()


def by_label(df):
    groups = {}
    for r in df.collect():
        groups.setdefault(r["sentimen"], []).append(r["row_id"])
    return groups


def test_split_takes_the_lowest_hashes_of_each_class(skewed):
    groups = by_label(skewed)
    out = sm.train_test_split(skewed).collect()
    assert len(out) == 20_000
    for label, ids in groups.items():
        want = set(sorted(ids, key=lambda i: (md5(i, 42), i))[: math.ceil(len(ids) / 5)])
        assert {r["row_id"] for r in out if r["sentimen"] == label and r["is_test"]} == want


def test_folds_are_balanced_and_exhaustive(skewed):
    sizes = {}
    for r in sm.folds(skewed, 3).groupBy("sentimen", "fold").count().collect():
        sizes.setdefault(r["sentimen"], []).append(r["count"])
    for label, ids in by_label(skewed).items():
        assert sum(sizes[label]) == len(ids) and max(sizes[label]) - min(sizes[label]) <= 1


def test_stratified_sample(skewed):
    got = by_label(sm.stratified_sample(skewed, 1000))
    assert {k: len(v) for k, v in got.items()} == {0: 200, 1: 500}
    assert sm.stratified_sample(skewed, 20_000).count() == 20_000


def test_random_sample_is_exact_and_fixed(skewed):
    a = {r[0] for r in sm.random_sample(skewed, 777).select("row_id").collect()}
    b = {r[0] for r in sm.random_sample(skewed.repartition(13), 777).select("row_id").collect()}
    assert len(a) == 777 and a == b
    assert a != {r[0] for r in sm.random_sample(skewed, 777, seed=7).select("row_id").collect()}
    assert sm.random_sample(skewed.limit(5), 10).count() == 5
    assert sm.random_sample(skewed.limit(0), 10).count() == 0


def test_first_per_label(skewed):
    got = by_label(sm.first_per_label(skewed))
    assert {k: sorted(v) for k, v in got.items()} == {None: [1, 101, 201], 0: [0, 100, 200], 1: [2, 3, 4]}


@pytest.mark.parametrize("kind", ["distinct", "hot", "constant"])
def test_running_sums_and_percentiles(spark, kind):
    rng = np.random.default_rng(3)
    v = rng.normal(size=5000)
    if kind == "hot":
        v[:2000] = 0.25
    if kind == "constant":
        v[:] = 1.5
    df = spark.createDataFrame([(float(x),) for x in v], "x double")
    counts = df.groupBy("x").agg(F.count("*").alias("n"))
    got = {r["x"]: r["n_below"] for r in rk.running_sums(counts, "x", ["n"], rows_per_part=300).collect()}
    ordered = np.sort(v)
    assert got == {float(x): int(np.searchsorted(ordered, x)) for x in set(v)}
    row = rk.exact_percentiles(df, "x", {"a": 0.1, "b": 0.5, "c": 0.999}).head()
    assert np.allclose([row["a"], row["b"], row["c"]], np.quantile(v, [0.1, 0.5, 0.999]))


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 3, 10)], "x double")
    got = {r["bin"]: r["n"] for r in pf.histogram(df, "x", 5).collect()}
    assert got == {0: 2, 1: 2, 2: 0, 3: 0, 4: 1}
    flat = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    rows = pf.histogram(flat, "x", 4).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [0, 0, 2, 0] and rows[0]["bin_start"] == 1.5


def test_describe_text_tie_goes_to_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), ("c",), (None,)], "t string")
    assert tuple(pf.describe_text(df, "t").head()) == ("t", 5, 3, "a", 2)


def test_a_hot_key_stays_together(spark):
    """A third of the rows share one key: it is one row of counts, and is never cut in two."""
    df = spark.range(3000).select(F.when(F.col("id") < 1000, -1).otherwise(F.col("id")).alias("row_id"))
    out = sm.train_test_split(df, label=None).groupBy("row_id", "is_test").count().collect()
    assert len({r["is_test"] for r in out if r["row_id"] == -1}) == 1
    assert sum(r["count"] for r in out) == 3000


def test_many_groups_split(spark):
    df = spark.range(40_000).select(F.col("id").alias("row_id"), (F.col("id") % 20_000).alias("simen"))
    out = sm.train_test_split(df, label="simen", test_size=0.5).groupBy("simen").agg(
        F.sum(F.col("is_test").cast("int")).alias("n")
    )
    assert {(r["n"], r["count"]) for r in out.groupBy("n").count().collect()} == {(1, 20_000)}


def test_nan_and_infinity(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(x, None) for x in (1.0, 2.0, 3.0, nan, None)] + [(4.0, None)]
    df = spark.createDataFrame(rows, "x double, none double")
    got = {r["column_name"]: r for r in pf.describe_numeric(df, ["x", "none"]).collect()}
    assert (got["x"]["count"], got["x"]["mean"], got["x"]["p50"], got["x"]["max"]) == (4, 2.5, 2.5, 4.0)
    assert got["none"]["count"] == 0 and got["none"]["p50"] is None
    ends = spark.createDataFrame([(-inf,), (-inf,), (0.0,), (inf,), (inf,)], "x double")
    r = pf.describe_numeric(ends, ["x"]).first()
    assert (r["p25"], r["p50"], r["p75"]) == (-inf, 0.0, inf)
    bins = pf.histogram(df.union(ends.select("x", F.lit(None).cast("double"))), "x", bins=2).collect()
    assert [b["n"] for b in bins] == [2, 3] and bins[0]["bin_start"] == 0.0
    scores = spark.createDataFrame([(1, inf), (0, -inf), (1, 0.5), (0, 0.5), (1, nan)], "actual int, score double")
    assert metrics.roc_auc(scores).first()["auc"] == 0.875


def test_whole_numbers_are_not_gathered(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("key"))
    r = pf.describe_numeric(df, ["key"]).first()
    want = sorted(x["key"] for x in df.collect())
    assert r["count"] == 5000 and r["p50"] == (want[2499] + want[2500]) / 2


def exchanged(df):
    """Columns that pass an exchange in the plan that ran."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    del plan
    out = set()
    for block in text.split("\n\n"):
        if re.match(r"\s*\(\d+\) Exchange", block):
            for line in block.splitlines():
                if line.startswith("Input"):
                    out |= {c.split("#")[0] for c in line.split("[", 2)[-1].rstrip("]").split(", ")}
    return out


def test_texts_stay_in_place_in_splits_and_samples(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for out in (
        sm.train_test_split(docs, label="lang", key="doc_id"),
        sm.train_test_split(docs, label=None, key="doc_id"),
        sm.folds(docs, 3, label="lang", key="doc_id"),
        sm.stratified_sample(docs, 50, label="lang", key="doc_id"),
        sm.random_sample(docs, 50, key="doc_id"),
    ):
        assert "text" not in exchanged(out)
    moved = docs.repartition(3, "lang")
    assert "text" in exchanged(moved)  # the test sees what it looks for


@pytest.mark.parametrize("bounds", [rk.Bounds(3), rk.Bounds(3, 0, 0), rk.Bounds(3, 2, 1 << 25), rk.Bounds(20_000, 0, 0)])
def test_radix_steps_and_many_cutoffs_choose_the_same_rows(spark, bounds):
    """Buckets refined down to three rows, cut-offs too many to send: the same result."""
    key = F.when(F.col("id") < 5000, -7).when(F.col("id") % 11 == 0, None).otherwise(F.col("id"))
    label = F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 5)
    df = spark.range(15_000).select(key.alias("row_id"), label.alias("sentimen"))
    quota = lambda n, _t, _g: F.ceil(n / 3).cast("long")
    plain = rk.hash_lowest(df, "row_id", quota, by="sentimen")
    other = rk.hash_lowest(df, "row_id", quota, by="sentimen", bounds=bounds)
    tiles = rk.hash_tiles(df, "row_id", 3, by="sentimen")
    other_tiles = rk.hash_tiles(df, "row_id", 3, by="sentimen", bounds=bounds)
    for a, b in ((plain, other), (tiles, other_tiles)):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("rows, per_part", [(2_000, 100), (20_000, 100)])
def test_rows_of_a_range_do_not_grow_with_the_table(spark, rows, per_part):
    df = spark.range(rows).select((F.col("id") * 7919 % 20_011).cast("double").alias("x"), F.lit(1).alias("n"))
    sums = rk.running_sums(df, "x", ["n"], rows_per_part=per_part)
    ordered = sorted((r["x"], r["n_below"]) for r in sums.collect())
    assert [b for _, b in ordered] == list(range(rows))
    plan = sums._jdf.queryExecution().analyzed().toString()
    path = re.search(r"ranges-[0-9a-f]+", " ".join(sums.inputFiles())).group()
    assert "_range" in plan and path
    files = [f for f in sums.inputFiles() if "ranges-" in f]
    largest = spark.read.parquet(*files).groupBy("_range").count().agg(F.max("count")).first()[0]
    assert largest <= 4 * per_part


@pytest.mark.parametrize("small, accuracy", [(40, 50), (0, 1000)])
def test_brackets_find_exact_quantiles(spark, small, accuracy):
    """Sketches so rough, or last scans so small, that brackets are narrowed several times."""
    v = {c: np.random.default_rng(8).normal(size=3000) for c in ("normal", "ties", "two", "steps", "ends")}
    v["ties"][:1600] = 0.1
    v["two"] = np.where(v["two"] > 0, 1.0, 2.0)
    v["steps"] = np.floor(v["steps"] * 3)
    v["ends"][:900], v["ends"][900:1800] = -np.inf, np.inf
    df = spark.createDataFrame([tuple(map(float, x)) for x in zip(*v.values())], ", ".join(f"{c} double" for c in v))
    probs = {"a": 0.0, "b": 0.25, "c": 0.7501, "d": 1.0}
    got = rk.exact_quantiles(df.coalesce(2), probs, {c: 3000 for c in v}, small=small, accuracy=accuracy)
    for c, x in v.items():
        ordered = np.sort(x)
        for name, p in probs.items():
            at = 2999 * p
            lo, hi = ordered[math.floor(at)], ordered[math.ceil(at)]
            assert got[c][name] == pytest.approx(lo if lo == hi else lo + (hi - lo) * (at - math.floor(at)), rel=1e-12)


def test_texts_are_no_shuffle_keys_in_dedup_and_description(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert "text" not in exchanged(prep.dedup_rows(docs, "doc_id"))
    assert not {"text", "_v"} & exchanged(pf.describe_text(docs, "text"))


def test_dedup_by_digest_equals_grouping(spark):
    rows = [(1, "a", 0.0, None), (2, "a", -0.0, None), (3, "a", None, ["x"]), (4, "a", None, ["x"]), (5, "a,", None, ["x"])]
    rows += [(6, "", None, None), (7, None, None, None), (8, "", None, None), (9, None, float("nan"), None), (10, None, float("nan"), None)]
    rows += [(11, "1:", None, []), (12, "1", None, [None]), (13, "a", None, ["x"])]
    schema = "row_id long, t string, d double, l array<string>"
    df = spark.createDataFrame(rows, schema)
    want = sorted(r["row_id"] for r in df.groupBy("t", "d", "l").agg(F.min("row_id").alias("row_id")).collect())
    assert sorted(r["row_id"] for r in prep.dedup_rows(df, "row_id").collect()) == want == [1, 3, 5, 6, 7, 9, 11, 12]
    for odd in ([(1, "a", 0.0, None)], [(None, "a", 0.0, None)]):  # an id given twice, none given
        twice = df.unionByName(spark.createDataFrame(odd, schema))
        assert prep.dedup_rows(twice, "row_id").count() == len(want)
