"""What the tasks of the phrase operator hold at once, in Python and in the JVM."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from ulasan.llm import phrases

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def peak_of(work):
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def batch_sizes(df):
    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [b.nbytes], "rows": [b.num_rows]})

    return [tuple(r) for r in df.mapInArrow(sizes, "bytes long, rows long").collect()]


def test_batches_are_small_inside_only(spark):
    df = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("x"), 5000).alias("text"))
    for before in (None, "33554432"):
        if before:
            spark.conf.set(KEY, before)
        try:
            with phrases.small_batches(spark, 1 << 20):
                found = batch_sizes(df)
            assert sum(n for _, n in found) == 2000 and max(b for b, _ in found) < 1.2 * (1 << 20)
            with pytest.raises(ZeroDivisionError), phrases.small_batches(spark):
                1 / 0
            assert spark.conf.get(KEY, None) == before
        finally:
            spark.conf.unset(KEY)
    assert len(batch_sizes(df)) == 1


def test_every_step_in_python_gets_small_batches(spark, monkeypatch):
    seen = {}

    def spy(df, name, stored=phrases.stored):
        seen[name] = spark.conf.get(KEY, None)
        return stored(df, name)

    monkeypatch.setattr(phrases, "stored", spy)
    docs = spark.createDataFrame([("en", "a b c d e")] * 5, "lang string, text string")
    assert phrases.collocations(docs, least=5).count() == 2
    steps = ("phrase-index", "frequent-2", "frequent-3", "frequent-4")
    assert [seen[s] for s in steps] == [str(phrases.BATCH_BYTES)] * 4
    assert seen["phrases-2"] is None and spark.conf.get(KEY, None) is None


def test_a_shard_is_made_in_few_bytes_a_word():
    n = 400_000
    ids = np.random.default_rng(5).zipf(1.3, n).clip(0, 20_000).astype(np.int32)
    ids[::11] = 0
    names = [b"."] + [b"w%d" % i for i in range(20_000)]
    shards = phrases.Shards("en", n, 0, 64)
    assert peak_of(lambda: phrases.transform(ids, 20_001)) < 45 * n
    assert peak_of(lambda: list(shards._row(ids, names))) < 65 * n


def test_rows_that_are_added_up_are_not_held_twice():
    rng = np.random.default_rng(6)

    def parts():
        for _ in range(40):
            yield rng.integers(0, 1 << 60, (10_000, 4)), np.ones(10_000, np.int64)

    whole = 400_000 * 5 * 8

    def work():
        assert sum(len(a) for _, a in phrases.combined(parts(), 400_000)) == 400_000

    assert peak_of(work) < 3.1 * whole


def test_tasks_of_many_languages_hold_few_words(spark):
    rows = [(f"l{i % 20}", "a b c d e f g h i") for i in range(200)]
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    index, words = phrases.indexed(docs, 100, "lang", "text")
    # Twenty languages of 90 words: no task has held more than about 300 of these 1,800.
    assert index.agg(F.max("n")).first()[0] <= 45 and index.count() > 20
    assert words.agg(F.sum("a")).first()[0] == 1800 and words.count() == 180


def test_counts_are_dealt_out_before_they_are_added_up(spark):
    rows = [(1, 2, 3), (1, 2, 4), (5, 6, 1)]
    found = spark.createDataFrame(rows, "w1 long, w2 long, a long").repartition(3)
    made = phrases.counted(found, 2)
    assert sorted(tuple(r) for r in made.collect()) == [(1, 2, 7), (5, 6, 1)]
    plan = made._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.find("Initial Plan") if "Initial Plan" in plan else 0 :]
    assert "REPARTITION_BY_COL" in plan
    # Both sums stand above the exchange.
    assert plan.rfind("HashAggregate") < plan.find("Exchange hashpartitioning")
