import os

import pytest
from pyspark.sql import functions as F

from ulasan.plans import jobs
from ulasan.session import scratch_path
from ulasan.settings import TrainParams
from ulasan.sources import tables as src
from ulasan.streaming import scoring as st

GOOD = "barang bagus mantap puas cepat murah ramah".split()
BAD = "rusak jelek kecewa lambat mahal buruk kasar".split()


@pytest.fixture(scope="module")
def reviews(spark):
    rows = []
    for i in range(200):
        words = (GOOD if i % 2 else BAD)[: 3 + i % 4]
        rows.append((i, f"Toko {i}: " + " ".join(words) + " bgt!" * (i % 3), i % 2))
    return spark.createDataFrame(rows, "row_id long, review string, sentimen int")


@pytest.fixture(scope="module")
def run(reviews):
    return jobs.train_job(reviews, params=TrainParams(dim=128, k_features=60))


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "row_index long, review string")


def test_training_learns_the_words(spark, run):
    info = jobs.run_info(spark, run).head()
    assert info["test_accuracy"] == 1.0 and info["index_built"]
    # Texts differ only by their number, so some cleaned texts are equal; all rows stay.
    assert info["dataset_size"] == 200


def test_scoring_keeps_rows_and_reports_rejects(spark, run):
    df = texts(spark, ["Bagus, puas!", None, "  ", "12", "jelek dan rusak http://a.b", "ok"])
    scored, rejects = jobs.score(run, df)
    got = {r["row_index"]: (r["review_clean"], r["sentiment"]) for r in scored.collect()}
    assert got == {0: ("bagus puas", "Positive"), 4: ("jelek dan rusak", "Negative")}
    assert {r["row_index"]: r["reject_reason"] for r in rejects.collect()} == {
        1: "blank", 2: "blank", 3: "too_short", 5: "too_short"
    }
    assert jobs.score_text(spark, run, "mantap").head()["sentiment"] == "Positive"
    assert jobs.score_text(spark, run, "?").count() == 0


def test_neighbours_are_nested_in_rank_order(spark, run):
    df = texts(spark, ["bagus puas mantap", "rusak jelek kecewa"])
    out = {r["row_index"]: r for r in jobs.score_with_neighbours(run, df, 3).collect()}
    for i, name in enumerate(["Positive", "Negative"]):
        hits = out[i]["similar_reviews"]
        assert [h["rank"] for h in hits] == [1, 2, 3]
        assert all(h["sentiment"] == name for h in hits)
    capped = jobs.score_with_neighbours(run, df, 3, cap=1).orderBy("row_index").collect()
    assert [r["similar_reviews"] is None for r in capped] == [False, True]


def test_saved_run_scores_alike(spark, run):
    path = scratch_path(spark, "run")
    jobs.save_run(run, path)
    back = jobs.load_run(spark, path)
    df = texts(spark, ["bagus sekali", "kecewa berat"])
    key = ["row_index", "prediction", "confidence"]
    a = jobs.score(run, df)[0].select(*key).orderBy("row_index").collect()
    assert a == jobs.score(back, df)[0].select(*key).orderBy("row_index").collect()
    assert back.rules == run.rules and back.index.count() == run.index.count()


def test_training_stores_its_texts_once(run):
    """The index reads the prepared rows with their token counts; there is no copy of its own."""
    assert {x.rsplit("/", 2)[1].rsplit("-", 1)[0] for x in run.index.inputFiles()} == {"token-counts"}


def test_bad_input_stops_the_job(spark, reviews):
    with pytest.raises(ValueError):
        jobs.train_job(reviews.withColumn("sentimen", F.lit(3)))
    with pytest.raises(ValueError):
        jobs.train_job(reviews.withColumn("review", F.lit("x")))
    with pytest.raises(ValueError):
        jobs.train_job(reviews.drop("review"))


def test_sampled_run_without_index(spark, reviews):
    small = jobs.train_job(reviews, params=TrainParams(dim=64, k_features=None), sample=100, skip_index=True, with_cv=False)
    assert small.n_rows == 100 and small.index is None and len(small.classifier.selected) == 64
    with pytest.raises(ValueError):
        jobs.search_texts(small, texts(spark, ["x"]).withColumnRenamed("row_index", "query_id"))


def test_stream_restarts_where_it_stopped(spark, run):
    folder, out, progress = (scratch_path(spark, n) for n in ("in", "out", "progress"))
    schema = texts(spark, ["x"]).schema

    def step(first, values):
        df = texts(spark, values).withColumn("row_index", F.col("row_index") + first)
        df.coalesce(1).write.mode("append").parquet(folder)
        stream = st.score_stream(run, st.read_texts(spark, folder, schema))
        st.write_stream(stream, out, progress).awaitTermination()
        return {r["row_index"]: r["sentiment"] for r in spark.read.parquet(out).collect()}

    assert step(0, ["bagus puas", "1"]) == {0: "Positive"}
    assert step(10, ["jelek rusak"]) == {0: "Positive", 10: "Negative"}


@pytest.mark.parametrize("parts", [0, 3])
def test_streams_read_a_table_that_is_a_file_or_a_folder(spark, parts):
    """`documents.parquet` may be one file or a folder of part files; both give every row."""
    from __spark_entry__ import queries

    at = scratch_path(spark, "tables")
    docs = texts(spark, [f"Toko nomor {x} bagus" for x in "abcdefgh"]).toDF("doc_id", "text")
    if parts:
        docs.repartition(parts).write.parquet(f"{at}/documents.parquet")
    else:
        os.makedirs(at)
        docs.toPandas().to_parquet(f"{at}/documents.parquet")
    got = queries()["st1_stream_clean"](spark, at).collect()
    assert {r["row_index"]: r["review_clean"] for r in got} == {i: f"toko nomor {x} bagus" for i, x in enumerate("abcdefgh")}


def test_a_folder_is_scored_as_a_stream_like_a_batch(spark, run):
    at, out = scratch_path(spark, "tables"), scratch_path(spark, "out")
    df = texts(spark, ["bagus puas", "jelek rusak", "1", "murah ramah"])
    df.repartition(2).write.parquet(f"{at}/documents.parquet")
    stream = st.score_stream(run, st.read_dataset(spark, f"{at}/documents.parquet", df.schema))
    st.write_stream(stream, out, scratch_path(spark, "progress")).awaitTermination()
    key = ["row_index", "prediction", "confidence"]
    want = jobs.score(run, df)[0].select(*key).orderBy("row_index").collect()
    assert len(want) == 3 and spark.read.parquet(out).select(*key).orderBy("row_index").collect() == want


def test_entry_and_registry_agree(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 2
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_source(spark, sf):
    assert src.reviews(spark, sf).count() == 87
