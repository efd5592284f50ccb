import os
import random

import pytest
from pyspark.sql import functions as F

from ulasan.operators import vectors as vx
from ulasan.session import scratch_path
from ulasan.settings import CleanRules, IndexParams
from ulasan.sources import stores
from ulasan.sources import tables as src

TRICKY = ['plain', 'has, comma', 'has "quotes"', 'two\nlines', ' spaces kept ', 'comma, "and"\nline', '0']


def write_csv(folder, name, rows):
    lines = ["review,sentimen"]
    for text, label in rows:
        quoted = '"' + text.replace('"', '""') + '"'
        lines.append(f"{quoted},{label}")
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_csv_rows_are_numbered_across_files(spark, tmp_path):
    rows = [(f"{t} {i}", i % 2) for i in range(3) for t in TRICKY]
    for part in range(3):
        write_csv(tmp_path, f"part-{part}.csv", rows[part * 7 : part * 7 + 7])
    got = src.read_reviews_csv(spark, str(tmp_path)).orderBy("row_index").collect()
    assert [(r["row_index"], r["review"], r["sentimen"]) for r in got] == [
        (i, t, l) for i, (t, l) in enumerate(rows)
    ]


def test_csv_numbering_over_splits_of_one_file(spark, tmp_path):
    rows = [(f"row {i} " + "x" * 50, i % 2) for i in range(4000)]
    write_csv(tmp_path, "one.csv", rows)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = src.read_reviews_csv(spark, str(tmp_path), multi_line=False)
        assert df.select(F.spark_partition_id()).distinct().count() > 1
        got = {r["row_index"]: r["review"] for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {i: t for i, (t, _) in enumerate(rows)}


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_csv_records_with_inner_breaks_are_read_in_splits(spark, tmp_path, ends):
    """Records longer than a split, records that end with one, blank lines, and files of one record."""
    rng = random.Random(2)
    want = []
    for part in range(3):
        rows = [(rng.choice(TRICKY) + f" {part} {i} " + ("long\n" * 900 if i % 40 == 7 else "x\n" * rng.randint(0, 9)), i % 2) for i in range(150)]
        write_csv(tmp_path, f"part-{part}.csv", rows)
        path = tmp_path / f"part-{part}.csv"
        text = path.read_text().replace(",1\n", ",1\n\n") if part == 1 else path.read_text()
        path.write_bytes(text.replace("\n", ends).encode())
        want += rows
    (tmp_path / "part-4.csv").write_text("review,sentimen\n")
    (tmp_path / "part-5.csv").write_text('review,sentimen\nbare,\n"",1\nlast,0')
    want += [("bare", None), (None, 1), ("last", 0)]  # Spark reads "" as null
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = src.read_reviews_csv(spark, str(tmp_path))
        got = [(r["row_index"], r["review"], r["sentimen"]) for r in df.orderBy("row_index").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    by_file = src.read_reviews_csv(spark, str(tmp_path), by_file=True).orderBy("row_index").collect()
    assert [r[0] for r in got] == list(range(len(want)))
    assert [(t.replace("\r\n", "\n") if t else t, x) for _, t, x in got] == want
    if ends == "\n":
        assert got == [(r["row_index"], r["review"], r["sentimen"]) for r in by_file]


def test_csv_needs_the_review_column(spark, tmp_path):
    (tmp_path / "a.csv").write_text("text,sentimen\nhello,1\n")
    with pytest.raises(ValueError):
        src.read_reviews_csv(spark, str(tmp_path))
    with pytest.raises(Exception):
        src.load_table(spark, str(tmp_path / "absent.parquet"))


def test_prediction_files(spark):
    df = spark.createDataFrame(
        [(3, t, t.strip(), "Positive", 0.75, (0.25, 0.75)) for t in TRICKY],
        "row_index long, review string, review_clean string, sentiment string, confidence double, "
        "probabilities struct<negative: double, positive: double>",
    )
    path = stores.write_predictions(df, scratch_path(spark, "p") + ".txt")
    assert path.endswith(".txt.csv")
    options = {"header": True, "multiLine": True, "escape": '"'}
    options["ignoreLeadingWhiteSpace"] = options["ignoreTrailingWhiteSpace"] = False
    back = spark.read.options(**options).schema(stores.prediction_rows(df).schema).csv(path)
    assert back.columns == [
        "original_text", "clean_text", "predicted_sentiment", "confidence",
        "negative_probability", "positive_probability", "row_index",
    ]
    assert sorted(r["original_text"] for r in back.collect()) == sorted(TRICKY)
    path = stores.write_predictions(df, scratch_path(spark, "p") + ".parquet")
    assert spark.read.parquet(path).count() == len(TRICKY)


def test_settings_keep_absent_keys(spark):
    path = scratch_path(spark, "settings")
    stores.save_settings(spark, CleanRules(min_len=9, slang={"a": "b"}), path)
    assert stores.load_settings(spark, path) == CleanRules(min_len=9, slang={"a": "b"})
    assert CleanRules(min_len=7).updated({"profile": "basic"}) == CleanRules(min_len=7, profile="basic")


def test_index_round_trip(spark, sf):
    params = IndexParams(index_type="l2", normalize=False, max_query_rows=77)
    index = vx.build_index(src.vectors(spark, sf), params=params)
    path = scratch_path(spark, "index")
    stores.save_index(index, path, params)
    back, loaded = stores.load_index(spark, path)
    assert loaded == params
    assert back.exceptAll(index).count() == 0 and back.count() == index.count()
