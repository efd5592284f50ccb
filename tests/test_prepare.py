import pytest
from pyspark.sql import functions as F

from ulasan.operators import prepare as prep
from ulasan.settings import CleanRules
from ulasan.sources.tables import require_columns

ROWS = [
    (0, "Produk bagus sekali", "1", "good"),
    (1, "Produk bagus sekali", "1", "good"),
    (2, "PRODUK bagus sekali!", "1", "good"),
    (3, None, "0", "x"),
    (4, "ok", "0", "x"),
    (5, "sangat jelek", "bad", None),
    (6, "sangat jelek", "0", None),
    (7, "abcde", "1.0", "x"),
]
SCHEMA = "row_id long, review string, sentimen string, translate string"


def test_prepare_full_and_counts(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = {r["row_id"]: (r["review_clean"], r["sentimen"]) for r in prep.prepare(df).collect()}
    # Equal cleaned texts survive: copies are found on the source columns.
    assert out == {
        0: ("produk bagus sekali", 1),
        2: ("produk bagus sekali", 1),
        6: ("sangat jelek", 0),
        7: ("abcde", 1),
    }
    counts = prep.prepare_counts(df).head().asDict()
    assert counts == {
        "n_input": 8, "n_duplicates": 1, "n_null": 1, "n_short": 1, "n_bad_label": 1, "n_output": 4
    }
    kept = prep.prepare_counts(df, CleanRules(remove_duplicates=False)).head()
    assert (kept["n_duplicates"], kept["n_output"]) == (0, 5)


def test_prepare_basic_is_strict_on_length_and_nulls(spark):
    df = spark.createDataFrame([r for r in ROWS if r[2] != "bad"], SCHEMA)
    df = df.withColumn("sentimen", F.expr("cast(cast(sentimen as double) as int)"))
    out = prep.prepare(df, CleanRules(profile="basic"))
    assert sorted(r["row_id"] for r in out.collect()) == [0, 2]


def test_dedup_treats_nulls_as_equal_and_is_idempotent(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, "a"), (3, "b", None)], "row_id long, x string, y string")
    once = prep.dedup_rows(df, "row_id")
    assert sorted(tuple(r) for r in once.collect()) == [(1, None, "a"), (3, "b", None)]
    assert prep.dedup_rows(once, "row_id").count() == 2


@pytest.mark.parametrize(
    "labels,valid,bad", [([0, 1, 1], True, 0), ([0, 2, None], False, 2)]
)
def test_validate(spark, labels, valid, bad):
    df = spark.createDataFrame([("x", v) for v in labels] + [(" ", 1), (None, 0)], "review string, sentimen int")
    row = prep.validate(df).head()
    assert (row["is_valid"], row["n_bad_labels"], row["n_empty"]) == (valid, bad, 2)
    missing = prep.validate(df.drop("sentimen")).head()
    assert (missing["missing_cols"], missing["is_valid"]) == ("sentimen", False)
    with pytest.raises(ValueError):
        require_columns(df, "review", "absent")


def test_rejects_carry_a_reason(spark):
    df = spark.createDataFrame([(0, None), (1, " "), (2, "a1"), (3, "fine text")], "row_index long, review string")
    out = prep.flag_rejects(prep.with_clean(df)).orderBy("row_index").collect()
    assert [r["reject_reason"] for r in out] == ["blank", "blank", "too_short", None]
    assert prep.skip_blank(df).count() == 2
