"""Validation, row filters, label coercion and the whole preparation step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ulasan.functions import text as tx
from ulasan.operators.ranking import settled
from ulasan.session import stored
from ulasan.settings import REQUIRED_COLUMNS, CleanRules


def validate(df: DataFrame) -> DataFrame:
    """One row: missing columns, blank reviews (a warning), bad labels, and the verdict."""
    missing = [c for c in REQUIRED_COLUMNS if c not in df.columns]
    n_empty = (
        F.count_if(tx.is_blank(F.col("review"))) if "review" in df.columns else F.lit(None).cast("long")
    )
    if "sentimen" in df.columns:
        value = F.expr("try_cast(sentimen AS DOUBLE)")
        n_bad = F.count_if(~F.coalesce(value.isin(0.0, 1.0), F.lit(False)))
    else:
        n_bad = F.lit(None).cast("long")
    row = df.agg(F.count("*").alias("n_rows"), n_empty.alias("n_empty"), n_bad.alias("n_bad_labels"))
    return row.select(
        F.lit(",".join(missing)).alias("missing_cols"),
        "n_rows",
        "n_empty",
        "n_bad_labels",
        (F.lit(not missing) & F.coalesce(F.col("n_bad_labels") == 0, F.lit(False))).alias("is_valid"),
    )


def row_digest(df: DataFrame, cols: list[str]) -> Column:
    """256 bits that two rows share if their values do; nulls, zeros of either sign and NaN are equal."""
    parts = []
    for c in cols:
        kind = df.schema[c].dataType
        if isinstance(kind, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
            written = F.to_json(F.struct(c), {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})
        elif isinstance(kind, T.BinaryType):
            written = F.hex(c)
        else:
            x = F.col(f"`{c}`")
            written = (x + F.lit(0).cast(kind) if isinstance(kind, (T.FloatType, T.DoubleType)) else x).cast("string")
        # The length parts a value from the next one.
        parts.append(F.coalesce(F.concat(F.length(written).cast("string"), F.lit(":"), written), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def dedup_rows(df: DataFrame, row_id: str | None = None) -> DataFrame:
    """Whole-row duplicates out; with `row_id`, the lowest id of the source columns stays.

    With an id, rows are grouped by a digest of their columns, so only digests and ids are shuffled. The
    ids that go are sent to the rows where their counted size allows it, and then no row is moved either;
    more of them meet the rows in a shuffle by id. Without an id, copies are merged in each map task first.
    """
    if row_id is None:
        return df.distinct()
    cols = [c for c in df.columns if c != row_id]
    keyed = stored(df.select(row_digest(df, cols).alias("_digest"), F.col(row_id).alias("_id")), "digests")
    # Copies of a digest and id are counted first, so a hot text is a few rows of a task.
    ids = keyed.groupBy("_digest", "_id").agg(F.count("*").alias("_n"))
    first = F.min(F.when(F.col("_id").isNotNull(), F.struct("_id", "_n")))
    copied = ids.groupBy("_digest").agg(first.alias("_first"), F.sum("_n").alias("_n"), F.count_if(F.col("_id").isNull()).alias("_none"))
    copied = copied.where("_n > 1").select(
        "_digest", F.col("_first._id").alias("_first"), ((F.col("_first._n") > 1) | (F.col("_none") > 0)).alias("_twice")
    )
    copied, _, rows = settled(copied, "copied")
    twice = any(r["_twice"] for r in rows) if rows is not None else not copied.where("_twice").isEmpty()
    if twice:
        # Ids that are missing or given twice don't tell copies apart.
        return df.groupBy(*cols).agg(F.min(row_id).alias(row_id)).select(*df.columns)
    if rows is not None and not rows:
        return df
    gone = keyed.join(copied, "_digest").where(F.col("_id") > F.col("_first")).select(F.col("_id").alias("_gone"))
    gone, _, _ = settled(gone, "gone")
    return df.join(gone, F.col(row_id) == F.col("_gone"), "left_anti")


def drop_null_reviews(df: DataFrame) -> DataFrame:
    return df.na.drop(subset=["review"])


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def min_length(df: DataFrame, n: int = 5, col: str = "review_clean", strict: bool = False) -> DataFrame:
    length = F.length(col)
    return df.filter(length > n if strict else length >= n)


def coerced_label(label: str = "sentimen") -> Column:
    """A whole number where the value can be read as a number, else null."""
    return F.expr(f"try_cast(try_cast(`{label}` AS DOUBLE) AS INT)")


def coerce_labels(df: DataFrame, label: str = "sentimen") -> DataFrame:
    return df.withColumn(label, coerced_label(label)).na.drop(subset=[label])


def cast_labels(df: DataFrame, label: str = "sentimen") -> DataFrame:
    return df.withColumn(label, F.col(label).cast("int"))


def with_clean(df: DataFrame, rules: CleanRules = CleanRules(), source: str = "review") -> DataFrame:
    """Adds `review_clean`.

    A one-element generator keeps later filters on the cleaned text above it. As a plain column the
    whole cleaning would be copied into such filters, run twice, and be pushed into the scan.
    """
    return df.withColumn("review_clean", F.explode(F.array(tx.clean(F.col(source), rules))))


def prepare(
    df: DataFrame, rules: CleanRules = CleanRules(), row_id: str | None = "row_id"
) -> DataFrame:
    """Dedup, drop null reviews, clean, drop short texts, coerce labels.

    The basic profile drops rows with any null and keeps texts strictly longer than the bound.
    """
    basic = rules.profile == "basic"
    out = dedup_rows(df, row_id) if rules.remove_duplicates else df
    out = drop_any_null(out) if basic else drop_null_reviews(out)
    out = min_length(with_clean(out, rules), rules.min_len, strict=basic)
    if "sentimen" in df.columns:
        out = cast_labels(out) if basic else coerce_labels(out)
    return out


def prepare_counts(
    df: DataFrame, rules: CleanRules = CleanRules(), row_id: str | None = "row_id"
) -> DataFrame:
    """Rows removed by each step of `prepare`, counted in one pass over the merged copies."""
    cols = [c for c in df.columns if c != row_id]
    if rules.remove_duplicates:
        groups = df.groupBy(*cols).agg(F.count("*").alias("_copies"))
    else:
        groups = df.withColumn("_copies", F.lit(1))
    basic = rules.profile == "basic"
    checked = cols if basic else ["review"]
    has_all = F.lit(True)
    for c in checked:
        has_all = has_all & F.col(c).isNotNull()
    length = F.length(tx.clean(F.col("review"), rules))
    long_enough = length > rules.min_len if basic else length >= rules.min_len
    good_label = coerced_label().isNotNull() if "sentimen" in df.columns else F.lit(True)
    flagged = groups.select(
        "_copies",
        has_all.alias("_has"),
        long_enough.alias("_long"),
        good_label.alias("_label"),
    )
    kept_long = F.col("_has") & F.col("_long")
    return flagged.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).cast("long").alias("n_input"),
        F.coalesce(F.sum("_copies") - F.count("*"), F.lit(0)).cast("long").alias("n_duplicates"),
        F.count_if(~F.col("_has")).alias("n_null"),
        F.count_if(F.col("_has") & ~F.col("_long")).alias("n_short"),
        F.count_if(kept_long & ~F.col("_label")).alias("n_bad_label"),
        F.count_if(kept_long & F.col("_label")).alias("n_output"),
    )


def flag_rejects(df: DataFrame, min_chars: int = 3, source: str = "review") -> DataFrame:
    """Every input row with `review_clean` and `reject_reason`: blank, too_short, or null."""
    clean = F.col("review_clean")
    return df.withColumn(
        "reject_reason",
        F.when(tx.is_blank(F.col(source)), "blank").when(F.length(clean) < min_chars, "too_short"),
    )


def skip_blank(df: DataFrame, source: str = "review") -> DataFrame:
    return df.filter(~tx.is_blank(F.col(source)))


def low_confidence(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    return df.withColumn("low_confidence", F.col("confidence") < threshold)
