"""Dataset, text, vector and result profiles. Each is one or two map-side combined aggregations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ulasan.functions import text as tx
from ulasan.functions.vector import l2_norm, row_mean, row_std
from ulasan.operators.ranking import beside, exact_quantiles, settled
from ulasan.session import stored


def _share(n: Column, total: Column) -> Column:
    return F.when(total > 0, n * 100.0 / total)


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def _length_figures() -> dict[str, Column]:
    """Length statistics over rows of `(_len, _n)`."""
    n, length = F.col("_n"), F.col("_len")
    return {
        "mean_length": F.sum(length * n) / F.sum(F.when(length.isNotNull(), n)),
        "median_length": F.percentile("_len", F.lit(0.5), n),
        "min_length": F.min("_len").cast("long"),
        "max_length": F.max("_len").cast("long"),
    }


def dataset_info(df: DataFrame, label: str = "sentimen", text: str = "review") -> DataFrame:
    """One row per label: its count and share of all rows, with table totals and length statistics.

    Rows are first merged to (label, length, nulls in the row). The total is one more row of the
    same roll-up, so the text is read once.
    """
    nulls = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in df.columns])
    cells = (
        df.select(F.col(label).alias("label"), F.length(text).alias("_len"), nulls.alias("_nulls"))
        .groupBy("label", "_len", "_nulls")
        .agg(F.count("*").alias("_n"))
    )
    figures = {"n_missing": F.sum(F.col("_nulls") * F.col("_n")), **_length_figures()}
    rows = cells.rollup("label").agg(
        F.grouping_id().alias("_total"),
        F.sum("_n").alias("n"),
        *[c.alias(name) for name, c in figures.items()],
    )
    everything = Window.partitionBy(F.lit(1))

    def of_table(name: str) -> Column:
        return F.max(F.when(F.col("_total") == 1, F.col(name))).over(everything)

    spread = rows.select(
        "_total", "label", "n", of_table("n").alias("n_rows"), *[of_table(f).alias(f) for f in figures]
    )
    return spread.filter((F.col("_total") == 0) & F.col("label").isNotNull()).select(
        "label",
        tx.label_name(F.col("label")).alias("label_name"),
        "n",
        _share(F.col("n"), F.col("n_rows")).alias("pct"),
        "n_rows",
        *figures,
    )


def dataset_statistics(df: DataFrame, label: str = "sentimen", text: str = "review") -> DataFrame:
    """`(metric, item, value)` rows: totals, nulls per column, label counts, length statistics.

    All parts come from one roll-up of row counts per (label, length, null pattern).
    """
    flags = [F.col(c).isNull().cast("int").alias(f"_null_{c}") for c in df.columns]
    cells = (
        df.select(
            F.col(label).cast("string").alias("_label"), tx.char_length(F.col(text)).alias("_len"), *flags
        )
        .groupBy("_label", "_len", *[f"_null_{c}" for c in df.columns])
        .agg(F.count("*").alias("_n"))
    )
    n = F.col("_n")
    figures = [
        ("total_samples", "", F.sum(n)),
        ("columns", "", F.lit(len(df.columns))),
        *[("missing_values", c, F.sum(F.col(f"_null_{c}") * n)) for c in df.columns],
        *[("text", name, c) for name, c in _length_figures().items()],
    ]
    rolled = cells.rollup("_label").agg(
        F.grouping_id().alias("_total"),
        *[c.cast("double").alias(f"f{i}") for i, (_, _, c) in enumerate(figures)],
    )

    def row(metric: str, item: Column, value: Column) -> Column:
        return F.struct(F.lit(metric).alias("metric"), item.alias("item"), value.alias("value"))

    of_table = F.array(*[row(m, F.lit(item), F.col(f"f{i}")) for i, (m, item, _) in enumerate(figures)])
    of_label = F.array(row("label_count", F.col("_label"), F.col("f0")))
    wanted = F.when(F.col("_total") == 1, of_table).when(F.col("_label").isNotNull(), of_label)
    return rolled.select(F.inline(wanted))


def missing_values(df: DataFrame) -> DataFrame:
    """Null counts, one row per column, counted in one pass."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_missing")) for c in df.columns]
    )
    return row.select(F.inline(pairs))


def text_statistics(df: DataFrame, text: str = "review") -> DataFrame:
    """Totals, blank texts, and lengths and words over texts that are not empty; 0 when none are."""
    t = F.col(text)
    filled = t.isNotNull() & (t != "")
    cells = (
        df.select(
            tx.is_blank(t).cast("int").alias("_blank"),
            F.when(filled, tx.char_length(t)).alias("_len"),
            F.when(filled, tx.word_count(t)).alias("_words"),
        )
        .groupBy("_blank", "_len", "_words")
        .agg(F.count("*").alias("_n"))
    )
    used = F.sum(F.when(F.col("_len").isNotNull(), F.col("_n")))
    return cells.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_texts"),
        F.coalesce(F.sum(F.col("_blank") * F.col("_n")), F.lit(0)).alias("empty_texts"),
        _zero(F.sum(F.col("_len") * F.col("_n")) / used).alias("avg_length"),
        _zero(F.percentile("_len", F.lit(0.5), F.col("_n"))).alias("median_length"),
        F.coalesce(F.min("_len"), F.lit(0)).alias("min_length"),
        F.coalesce(F.max("_len"), F.lit(0)).alias("max_length"),
        _zero(F.sum(F.col("_words") * F.col("_n")) / used).alias("avg_words"),
        _zero(F.percentile("_words", F.lit(0.5), F.col("_n"))).alias("median_words"),
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))


def value_shares(df: DataFrame, col: str, over_all_rows: bool = False) -> DataFrame:
    """Counts with their percentage of the non-null rows, or of all rows."""
    counts = df.groupBy(col).agg(F.count("*").alias("n"))
    if not over_all_rows:
        counts = counts.filter(F.col(col).isNotNull())
    shares = beside(counts, counts.agg(F.sum("n").alias("_total")))
    return shares.filter(F.col(col).isNotNull()).select(
        col, "n", _share(F.col("n"), F.col("_total")).alias("pct")
    )


def class_balance(df: DataFrame, label: str = "sentimen", bound: float = 0.8) -> DataFrame:
    ratio = F.min("n") / F.max("n")
    return value_counts(df, label).agg(
        F.min("n").alias("smallest_class"),
        F.max("n").alias("largest_class"),
        ratio.alias("balance_ratio"),
        (ratio < bound).alias("is_imbalanced"),
    )


QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
DESCRIBED = ("column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def describe_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum, one row per column.

    NaN counts as null. A column without values has count 0 and nulls. One scan gives the figures, the
    quartiles take two more however large the table is (see `ranking.exact_quantiles`), and nothing but
    aggregates is shuffled. Cells of the result are as many as the columns have figures.
    """
    df = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in cols])
    figures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    row = df.agg(*[f(c).alias(f"{c}_{m}") for c in cols for m, f in figures.items()]).first()
    found = exact_quantiles(df, QUARTILES, {c: row[f"{c}_count"] for c in cols})
    rows = []
    for c in cols:
        cells = {"column_name": c, **{m: row[f"{c}_{m}"] for m in figures}, **found[c]}
        rows.append(tuple(cells[x] for x in DESCRIBED))
    kinds = {"column_name": "string", "count": "long"}
    return df.sparkSession.createDataFrame(rows, ", ".join(f"`{x}` {kinds.get(x, 'double')}" for x in DESCRIBED))


def describe_text(df: DataFrame, col: str) -> DataFrame:
    """Count, distinct values, and the most frequent value; the smallest wins a tie.

    Values are counted by their digest. Only those that are as frequent as the most frequent one are then
    looked at as texts, and each task gives the smallest of its own, so no text is a shuffle key.
    """
    texts = df.where(F.col(col).isNotNull()).select(F.col(col).cast("string").alias("_v"))
    digest = F.sha2("_v", 256).alias("_d")
    counts = stored(texts.groupBy(digest).agg(F.count("*").alias("n")), "digests")
    total, unique, most = counts.agg(F.sum("n"), F.count("*"), F.max("n")).first()
    tied = texts
    if most is not None and most > 1:
        best, _, _ = settled(counts.where(F.col("n") == most).select("_d"), "tied")
        tied = texts.withColumn("_d", digest).join(best, "_d", "left_semi")
    return tied.agg(F.min("_v").alias("top")).select(
        F.lit(col).alias("column_name"),
        F.lit(total or 0).cast("long").alias("count"),
        F.lit(unique).cast("long").alias("unique"),
        "top",
        F.lit(most).cast("long").alias("freq"),
    )


def quartiles_by_label(df: DataFrame, col: str, label: str = "sentimen") -> DataFrame:
    """Box-plot figures per label: count, minimum, quartiles, maximum."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(label, col).agg(F.count("*").alias("_n"))
    return counts.groupBy(label).agg(
        F.sum("_n").alias("n"),
        F.min(col).alias("min"),
        *[
            F.percentile(col, F.lit(p), F.col("_n")).alias(name)
            for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
        ],
        F.max(col).alias("max"),
    )


def histogram(df: DataFrame, col: str, bins: int = 50, by: str | None = None) -> DataFrame:
    """Equal-width bins over [min, max] of each group, the last bin closed, empty bins kept.

    A constant column gets a range of one around its value. Null, NaN and infinite values are left
    out. One scan finds the ranges and a second counts bins, so no value is a shuffle key.
    """
    grp = F.col(by) if by else F.lit("all")
    x = F.col(col).cast("double")
    rows = df.select(grp.alias("_grp"), x.alias("_x")).filter(
        F.col("_x").isNotNull() & ~F.isnan("_x") & (F.abs("_x") < float("inf"))
    )
    edges = (
        rows.groupBy("_grp")
        .agg(F.min("_x").alias("_a"), F.max("_x").alias("_b"))
        .select(
            F.col("_grp").alias("grp"),
            F.when(F.col("_a") == F.col("_b"), F.col("_a") - 0.5).otherwise(F.col("_a")).alias("lo"),
            F.when(F.col("_a") == F.col("_b"), F.col("_b") + 0.5).otherwise(F.col("_b")).alias("hi"),
        )
        .withColumn("width", (F.col("hi") - F.col("lo")) / bins)
    )
    placed = rows.join(edges, F.col("_grp") == F.col("grp"))
    bin_no = F.least(F.floor((F.col("_x") - F.col("lo")) / F.col("width")), F.lit(bins - 1))
    filled = placed.groupBy("grp", bin_no.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    grid = edges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    out = grid.join(filled, ["grp", "bin"], "left").select(
        *([F.col("grp").alias(by)] if by else []),
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
    return out


def embedding_statistics(df: DataFrame, col: str = "embedding") -> DataFrame:
    """Shape, mean, population deviation, range over all elements, and the row norms.

    Each vector gives its own mean and deviation, which are then pooled, so elements are neither
    exploded nor read twice. All vectors have one length.
    """
    v = F.col(col)
    rows = df.select(
        F.size(v).alias("d"),
        row_mean(v).alias("m"),
        row_std(v).alias("s"),
        l2_norm(v).alias("norm"),
        F.array_min(v).cast("double").alias("lo"),
        F.array_max(v).cast("double").alias("hi"),
    )
    return rows.agg(
        F.count("*").alias("n_vectors"),
        F.max("d").alias("dimension"),
        F.avg("m").alias("mean"),
        F.sqrt(F.avg(F.col("s") * F.col("s")) + F.var_pop("m")).alias("std"),
        F.min("lo").alias("min"),
        F.max("hi").alias("max"),
        F.avg("norm").alias("norm_mean"),
        F.stddev_pop("norm").alias("norm_std"),
    )


def embedding_row_statistics(df: DataFrame, key: str = "vec_id", col: str = "embedding") -> DataFrame:
    return df.select(
        key, row_mean(F.col(col)).alias("row_mean"), row_std(F.col(col)).alias("row_std")
    )


def batch_summary(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Counts and shares of both names, mean confidence, rows below the threshold."""
    name, conf = F.col("sentiment"), F.col("confidence")
    n, pos = F.count("*"), F.count_if(name == "Positive")
    neg = F.count_if(name == "Negative")
    return scored.agg(
        n.alias("n_rows"),
        pos.alias("n_positive"),
        neg.alias("n_negative"),
        _share(pos, n).alias("pct_positive"),
        _share(neg, n).alias("pct_negative"),
        _zero(F.avg(conf)).alias("avg_confidence"),
        F.count_if(conf < threshold).alias("n_low_confidence"),
    )


def batch_first_rows(scored: DataFrame, n: int = 5, chars: int = 80) -> DataFrame:
    return scored.orderBy("row_index").limit(n).select(
        "row_index",
        tx.preview(F.col("text"), chars).alias("text_preview"),
        "sentiment",
        "confidence",
    )


def split_distribution(split: DataFrame, label: str = "sentimen") -> DataFrame:
    name = F.when(F.col("is_test"), "test").otherwise("train")
    counts = split.groupBy(name.alias("split"), label).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("split"))
    return counts.withColumn("pct", _share(F.col("n"), total))


def corpus_report(df: DataFrame, label: str = "sentimen", clean: str = "review_clean") -> DataFrame:
    n = F.count("*")
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return df.agg(
        n.alias("total_reviews"),
        pos.alias("n_positive"),
        neg.alias("n_negative"),
        _share(pos, n).alias("pct_positive"),
        _share(neg, n).alias("pct_negative"),
        F.avg(tx.char_length(F.col(clean))).alias("avg_length"),
        F.avg(tx.word_count(F.col(clean))).alias("avg_words"),
    )


def confidence_by_outcome(
    scored: DataFrame, label: str = "sentimen", predicted: str = "prediction"
) -> DataFrame:
    """Confidence of right and wrong predictions, per true label."""
    return scored.groupBy(
        (F.col(label) == F.col(predicted)).alias("correct"), F.col(label).alias("label")
    ).agg(
        F.count("*").alias("n"),
        F.avg("confidence").alias("avg_confidence"),
        F.min("confidence").alias("min_confidence"),
        F.max("confidence").alias("max_confidence"),
    )
