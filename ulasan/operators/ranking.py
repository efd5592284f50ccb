"""Exact ranks, cut-offs and running sums that never bring one whole group into one task.

A label holds half of all rows, so `row_number()` over a label would sort half the table in one
task. These helpers count rows per small hash or value bucket first, turn the counts into offsets,
and sort only inside a bucket.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ulasan.session import stored

DIGITS = 3  # hexadecimal digits of the hash that one step of the selection looks at: 4,096 buckets


@dataclass(frozen=True)
class Bounds:
    """Rows that one task may sort, and rows or bytes of a table that may be sent to every task."""

    sorted_rows: int = 20_000
    sent_rows: int = 10_000
    sent_bytes: int = 32 << 20


def beside(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Every row of `df` with the columns of a one-row aggregate."""
    one = F.lit(1)
    right = F.broadcast(one_row.withColumn("_one", one))
    return df.withColumn("_one", one).join(right, "_one").drop("_one")


def hash_order(key: str, seed: int = 42) -> Column:
    """A fixed pseudo-random order of keys."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def settled(table: DataFrame, name: str, bounds: Bounds = Bounds()) -> tuple[DataFrame, bool, list[Row] | None]:
    """A table that is worked out once, whether it is small enough to be sent to every task (and then
    marked for that), and its rows if there are few.

    Up to `sent_rows` rows are fetched and go with the plan. A longer table is written, and sent if its
    counted size is at most `sent_bytes`.
    """
    rows = table.limit(bounds.sent_rows + 1).collect() if bounds.sent_rows else []
    if bounds.sent_rows >= len(rows) > 0 or bounds.sent_rows and not rows:
        return F.broadcast(table.sparkSession.createDataFrame(rows, table.schema)), True, rows
    lying = stored(table, name)
    width = sum((F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) + 16 for c in lying.columns), F.lit(0))
    size = lying.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    return (F.broadcast(lying), True, None) if size <= bounds.sent_bytes else (lying, False, None)


def hash_cutoffs(
    df: DataFrame,
    key: str,
    ranks: Callable[[Column, Column, Column], Column],
    by: str | None = None,
    seed: int = 42,
    bounds: Bounds = Bounds(),
) -> tuple[DataFrame, bool]:
    """The key standing at given ranks of the hash order, for each group, and whether that table is
    small enough to be sent to every task.

    `ranks(group_n, total_n, n_groups)` returns the array of 1-based ranks wanted. The result is
    one short row per group and rank: `grp, rank, cut_hash, cut_key`. This is a radix selection: rows
    are counted per group and by the first digits of their hash, and only the bucket that holds a wanted
    rank is counted by its next digits, until no such bucket has more than `sorted_rows` rows of different
    hashes. The buckets left are sorted. Each step reads keys and groups alone and shuffles counts.
    `key` should be unique; rows that share a key stay on one side of a cut-off.
    """
    group = F.col(by).cast("string") if by else F.lit("all")
    keyed = df.select(
        group.alias("grp"), F.col(key).alias("cut_key"), hash_order(key, seed).alias("cut_hash")
    )
    counted = (
        F.count("*").alias("n"),
        (F.min("cut_hash") != F.max("cut_hash")).alias("mixed"),  # one hot key is never cut
    )
    start = F.substring("cut_hash", 1, DIGITS)
    per_group = Window.partitionBy("grp")
    counts = (
        keyed.groupBy("grp", start.alias("start"))
        .agg(*counted)
        .select(
            "*",
            F.sum("n").over(per_group.orderBy("start")).alias("upto"),
            F.sum("n").over(per_group).alias("group_n"),
        )
    )
    # A null group is not counted among the groups.
    groups = counts.groupBy("grp").agg(F.sum("n").alias("n"))
    counts = beside(counts, groups.agg(F.sum("n").alias("total_n"), F.count("grp").cast("int").alias("n_groups")))

    def holding(candidates: DataFrame, rank: Column):
        """The bucket that holds each wanted rank, and the rank within it."""
        found = candidates.filter((rank > F.col("upto") - F.col("n")) & (rank <= F.col("upto"))).select(
            F.col("grp").alias("w_grp"),
            F.col("start").alias("w_start"),
            F.col("rank").cast("long").alias("rank"),
            (rank - F.col("upto") + F.col("n")).cast("long").alias("within"),
            "n",
            "mixed",
        )
        wanted, _, rows = settled(found, "wanted", bounds)
        if rows is not None:
            return wanted, any(r["mixed"] and r["n"] > bounds.sorted_rows for r in rows)
        return wanted, not wanted.filter(F.col("mixed") & (F.col("n") > bounds.sorted_rows)).isEmpty()

    def inside(wanted: DataFrame, digits: int) -> DataFrame:
        """The rows of the wanted buckets; where these are few, the others are left in place."""
        same = F.col("grp").eqNullSafe(F.col("w_grp")) & (F.substring("cut_hash", 1, digits) == F.col("w_start"))
        return keyed.join(wanted, same)

    wanted, large = holding(
        counts.withColumn("rank", F.explode(ranks(F.col("group_n"), F.col("total_n"), F.col("n_groups")))), F.col("rank")
    )
    digits = DIGITS
    while digits < 32 and large:
        buckets, _, _ = settled(wanted.select("w_grp", "w_start").distinct(), "buckets", bounds)
        further = F.substring("cut_hash", 1, digits + DIGITS)
        counts = inside(buckets, digits).groupBy("grp", "w_start", further.alias("start")).agg(*counted)
        upto = F.sum("n").over(Window.partitionBy("grp", "w_start").orderBy("start"))
        ranks_here = wanted.select("w_grp", F.col("w_start").alias("was"), "rank", "within")
        same = F.col("grp").eqNullSafe(F.col("w_grp")) & (F.col("w_start") == F.col("was"))
        counts = counts.withColumn("upto", upto).join(ranks_here, same)
        digits += DIGITS
        wanted, large = holding(counts, F.col("within"))
    # Rows of one key are merged before they are sorted, so a hot key is one short row.
    keys = inside(wanted.drop("n", "mixed"), digits).groupBy(
        "grp", "w_start", "rank", "within", "cut_hash", "cut_key"
    ).agg(F.count("*").alias("n"))
    order = Window.partitionBy("grp", "w_start", "rank").orderBy("cut_hash", "cut_key")
    cuts = (
        keys.withColumn("upto", F.sum("n").over(order))
        .filter((F.col("upto") >= F.col("within")) & (F.col("upto") - F.col("n") < F.col("within")))
        .select("grp", "rank", "cut_hash", "cut_key")
    )
    return settled(cuts, "cutoffs", bounds)[:2]


def beside_cutoffs(df: DataFrame, cuts: DataFrame, small: bool, group: Column, key: str, salts: int = 32) -> DataFrame:
    """Every row of `df` with the row of `cuts` of its group (column `_grp`), if there is one.

    Small cut-offs are sent to the tasks that hold the rows, and no row is moved. More groups than that
    meet their rows in a shuffle, where each group is spread over `salts` keys.
    """
    if small:
        return df.join(F.broadcast(cuts), group.eqNullSafe(F.col("_grp")), "left")
    salted = cuts.withColumn("_cut_salt", F.explode(F.array(*(F.lit(i) for i in range(salts)))))
    salt = F.pmod(F.xxhash64(F.col(key)), F.lit(salts)).cast("int")
    return df.join(salted, group.eqNullSafe(F.col("_grp")) & (salt == F.col("_cut_salt")), "left")


def _not_after(key: str, seed: int) -> Column:
    h = hash_order(key, seed)
    return (h < F.col("cut_hash")) | (
        (h == F.col("cut_hash")) & (F.col(key) <= F.col("cut_key"))
    )


def hash_lowest(
    df: DataFrame,
    key: str,
    quota: Callable[[Column, Column, Column], Column],
    by: str | None = None,
    seed: int = 42,
    flag: str = "taken",
    bounds: Bounds = Bounds(),
) -> DataFrame:
    """Flag the `quota` lowest keys of each group in hash order.

    Rows stay where they are while the cut-offs, one short row per group, are small; their size is
    counted first (see `settled` and `beside_cutoffs`).
    """
    cuts, small = hash_cutoffs(df, key, lambda n, total, g: F.array(quota(n, total, g)), by, seed, bounds)
    cuts = cuts.select(F.col("grp").alias("_grp"), "cut_hash", "cut_key")
    group = F.col(by).cast("string") if by else F.lit("all")
    taken = F.coalesce(_not_after(key, seed), F.lit(False))
    return beside_cutoffs(df, cuts, small, group, key).select(*df.columns, taken.alias(flag))


def hash_tiles(
    df: DataFrame,
    key: str,
    k: int,
    by: str | None = None,
    seed: int = 42,
    tile: str = "fold",
    bounds: Bounds = Bounds(),
) -> DataFrame:
    """Split each group into `k` runs of the hash order, sizes differing by at most one."""

    def ends(n, _total, _groups):
        return F.transform(
            F.sequence(F.lit(1), F.lit(k - 1)),
            lambda i: F.floor((i * n + F.lit(k - 1)) / F.lit(k)).cast("long"),
        )

    cuts, small = hash_cutoffs(df, key, ends, by, seed, bounds)
    cuts = cuts.groupBy(F.col("grp").alias("_grp")).agg(
        F.collect_list(F.struct("cut_hash", "cut_key")).alias("_cuts")
    )
    group = F.col(by).cast("string") if by else F.lit("all")
    h = hash_order(key, seed)
    before = F.filter(
        F.col("_cuts"),
        lambda c: (c["cut_hash"] < h) | ((c["cut_hash"] == h) & (c["cut_key"] < F.col(key))),
    )
    return beside_cutoffs(df, cuts, small, group, key).select(
        *df.columns, F.coalesce(F.size(before), F.lit(0)).cast("int").alias(tile)
    )


ROWS_PER_PART = 100_000


def running_sums(df: DataFrame, value: str, weights: list[str], rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Sums of each weight over strictly smaller values, as `<weight>_below`.

    `df` has one row per value. The rows are put into ranges of about `rows_per_part` values, however
    many there are, and stored with the number of their range. Totals of ranges become offsets in two
    levels (of a range in its run of 1,000, of the runs), and only the rows of one range are sorted
    together. Null and NaN values are left out; infinities are the first and last values.
    """
    df = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    parts = max(1, -(-df.count() // rows_per_part))
    # Ranges are sampled anew each time they are asked for, so they are written once.
    ranged = df.repartitionByRange(parts, value) if parts > 1 else df.coalesce(1)
    ranged = stored(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy("_range").agg(*[F.sum(w).alias(f"_t_{w}") for w in weights])
    totals = totals.withColumn("_run", F.floor(F.col("_range") / 1000))

    def before(rows: DataFrame, order: str, *by: str) -> list[Column]:
        earlier = Window.partitionBy(*by, F.lit(1)).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return [F.coalesce(F.sum(f"_t_{w}").over(earlier), F.lit(0)).alias(f"_o_{w}") for w in weights]

    runs = totals.groupBy("_run").agg(*[F.sum(f"_t_{w}").alias(f"_t_{w}") for w in weights])
    runs = runs.select("_run", *[c.alias(f"_r_{w}") for c, w in zip(before(runs, "_run"), weights)])
    offsets = totals.select("_range", "_run", *before(totals, "_range", "_run")).join(runs, "_run")
    offsets = offsets.select("_range", *[(F.col(f"_o_{w}") + F.col(f"_r_{w}")).alias(f"_o_{w}") for w in weights])
    inside = Window.partitionBy("_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(offsets, "_range").select(
        *df.columns,
        *[
            (F.col(f"_o_{w}") + F.coalesce(F.sum(w).over(inside), F.lit(0))).alias(f"{w}_below")
            for w in weights
        ],
    )


ACCURACY = 10_000  # a sketch's ranks are off by at most this part of the rows


@dataclass
class Bracket:
    """Where the value of one rank lies: between `low` and `high`, both excluded, after `below` values."""

    column: str
    rank: int
    low: float = -math.inf
    high: float = math.inf
    n: int = 0  # values between
    below: int = 0
    value: float | None = None

    def inside(self) -> Column:
        x = F.col(self.column)
        # An open end holds the infinity itself.
        above = F.lit(True) if self.low == -math.inf else x > F.lit(self.low)
        return above & (F.lit(True) if self.high == math.inf else x < F.lit(self.high))


def _narrowed(df: DataFrame, brackets: list[Bracket], bounds: list[tuple[float, float]]) -> None:
    """Count around the bounds given for each bracket in one scan, and narrow the brackets."""
    cells = []
    for i, (b, (low, high)) in enumerate(zip(brackets, bounds)):
        x, here = F.col(b.column), b.inside()
        cells += [
            F.count_if(here & (x < low)).alias(f"lt{i}"),
            F.count_if(here & (x == low)).alias(f"lo{i}"),
            F.count_if(here & (x == high)).alias(f"hi{i}"),
            F.count_if(here & (x > high)).alias(f"gt{i}"),
        ]
    row = df.agg(*cells).first()
    for i, (b, (low, high)) in enumerate(zip(brackets, bounds)):
        at, lt, lo, hi, gt = b.rank - b.below, *(row[f"{c}{i}"] for c in ("lt", "lo", "hi", "gt"))
        if at < lt:
            b.high, b.n = low, lt
        elif at < lt + lo:
            b.value = low
        elif at >= b.n - gt:
            b.low, b.below, b.n = high, b.below + b.n - gt, gt
        elif at >= b.n - gt - hi:
            b.value = high
        else:
            b.below, b.n = b.below + lt + lo, b.n - lt - lo - hi - gt
            b.low, b.high = low, high


def exact_quantiles(
    df: DataFrame,
    probs: dict[str, float],
    counts: dict[str, int],
    sketches: dict[str, dict[float, float]] | None = None,
    small: int = Bounds.sorted_rows,
    accuracy: int = ACCURACY,
) -> dict[str, dict[str, float | None]]:
    """Linear-interpolated quantiles of the double columns of `df` that `counts` names, with the number
    of values of each.

    A sketch with a known rank error gives two bounds around each wanted rank. The next scan counts the
    values below, at and between the bounds, and the last one fetches the values between, at most
    `small` of them for each rank; where more are left, they are sketched and counted again. No value
    is shuffled, and only counts, bounds and these few values reach the driver. `sketches` may bring the
    first bounds of a caller that has scanned the columns already, by probability.
    """
    brackets: dict[tuple[str, int], Bracket] = {}
    for c, n in counts.items():
        for p in probs.values():
            at = (n - 1) * p
            for rank in {math.floor(at), math.ceil(at)} if n else ():
                brackets.setdefault((c, rank), Bracket(c, rank, n=n))
    first = sketches
    while True:
        wide = [b for b in brackets.values() if b.value is None and b.n > small]
        if not wide:
            break
        if first is not None:
            bounds = [tuple(first[b.column][q] for q in _around(b, accuracy)) for b in wide]
        else:
            row = df.agg(
                *[
                    F.percentile_approx(F.when(b.inside(), F.col(b.column)), list(_around(b, accuracy)), accuracy).alias(f"b{i}")
                    for i, b in enumerate(wide)
                ]
            ).first()
            bounds = [tuple(row[f"b{i}"]) for i in range(len(wide))]
        first = None
        _narrowed(df, wide, bounds)
    rest = [b for b in brackets.values() if b.value is None]
    if rest:
        cells = {(b.column, b.low, b.high): b for b in rest}
        row = df.agg(*[F.sort_array(F.collect_list(F.when(b.inside(), F.col(b.column)))).alias(f"v{i}") for i, b in enumerate(cells.values())]).first()
        values = {key: row[f"v{i}"] for i, key in enumerate(cells)}
        for b in rest:
            b.value = values[(b.column, b.low, b.high)][b.rank - b.below]
    out: dict[str, dict[str, float | None]] = {}
    for c, n in counts.items():
        out[c] = {}
        for name, p in probs.items():
            if not n:
                out[c][name] = None
                continue
            at = (n - 1) * p
            low, high = (brackets[(c, r)].value for r in (math.floor(at), math.ceil(at)))
            # Equal neighbours need no interpolation, which infinities could not take.
            out[c][name] = low if low == high else low + (high - low) * (at - math.floor(at))
    return out


def _around(b: Bracket, accuracy: int) -> tuple[float, float]:
    """Probabilities whose sketched values lie on either side of a rank, if the sketch keeps its word."""
    at, slack = (b.rank - b.below + 0.5) / b.n, 2.0 / accuracy
    return max(0.0, at - slack), min(1.0, at + slack)


def quantile_probabilities(n: int, probs: dict[str, float], accuracy: int = ACCURACY) -> list[float]:
    """The probabilities that `exact_quantiles` looks up first for a column of n values."""
    ranks = {r for p in probs.values() for r in (math.floor((n - 1) * p), math.ceil((n - 1) * p))} if n else set()
    return sorted({q for r in ranks for q in _around(Bracket("", r, n=n), accuracy)})


def exact_percentiles(df: DataFrame, value: str, probs: dict[str, float]) -> DataFrame:
    """Linear-interpolated percentiles of one column in one row; null and NaN values are left out."""
    x = F.col(value).cast("double")
    values = df.select(F.nanvl(x, F.lit(None)).alias("value"))
    n = values.agg(F.count("value")).first()[0]
    found = exact_quantiles(values, probs, {"value": n})["value"]
    row = [tuple(found[name] for name in probs)]
    return df.sparkSession.createDataFrame(row, ", ".join(f"`{name}` double" for name in probs))
