"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected `target / source_size` times. The running sum of these
expected copies, shifted by one random offset per source, is cut at the integers: a document is taken
once for each integer its stretch crosses. Documents are ordered by size, so that neighbours on the
line are of like size and the taken words come close to the target. A source of few documents can
still miss by one long document; so a few random offsets are drawn for each source, and the one whose
taken words come nearest to the target is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ulasan.llm.common import WORD, sheltered
from ulasan.session import stored

WEIGHTS = (5.0, 2.0, 1.0)
OFFSET_STEPS = 1 << 20


def size_of(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, most: float = 3.0) -> list[float]:
    """Targets of sources given in order: `weights` in turn share all words.

    A target stops at `most` times its source's size; the excess is shared again by weight among the
    others until none is above.
    """
    total = float(sum(n for _, n in sizes))
    share = [weights[i % len(weights)] for i in range(len(sizes))]
    fixed: dict[int, float] = {}
    while True:
        rest = total - sum(fixed.values())
        open_ = [i for i in range(len(sizes)) if i not in fixed]
        whole = sum(share[i] for i in open_)
        above = [i for i in open_ if rest * share[i] / whole > most * sizes[i][1]]
        if not above:
            return [fixed[i] if i in fixed else rest * share[i] / whole for i in range(len(sizes))]
        fixed |= {i: most * sizes[i][1] for i in above}


def targets(sized: DataFrame, weights=WEIGHTS, most: float = 3.0) -> DataFrame:
    """`(source, source_size, target)` from rows `(source, size)`; one short row per source.

    Sources are in the order of their code points, null last. The number of sources is that of the
    mix's recipe, so their totals are worked out on the driver.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("n")).collect()
    order = sorted(((r[0], int(r[1] or 0)) for r in totals), key=lambda r: (r[0] is None, r[0] or ""))
    found = source_targets(order, weights, most)
    rows = [(s, n, float(t)) for (s, n), t in zip(order, found)]
    return sized.sparkSession.createDataFrame(rows, "source string, source_size long, target double")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    most: float = 3.0,
    seed: int = 42,
    offsets: int = 16,
    rows_per_group: int = 50_000,
) -> DataFrame:
    """`(doc_id, size, source_size, target, copies, taken)` per row of `docs`.

    copies is how often the mix takes the row, at most `most`; taken is copies times size. A row's
    place in its source comes from three counts: rows of smaller size, rows of its size in earlier
    hash groups, rows before it in its group. Groups hold about `rows_per_group` rows however many
    rows a source or a size has, so no window grows with the table. The order depends on the rows
    alone, so reruns agree. Repeated rows are rows of their own (their order among themselves has no
    effect on the counts); null texts have size 0; null sources are one source; null ids count like
    others; an empty table gives an empty result; a source without words has target 0 and copies 0.
    """
    spark = docs.sparkSession
    plain = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(source_col).alias("source")
    )
    sized = stored(plain.select("doc_id", "source", size_of(F.col("text")).alias("size")), "sized")
    groups = max(1, -(-sized.count() // rows_per_group))
    # Null sources get a key of their own that no string equals.
    keyed = sized.select(
        "doc_id",
        "size",
        F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")).alias("s"),
        F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(groups)).cast("long").alias("g"),
    )
    cells = keyed.groupBy("s", "size", "g").agg(F.count("*").alias("n"))
    sizes = cells.groupBy("s", "size").agg(F.sum("n").alias("n"))
    before = lambda *by: F.coalesce(
        F.sum("n").over(Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    smaller = sizes.select("s", "size", before("s", "size").alias("n_smaller"))
    earlier = cells.select("s", "size", "g", before("s", "size", "g").alias("n_earlier"))
    place = Window.partitionBy("s", "size", "g").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id")
    recipe = targets(sized, weights, most)
    recipe = recipe.select(
        F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")).alias("s"),
        "source_size",
        "target",
    )
    placed = stored(
        keyed.withColumn("nth", F.row_number().over(place).cast("long"))
        .join(earlier.join(smaller, ["s", "size"]), ["s", "size", "g"])
        .select("doc_id", "s", "size", (F.col("n_smaller") + F.col("n_earlier") + F.col("nth")).alias("rank")),
        "placed",
    )
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))

    def copies(shift: Column) -> Column:
        crossed = F.floor(shift + F.col("rank") * each) - F.floor(shift + (F.col("rank") - 1) * each)
        # Beyond 2^31 rows of a source the two products can be rounded apart by one.
        return F.least(crossed, F.ceil(each)).cast("long")

    def shift(j: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), F.lit(j), "s"), F.lit(OFFSET_STEPS)) / F.lit(float(OFFSET_STEPS))

    misses = (
        placed.join(F.broadcast(recipe), "s")  # one row per source
        .groupBy("s", "target")
        .agg(*(F.sum(copies(shift(j)) * F.col("size")).alias(f"t{j}") for j in range(offsets)))
        .select(
            "s",
            F.array_min(
                F.array(*(F.struct(F.abs(F.col(f"t{j}") - F.col("target")), shift(j).alias("shift")) for j in range(offsets)))
            )["shift"].alias("shift"),
        )
    )
    recipe = recipe.join(misses, "s")
    times = copies(F.col("shift"))
    return placed.join(F.broadcast(recipe), "s").select(
        "doc_id", "size", "source_size", "target", times.alias("copies"), (times * F.col("size")).alias("taken")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` (with `doc_id`, `text`, `source`), each as often as the mix takes it.

    A row without an id is kept once, because its copies cannot be told apart; rows that share an id are
    one document, whose first count in order of size decides. Other columns stay, whatever their names;
    null texts have size 0; an empty table stays empty; very long texts are counted whole.
    """

    def taken_rows(rows: DataFrame) -> DataFrame:
        taken = mix(rows, **options).where("doc_id IS NOT NULL")
        taken = taken.groupBy(F.col("doc_id").alias("_id")).agg(F.min("copies").alias("_copies"))
        joined = rows.join(taken, F.col("doc_id") == F.col("_id"), "left")
        times = F.coalesce("_copies", F.lit(1)).cast("int")
        return joined.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), times)))

    return sheltered(docs, ("doc_id", "text", "source"), taken_rows)
