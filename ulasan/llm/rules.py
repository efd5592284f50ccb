"""Quality rules as a learned decision list of threshold conjunctions.

Every text is reduced to a row of statistics by SQL expressions. Sequential covering then learns, on
labelled rows of that table, an ordered list of conjunctions such as `symbols_per_word > 0.31 and
repeat_share <= 0.2`: a rule is grown on two thirds of the rows by adding the condition with the best
information gain, pruned on the other third by dropping its last conditions, and kept while it is
precise enough; the rows it covers leave the table for the next one. The driver sees only counts per
feature and cut point, never rows. The list is one `CASE WHEN` chain.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ulasan.llm.common import held_out, sheltered, words
from ulasan.session import stored

#: The statistics that rules may test.
FEATURES = (
    "n_words", "mean_word", "symbols_per_word", "marks_per_word", "upper_share",
    "dup_line_share", "repeat_share", "words_per_line",
)
WINDOW = 3


# --- statistics ---------------------------------------------------------------


def _windows_in_order(windows: Column) -> Column:
    """Windows by hash and place; none where no hash is repeated, which is the usual case."""
    order = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    some = F.size(windows) > F.size(F.array_distinct(windows))
    return F.when(some, order).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))


def _repeated_places(order: Column) -> Column:
    """Places, in order, of the windows whose hash stands next to itself. `order` must be a column."""
    same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
    found = F.filter(order, lambda x, k: same(x, F.get(order, k - 1)) | same(x, F.get(order, k + 1)))
    return F.array_sort(F.transform(found, lambda x: x["i"]))


def _words_under(places: Column, size: int) -> Column:
    """Words under windows at these places, by the gaps between them."""
    ends = F.aggregate(
        places,
        F.struct(F.lit(0).alias("n"), F.lit(-size).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(size), i - a["last"])).alias("n"), i.alias("last")),
    )
    return ends["n"]


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with struct `_base` (the counts of the base rules) and struct `_stats` (`FEATURES`).

    A null text counts as empty; an empty text has zero everywhere. Repeated windows are told apart
    by a 64-bit hash; a text without any, which is the usual case, costs the hashes and one
    distinct count.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    # Words as hashes, then pairs and triples of neighbours by laying the array beside its own rest.
    both = lambda a, b: F.xxhash64(a, b)
    n = F.size("_w")
    rest = lambda name, k: F.slice(F.col(name), k + 1, F.greatest(n - k, F.lit(0)))
    out = docs.withColumn("_w", F.transform(words(F.col(text_col)), lambda w: F.xxhash64(w)))
    out = out.withColumn("_v", F.zip_with(F.slice("_w", 1, F.greatest(n - 1, F.lit(0))), rest("_w", 1), both))
    out = out.withColumn(
        "_h", F.zip_with(F.slice("_v", 1, F.greatest(n - 2, F.lit(0))), rest("_w", 2), both)
    )
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    # Columns of their own, as an expression inside a lambda is worked out for every element.
    out = out.withColumn("_o", _windows_in_order(F.col("_h"))).withColumn("_p", _repeated_places(F.col("_o")))
    out = out.withColumn("_l", lines)
    long = lambda c: c.cast("long")
    base = F.struct(
        long(F.size("_w")).alias("n_words"),
        long(F.length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]"))).alias("word_chars"),
        long(F.regexp_count(text, F.lit("[#*$%&|<>]"))).alias("n_symbols"),
        long(F.size("_l") - F.size(F.array_distinct("_l"))).alias("n_dup_lines"),
        long(_words_under(F.col("_p"), WINDOW)).alias("n_repeat_words"),
        long(F.size("_l")).alias("n_lines"),
        long(F.regexp_count(text, F.lit("[!?]"))).alias("n_marks"),
        long(F.regexp_count(text, F.lit("[A-Z]"))).alias("n_upper"),
    )
    out = out.withColumn("_base", base).drop("_w", "_v", "_h", "_o", "_p", "_l")
    b, one = (lambda c: F.col("_base")[c].cast("double")), F.lit(1.0)
    per = lambda x, y: b(x) / F.greatest(b(y), one)
    return out.withColumn(
        "_stats",
        F.struct(
            b("n_words").alias("n_words"),
            per("word_chars", "n_words").alias("mean_word"),
            per("n_symbols", "n_words").alias("symbols_per_word"),
            per("n_marks", "n_words").alias("marks_per_word"),
            per("n_upper", "word_chars").alias("upper_share"),
            per("n_dup_lines", "n_lines").alias("dup_line_share"),
            per("n_repeat_words", "n_words").alias("repeat_share"),
            per("n_words", "n_lines").alias("words_per_line"),
        ),
    )


def base_failed(base: Column) -> Column:
    return (base["n_words"] < 50) | (100 * base["n_repeat_words"] > 50 * base["n_words"])


# --- the list -----------------------------------------------------------------


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float
    step: int  # the cut's place among the feature's cut points

    def test(self, stats: Column) -> Column:
        value = stats[self.feature]
        return value > self.cut if self.above else value <= self.cut

    def binned(self) -> Column:
        value = F.col(f"b_{self.feature}")
        return value > self.step if self.above else value <= self.step

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; the first that holds rejects, and a row that none covers is kept."""

    rules: tuple[tuple[Condition, ...], ...]

    def keeps(self, stats: Column) -> Column:
        if not self.rules:
            return F.lit(True)
        chain = None
        for rule in self.rules:
            holds = _all([c.test(stats) for c in rule])
            chain = F.when(holds, False) if chain is None else chain.when(holds, False)
        return chain.otherwise(True)

    def __str__(self) -> str:
        return "\n".join(f"reject if {' and '.join(map(str, r))}" for r in self.rules) + "\nkeep"


def _all(tests: list[Column]) -> Column:
    out = F.lit(True)
    for t in tests:
        out = out & t
    return out


def _between(values: list[float]) -> list[float]:
    """Cut points halfway between neighbours, so that a rule stays clear of the values on either side."""
    return [(a + b) / 2 for a, b in zip(values, values[1:])]


def _bin(value: Column, points: list[float]) -> Column:
    """The number of cut points below the value."""
    return F.size(F.filter(F.lit(points), lambda c: c < value))


def _gain(p: float, n: float, before_p: float, before_n: float) -> float:
    if p <= 0:
        return -math.inf
    return p * (math.log2(p / (p + n)) - math.log2(before_p / (before_p + before_n)))


def learn(
    labelled: DataFrame,
    cuts: int = 24,
    max_rules: int = 8,
    max_conditions: int = 3,
    min_covered: int = 5,
    min_precision: float = 0.9,
) -> DecisionList:
    """A decision list from rows `(doc_id, label, _stats)`, label 1 for good and 0 for bad.

    Cut points lie between the quantiles of each feature in each class. Every step is one aggregation over all
    rows; what reaches the driver is bounded by features x cut points x 2. Null labels are left out.
    Without rows of both classes the list is empty and keeps everything.
    """
    rows = labelled.where("label IS NOT NULL")
    shares = [(i + 1) / (cuts + 1) for i in range(cuts)]
    found = (
        rows.groupBy("label")
        .agg(*(F.percentile_approx(F.col("_stats")[f], shares, 2000).alias(f) for f in FEATURES))
        .collect()
    )
    if len(found) < 2:
        return DecisionList(())
    points = {f: _between(sorted({float(v) for r in found for v in r[f]})) for f in FEATURES}
    binned = stored(
        rows.select(
            (F.col("label") == 0).cast("int").alias("bad"),
            (F.pmod(F.xxhash64(F.lit("grow"), "doc_id"), F.lit(3)) > 0).alias("grow"),
            *(
                _bin(F.col("_stats")[f], points[f]).alias(f"b_{f}") for f in FEATURES
            ),
        ),
        "rule-rows",
    )

    def histogram(df: DataFrame) -> dict[str, dict[int, list[int]]]:
        """Rows of either class per feature and bin."""
        cells = F.explode(
            F.array(*(F.struct(F.lit(f).alias("f"), F.col(f"b_{f}").alias("b")) for f in FEATURES))
        )
        out: dict[str, dict[int, list[int]]] = {f: {} for f in FEATURES}
        for f, b, bad, n in df.select("bad", cells.alias("c")).groupBy("c.f", "c.b", "bad").count().collect():
            out[f].setdefault(b, [0, 0])[bad] += n
        return out

    rules: list[tuple[Condition, ...]] = []
    rest = binned
    while len(rules) < max_rules:
        rule: list[Condition] = []
        inside = rest.where("grow")
        while len(rule) < max_conditions:
            cells = histogram(inside)
            n_all, p_all = (sum(v[k] for v in cells[FEATURES[0]].values()) for k in (0, 1))
            if not p_all or (rule and not n_all):
                break
            best, gain = None, 0.0
            for f in FEATURES:
                p_below = n_below = 0
                for step, cut in enumerate(points[f]):
                    n_in, p_in = cells[f].get(step, (0, 0))
                    n_below, p_below = n_below + n_in, p_below + p_in
                    for above, p, n in (
                        (False, p_below, n_below),
                        (True, p_all - p_below, n_all - n_below),
                    ):
                        g = _gain(p, n, p_all, n_all)
                        if p >= min_covered and g > gain + 1e-9:
                            best, gain = Condition(f, above, cut, step), g
            if best is None:
                break
            rule.append(best)
            inside = inside.where(best.binned())
        if not rule:
            break
        # Prune: the prefix with the best (p - n) / (p + n) on the rows kept aside.
        tests = [_all([c.binned() for c in rule[: k + 1]]) for k in range(len(rule))]
        sums = (
            rest.where("NOT grow")
            .agg(
                *(F.sum(F.when(t, F.col("bad")).otherwise(0)).alias(f"p{k}") for k, t in enumerate(tests)),
                *(F.sum(F.when(t, 1 - F.col("bad")).otherwise(0)).alias(f"n{k}") for k, t in enumerate(tests)),
            )
            .first()
        )
        worth = []
        for k in range(len(rule)):
            p, n = sums[f"p{k}"] or 0, sums[f"n{k}"] or 0
            worth.append(((p - n) / (p + n) if p + n else -1.0, p, -k))
        score, p, k = max(worth)
        if p < max(1, min_covered // 2) or (score + 1) / 2 < min_precision:
            break
        rule = rule[: 1 - k]
        rules.append(tuple(rule))
        rest = rest.where(~_all([c.binned() for c in rule]))
    return DecisionList(tuple(rules))


def judge(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> tuple[DataFrame, DecisionList]:
    """One row `(doc_id, _base, _stats, base_failed, kept)` per row of `docs`, and the learned list.

    `labels` is `(doc_id, quality)`; held-out rows are not learned from. The statistics of every text
    are worked out once and stored; learning and judging both read that table. Repeated rows give
    repeated results; null texts are empty and fail the base rules; null ids are judged but not
    learned from; an empty table gives no rows.
    """
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = stored(with_statistics(plain).drop("text"), "statistics")
    known = labels.select("doc_id", F.col("quality").cast("int").alias("label")).where(
        ~held_out(F.col("doc_id"))
    )
    model = learn(rows.join(known, "doc_id").select("doc_id", "label", "_stats"), **options)
    failed = base_failed(F.col("_base"))
    return rows.select(
        "*", failed.alias("base_failed"), (~failed & model.keeps(F.col("_stats"))).alias("kept")
    ), model


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of `docs` (with `doc_id`, `text`) that the rules keep; columns stay as they are, whatever
    their names. Null and empty texts fail the base rules; very long ones are judged whole; repeated rows
    stay or go together; rows without an id are judged but not learned from; an empty table stays empty."""

    def keep(plain: DataFrame) -> DataFrame:
        rows = stored(with_statistics(plain), "statistics")
        known = labels.select(
            F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("label")
        ).where(~held_out(F.col("_id")))
        seen = rows.select("doc_id", "_stats")
        model = learn(seen.join(known, F.col("doc_id") == F.col("_id")).select("doc_id", "label", "_stats"), **options)
        return rows.where(~base_failed(F.col("_base")) & model.keeps(F.col("_stats")))

    return sheltered(docs, ("doc_id", "text"), keep)
