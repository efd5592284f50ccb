"""Secret scans: fixed patterns, and random-looking strings by two character Markov models.

The fixed kinds are found by regular expressions. For other candidates, runs of key characters, the
probability of their characters under a first-order Markov chain of random strings is compared with
that under a chain of ordinary identifiers; a run whose log-likelihood ratio is high enough is a span
of kind `markov`. Both chains are counted from labelled samples. Everything is a SQL expression.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ulasan.llm.common import sheltered
from ulasan.session import stored

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "markov")
CANDIDATE_CHARS = "A-Za-z0-9+/_=-"
MIN_CANDIDATE = 16
#: One state per candidate character, one for any other, one for the start.
ALPHABET = string.ascii_letters + string.digits + "+/_=-"
STATES = len(ALPHABET) + 2
OTHER, START = STATES - 2, STATES - 1
SPAN = "struct<start:int,kind:int,end:int>"


# --- spans --------------------------------------------------------------------


def matches(text: Column, pattern: str, group: int, kind: int, least: int) -> Column:
    """Spans of the leftmost non-overlapping matches whose `group` has `least` characters or more.

    The texts between the matches and the matches alternate, so places are running sums of lengths.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    sizes = F.zip_with(
        F.zip_with(F.split(text, pattern, -1), whole, lambda a, b: F.struct(F.length(a).alias("gap"), F.length(b).alias("n"))),
        part,
        lambda a, b: F.struct(a["gap"].alias("gap"), a["n"].alias("n"), F.length(b).alias("part")),
    )
    running = F.aggregate(
        F.filter(sizes, lambda x: x["n"].isNotNull()),
        F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out")),
        lambda a, x: F.struct(
            (a["at"] + x["gap"] + x["n"]).alias("at"),
            F.when(
                x["part"] >= least,
                F.concat(
                    a["out"],
                    F.array(
                        F.struct(
                            (a["at"] + x["gap"]).alias("start"),
                            F.lit(kind).alias("kind"),
                            (a["at"] + x["gap"] + x["n"]).alias("end"),
                        ).cast(SPAN)
                    ),
                ),
            ).otherwise(a["out"]).cast(f"array<{SPAN}>").alias("out"),
        ),
    )
    return running["out"]


def base_spans(text: Column) -> Column:
    """The spans of the fixed kinds, by start and then by kind. Texts that a quick test rules out are
    not cut up."""
    none = F.array().cast(f"array<{SPAN}>")
    return F.array_sort(
        F.concat(
            F.when(text.rlike(ASSIGN), matches(text, ASSIGN, 2, 0, 6)).otherwise(none),
            F.when(text.contains("AKIA"), matches(text, ACCESS, 0, 1, 20)).otherwise(none),
            F.when(text.rlike("[0-9a-f]{24}"), matches(text, HEX, 0, 2, 24)).otherwise(none),
        )
    )


def candidates(text: Column) -> Column:
    pattern = f"[{CANDIDATE_CHARS}]{{{MIN_CANDIDATE},}}"
    none = F.array().cast(f"array<{SPAN}>")
    return F.when(text.rlike(pattern), matches(text, pattern, 0, 3, MIN_CANDIDATE)).otherwise(none)


def cut(text: Column, span: Column) -> Column:
    return F.substring(text, span["start"] + 1, span["end"] - span["start"])


# --- the two chains -----------------------------------------------------------


def _fixed(values) -> Column:
    """A constant array, given as one string because thousands of literals are slow to plan."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def states(token: Column) -> Column:
    """The state numbers of a token's characters."""
    numbers = F.split(
        F.lit(",".join(str(ALPHABET.find(chr(i)) if chr(i) in ALPHABET else OTHER) for i in range(128))), ","
    ).cast("array<int>")
    return F.transform(
        F.filter(F.split(token, ""), lambda c: c != ""),
        lambda c: F.coalesce(F.get(numbers, F.ascii(c)), F.lit(OTHER)),
    )


@dataclass(frozen=True)
class MarkovModel:
    """Log-likelihood ratios of each transition, random against ordinary, and the bar for a span."""

    ratios: tuple[float, ...]
    bar: float

    def score(self, token: Column) -> Column:
        """Mean log-likelihood ratio per character, the first one from the start state."""
        table = _fixed(self.ratios)
        total = F.aggregate(
            states(token),
            F.struct(F.lit(START).alias("last"), F.lit(0.0).alias("sum")),
            lambda a, s: F.struct(
                s.alias("last"), (a["sum"] + F.get(table, a["last"] * STATES + s)).alias("sum")
            ),
        )
        return total["sum"] / F.greatest(F.length(token), F.lit(1))

    def finds(self, token: Column) -> Column:
        return self.score(token) > self.bar


def train(samples: DataFrame, smoothing: float = 0.5) -> MarkovModel | None:
    """Both chains from `(token, secret)`: transitions are counted by one aggregation, so what reaches
    the driver is bounded by the number of states squared. The bar lies where as many secrets as
    ordinary tokens would be judged wrongly, halfway between the classes' mean ratios, and never
    below zero. Null tokens and labels are left out.
    The samples are read twice, so hand over a stored table. Without samples of both classes: None.
    """
    rows = samples.where("token IS NOT NULL AND secret IS NOT NULL AND token <> ''")
    chain = rows.select("secret", states(F.col("token")).alias("s"))
    steps = chain.select(
        "secret",
        F.explode(
            F.transform(
                F.col("s"),
                lambda x, i: F.struct(F.coalesce(F.get(F.col("s"), i - 1), F.lit(START)).alias("a"), x.alias("b")),
            )
        ).alias("t"),
    )
    counts = {True: [0.0] * STATES**2, False: [0.0] * STATES**2}
    for secret, a, b, n in steps.groupBy("secret", "t.a", "t.b").count().collect():
        counts[bool(secret)][a * STATES + b] += n
    if not any(counts[True]) or not any(counts[False]):
        return None
    logs = {}
    for kind, c in counts.items():
        # Unseen transitions lean on how common the second character is in the class.
        single = [sum(c[a * STATES + b] for a in range(STATES)) + smoothing for b in range(STATES)]
        total = sum(single)
        out = []
        for a in range(STATES):
            row = sum(c[a * STATES : (a + 1) * STATES])
            weight = 4.0
            out += [
                math.log((c[a * STATES + b] + weight * single[b] / total) / (row + weight))
                for b in range(STATES)
            ]
        logs[kind] = out
    ratios = tuple(r - o for r, o in zip(logs[True], logs[False]))
    model = MarkovModel(ratios, 0.0)
    means = {
        bool(r[0]): r[1]
        for r in rows.select("secret", model.score(F.col("token")).alias("x")).groupBy("secret").agg(F.avg("x")).collect()
    }
    return MarkovModel(ratios, max(0.0, (means[True] + means[False]) / 2))


def samples_from(docs: DataFrame, text_col: str = "text", max_rows: int = 20_000) -> DataFrame:
    """Labelled samples out of a bounded share of the documents: what the fixed kinds find is secret,
    other candidate runs are ordinary identifiers.

    `max_rows` bounds the documents read for it; they are chosen by a hash of the text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    n = docs.count()
    share = min(1.0, max_rows / max(1, n))
    some = docs.select(text.alias("t")).where(
        F.pmod(F.xxhash64(F.lit("sample"), "t"), F.lit(1 << 30)) < int(share * (1 << 30))
    )
    found = some.select("t", base_spans(F.col("t")).alias("b"), candidates(F.col("t")).alias("c"))
    each = found.select(
        "t",
        F.explode(
            F.concat(
                F.transform("b", lambda s: F.struct(s.alias("s"), F.lit(True).alias("secret"))),
                F.transform(
                    F.filter(F.col("c"), lambda s: ~F.exists(F.col("b"), lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"]))),
                    lambda s: F.struct(s.alias("s"), F.lit(False).alias("secret")),
                ),
            )
        ).alias("x"),
    )
    token = cut(F.col("t"), F.col("x.s"))
    # Of an assignment only the value is a sample.
    value = F.regexp_extract(token, r"[A-Za-z0-9+/_.=-]+$", 0)
    return each.select(F.when(F.col("x.secret"), value).otherwise(token).alias("token"), "x.secret")


def scan(docs: DataFrame, model: MarkovModel | None, text_col: str = "text") -> DataFrame:
    """`docs` with `_base` and `_spans`, arrays of `(start, kind, end)` in code points, end exclusive.

    `_spans` holds the base spans and the candidate runs that the model finds and that touch no base
    span, in order of start and kind. Null and empty texts have none; very long ones are scanned
    whole; `_base` and `_spans` replace columns of that name.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.withColumn("_base", base_spans(text))
    if model is None:
        return out.withColumn("_spans", F.col("_base"))
    # Most candidates are words; the score is asked of those alone that touch no base span.
    extra = F.filter(
        candidates(text),
        lambda s: ~F.exists(F.col("_base"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        & model.finds(cut(text, s)),
    )
    return out.withColumn("_spans", F.array_sort(F.concat(F.col("_base"), extra)))


def spelled(spans: Column) -> Column:
    """`kind:start:end`, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every stretch covered by spans (ordered by start) replaced by one mark."""
    done = F.aggregate(
        spans,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda a, s: F.struct(
            F.when(
                s["start"] >= a["at"],
                F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mark)),
            ).otherwise(a["out"]).alias("out"),
            F.greatest(a["at"], s["end"]).alias("at"),
        ),
    )
    tail = F.substring(text, done["at"] + 1, F.length(text) - done["at"])
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(done["out"], tail))


def redact(docs: DataFrame, **options) -> DataFrame:
    """`docs` with secrets replaced in `text` and `n_chars` counted anew; null texts stay null, and other
    columns as they are, whatever their names. Repeated rows and null ids are rows like others; an empty
    table stays empty; very long texts are scanned whole."""

    def replaced(rows: DataFrame) -> DataFrame:
        model = train(stored(samples_from(rows, **options), "secret-samples"))
        out = scan(rows, model)
        changed = F.size("_spans") > 0
        out = out.withColumn(
            "text", F.when(changed, redacted(F.col("text"), F.col("_spans"))).otherwise(F.col("text"))
        )
        if "n_chars" in rows.columns:
            out = out.withColumn(
                "n_chars",
                F.when(changed, F.length("text").cast(rows.schema["n_chars"].dataType)).otherwise(F.col("n_chars")),
            )
        return out

    return sheltered(docs, ("doc_id", "text", "n_chars"), replaced)
