"""Toxicity by the nearest labelled examples.

The vocabulary is the words and word stems that the labels single out, their inverse document frequencies come from
all documents, and a text is the vector of its terms' TF-IDF weights, of unit length. A bounded set of labelled examples
is held as an inverted index whose posting lists are cut into blocks of examples, each with the
largest weight that a term has in it. A query adds these up to a bound per block, visits blocks in
order of their bounds and stops as soon as no bound can reach its k-th best cosine, so the k nearest
examples are exact. They vote with their cosines, and a logistic curve turns the vote into a score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ulasan.llm.calibration import logit, platt, sigmoid
from ulasan.llm.common import held_out, training_rows, two_columns
from ulasan.session import stored

#: ASCII letters to lower case, other ASCII characters but digits to spaces.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256)
)


def terms(text: str | None, stem: int = 7) -> list[bytes]:
    """Words, and the first bytes of longer words as stems, which inflected forms share."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()
    return found + [t[:stem] + b"*" for t in found if len(t) > stem]


# --- the index ----------------------------------------------------------------


@dataclass
class BlockMaxIndex:
    """Posting lists of unit vectors over examples 0..n-1, in blocks of `block` examples."""

    n: int
    block: int
    ids: list[np.ndarray]
    weights: list[np.ndarray]
    cuts: np.ndarray  # [term, block + 1]: where each block starts in the term's list
    most: np.ndarray  # [term, block]: the largest weight
    visited: int = field(default=0, compare=False)

    @staticmethod
    def build(vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int = 64) -> BlockMaxIndex:
        n, blocks = len(vectors), max(1, -(-len(vectors) // block))
        of = np.concatenate([np.full(len(t), i) for i, (t, _) in enumerate(vectors)] or [np.zeros(0, int)])
        term = np.concatenate([t for t, _ in vectors] or [np.zeros(0, int)]).astype(np.int64)
        weight = np.concatenate([w for _, w in vectors] or [np.zeros(0)])
        order = np.lexsort((of, term))
        of, term, weight = of[order], term[order], weight[order]
        edges = np.searchsorted(term, np.arange(n_terms + 1))
        ids = [of[a:b] for a, b in zip(edges, edges[1:])]
        weights = [weight[a:b] for a, b in zip(edges, edges[1:])]
        cuts = np.array([np.searchsorted(i, np.arange(blocks + 1) * block) for i in ids]).reshape(n_terms, blocks + 1)
        most = np.zeros((n_terms, blocks))
        np.maximum.at(most, (term, of // block), weight)
        return BlockMaxIndex(n, block, ids, weights, cuts, most)

    def nearest(self, query: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of the largest cosine above zero, ties by example number, and their cosines."""
        if not len(query) or not self.n:
            return np.zeros(0, np.int64), np.zeros(0)
        bounds = weights @ self.most[query]
        best_ids, best = np.zeros(0, np.int64), np.zeros(0)
        for b in np.argsort(-bounds, kind="stable"):
            # A hair of slack, as the bound and the sum are rounded differently.
            if bounds[b] <= 0 or (len(best) == k and bounds[b] < best[-1] - 1e-9):
                break
            self.visited += 1
            sums = np.zeros(self.block)
            for t, w in zip(query, weights):
                a, z = self.cuts[t, b], self.cuts[t, b + 1]
                if z > a:
                    sums[self.ids[t][a:z] - b * self.block] += w * self.weights[t][a:z]
            found = np.flatnonzero(sums > 0)
            ids = np.r_[best_ids, found + b * self.block]
            values = np.r_[best, sums[found]]
            order = np.lexsort((ids, -np.round(values, 12)))[:k]
            best_ids, best = ids[order], values[order]
        return best_ids, best


@dataclass
class NeighbourModel:
    places: dict[bytes, int]
    idf: np.ndarray
    index: BlockMaxIndex
    examples: np.ndarray  # the examples' document ids
    labels: np.ndarray
    k: int
    slope: float = 1.0
    shift: float = 0.0
    prior: float = 0.5  # of texts without any term of the vocabulary

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        found = Counter(filter(self.places.__contains__, terms(text)))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0)
        t = np.array([self.places[x] for x in found], np.int64)
        w = (1 + np.log(np.array(list(found.values()), float))) * self.idf[t]
        order = np.argsort(t)
        return t[order], (w / np.sqrt((w * w).sum()))[order]

    def vote(self, text: str | None) -> tuple[float, np.ndarray, np.ndarray]:
        """Share of the toxic neighbours, weighted by cosine, with the neighbours; NaN without any.

        The vote leans to nothing known while the cosines add up to little.
        """
        near, cosines = self.index.nearest(*self.vector(text), self.k)
        if not len(near):
            return float("nan"), near, cosines
        y = self.labels[near]
        return float((cosines * y).sum() / cosines.sum()), near, cosines

    def scored(self, votes: np.ndarray) -> np.ndarray:
        return np.where(np.isnan(votes), self.prior, sigmoid(self.slope * np.nan_to_num(votes) + self.shift))


# --- fitting ------------------------------------------------------------------


def _term_labels(rows: DataFrame, flush: int = 300_000) -> DataFrame:
    """`(term, toxic, n)`: labelled rows that hold each term; counted up inside the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            names = list(every)
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array([toxic[t] for t in names], pa.int64()), pa.array([every[t] for t in names], pa.int64())],
                ["term", "toxic", "n"],
            )

        every, toxic = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = set(terms(text))
                every.update(own)
                if label:
                    toxic.update(own)
            if len(every) > flush:
                yield out()
                every, toxic = Counter(), Counter()
        yield out()

    counted = rows.select("text", "label").mapInArrow(run, "term binary, toxic long, n long")
    return counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))


def document_frequencies(docs: DataFrame, names: list[bytes], text_col: str = "text") -> np.ndarray:
    """In how many of all documents each of the (bounded) `names` occurs."""
    places = {t: i for i, t in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(places), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for text in batch.column(0).slice(at, 256).to_pylist():
                    for t in places.keys() & terms(text):
                        counts[places[t]] += 1
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["t", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "t long, n long")
    out = np.zeros(len(names))
    for t, n in rows.groupBy("t").agg(F.sum("n")).collect():
        out[t] = n
    return out


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = 24_000,
    max_examples: int = 4096,
    max_terms: int = 512,
    min_rows: int = 4,
    least_chi2: float = 30.0,
    k: int = 15,
) -> NeighbourModel:
    """Fit on at most about `max_rows` labelled rows (`labels` is `(doc_id, toxic)`), held-out rows
    excepted. Of two thirds of them at most `max_examples`, half of either label and the first by a hash of
    their id, become examples; the other third calibrates the vote. The vocabulary is the `max_terms` terms with the largest chi-square against the
    label. Document frequencies are counted over all of `docs`.
    """
    rows = stored(training_rows(docs, labels, "toxic", max_rows, "toxicity"), "toxic-rows")
    n, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    rate = float((toxic + 1) / (n + 2))
    model = NeighbourModel({}, np.zeros(0), BlockMaxIndex.build([], 0), np.zeros(0, np.int64), np.zeros(0), k, 0.0, 0.0, rate)
    if not toxic or toxic == n:
        return model
    share = toxic / n
    expected = F.col("n") * share
    chi2 = (F.col("toxic") - expected) ** 2 / (expected * (1 - share))
    chosen = (
        _term_labels(rows)
        .where(F.col("n") >= min_rows)
        .select("term", chi2.alias("chi2"))
        .where(F.col("chi2") >= least_chi2)
        .orderBy(F.desc("chi2"), "term")
        .limit(max_terms)
        .collect()
    )
    names = [bytes(r[0]) for r in chosen]
    total = docs.count()
    frequencies = document_frequencies(docs, names)
    model.places = {t: i for i, t in enumerate(names)}
    model.idf = np.log((total + 1) / (frequencies + 1)) + 1
    third = F.pmod(F.xxhash64(F.lit("third"), "doc_id"), F.lit(3))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [model.vector(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([v[0].tolist() for v in vectors], pa.list_(pa.int64())), pa.array([v[1].tolist() for v in vectors], pa.list_(pa.float64()))],
                ["doc_id", "label", "t", "w"],
            )

    vectors = rows.select(F.col("doc_id").cast("long"), "text", "label").mapInArrow(
        run, "doc_id long, label int, t array<long>, w array<double>"
    )
    # At most max_rows vectors over max_terms terms.
    place = F.xxhash64(F.lit("examples"), "doc_id")
    found = vectors.withColumns({"third": third, "place": place}).toPandas().sort_values(["place", "doc_id", "label"])
    fitting = found[(found["third"] > 0) & (found["t"].str.len() > 0)]
    parts = [fitting[fitting["label"] == y].head(max_examples // 2) for y in (1, 0)]
    # Examples that share their weightiest term lie side by side, so that block bounds are tight.
    picked = [
        (int(np.asarray(t)[np.argmax(w)]), int(d), int(y), np.asarray(t, np.int64), np.asarray(w, float))
        for p in parts for d, y, t, w in zip(p["doc_id"], p["label"], p["t"], p["w"])
    ]
    picked.sort(key=lambda r: r[:3])
    model.index = BlockMaxIndex.build([(r[3], r[4]) for r in picked], len(names))
    model.examples = np.array([r[1] for r in picked], np.int64)
    model.labels = np.array([r[2] for r in picked], float)
    rest = found[found["third"] == 0]
    y = rest["label"].to_numpy(float)
    votes = np.full(len(rest), np.nan)
    for i, (t, w) in enumerate(zip(rest["t"], rest["w"])):
        near, cosines = model.index.nearest(np.asarray(t, np.int64), np.asarray(w, float), k)
        if len(near):
            votes[i] = (cosines * model.labels[near]).sum() / cosines.sum()
    known = ~np.isnan(votes)
    model.slope, model.shift = platt(votes[known], y[known]) if known.any() else (0.0, float(logit(np.array([rate]))[0]))
    model.prior = float((y[~known].sum() + rate) / ((~known).sum() + 1))
    return model


def score(
    docs: DataFrame, model: NeighbourModel, id_col: str = "doc_id", text_col: str = "text", bar: float = 0.5
) -> DataFrame:
    """`(doc_id, held_out, score, predicted, neighbours, cosines)` per row of `docs`.

    score is the calibrated probability of label 1; neighbours are the ids of the nearest examples
    with their cosines, which are the evidence. Texts without a term of the vocabulary, empty and null
    ones among them, have no neighbours and get the share of label 1 among such rows. Very long texts
    are read whole; repeated rows give repeated results; a null id counts as the empty text in the held-out test;
    an empty table gives no rows; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by max_examples and max_terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                found = [model.vote(t) for t in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0),
                        pa.array(model.scored(np.array([f[0] for f in found])), pa.float64()),
                        pa.array([model.examples[f[1]].tolist() for f in found], pa.list_(pa.int64())),
                        pa.array([f[2].tolist() for f in found], pa.list_(pa.float64())),
                    ],
                    ["doc_id", "score", "neighbours", "cosines"],
                )

    rows = two_columns(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double, neighbours array<long>, cosines array<double>").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= bar).cast("int").alias("predicted"),
        "neighbours",
        "cosines",
    )
