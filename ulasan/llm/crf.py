"""Document quality by a linear-chain conditional random field over lines.

Every line that holds a word is good or bad. Its features describe the line and its neighbours; a
transition score ties each label to the one before. Documents are labelled, not lines, so in training
every line carries its document's label. The forward-backward pass gives each line's probability of
being good; their mean, weighted by length, is the document's raw score, which is then calibrated.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ulasan.llm.calibration import logit, platt, sigmoid
from ulasan.llm.common import held_out, training_rows, two_columns

SYMBOLS, MARKS = b"#*$%&|<>", b"!?"
UPPER, DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
ENDS = b".!?:;"
OWN = 10
#: Of the line itself, then the mean of its neighbours for all but the first, then whether it is an end.
WIDTH = OWN + (OWN - 1) + 1


# --- features -----------------------------------------------------------------


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Rows of features, one per line that holds a word, and the lines' lengths in bytes."""
    seen: set[bytes] = set()
    rows, sizes = [], []
    for line in text.encode("utf-8", "surrogatepass").split(b"\n"):
        words = line.split()
        n = len(words)
        if not n:
            continue
        size = len(line)
        triples = len(set(zip(words, words[1:], words[2:]))) if n > 2 else 0
        rows.append(
            (
                n,
                (size - len(line.translate(None, SYMBOLS))) / n,
                (size - len(line.translate(None, MARKS))) / n,
                (size - len(line.translate(None, UPPER))) / size,
                (size - len(line.translate(None, DIGITS))) / size,
                1 - len(set(words)) / n,
                1 - triples / (n - 2) if n > 2 else 0.0,
                line in seen,
                size / n,
                words[-1][-1] in ENDS,
            )
        )
        seen.add(line)
        sizes.append(size)
    own = np.array(rows, np.float64).reshape(-1, OWN)
    own[:, 0] = np.log1p(own[:, 0])
    np.minimum(own[:, 1:3], 2.0, out=own[:, 1:3])
    own[:, 8] = np.minimum(own[:, 8], 30.0)
    if not len(own):
        return np.zeros((0, WIDTH)), np.zeros(0)
    before, after = np.r_[own[:1], own[:-1]], np.r_[own[1:], own[-1:]]
    edge = np.zeros((len(own), 1))
    edge[0] = edge[-1] = 1.0
    return np.hstack([own, ((before + after) / 2)[:, 1:], edge]), np.array(sizes, np.float64)


# --- the chain ----------------------------------------------------------------


def _padded(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(p) for p in parts])
    out = np.zeros((len(parts), int(sizes.max())) + parts[0].shape[1:])
    for i, p in enumerate(parts):
        out[i, : len(p)] = p
    return out, sizes


def forward_backward(unary: np.ndarray, sizes: np.ndarray, step: np.ndarray):
    """Marginals of chains `unary[d, t, label]` (log scores) under transitions `step[from, to]`.

    Returns P(label) [d, t, 2], summed P(from, to) [d, 2, 2] and the log partition function [d].
    Messages are scaled at each line, so long chains neither over- nor underflow.
    """
    d, t_max, _ = unary.shape
    top = unary.max(axis=2, keepdims=True)
    e, m = np.exp(unary - top), np.exp(step)
    alpha, beta, scale = np.zeros_like(e), np.ones_like(e), np.ones((d, t_max))
    for t in range(t_max):
        a = e[:, t] if t == 0 else (alpha[:, t - 1] @ m) * e[:, t]
        live = sizes > t
        s = np.where(live, a.sum(axis=1), 1.0)
        scale[:, t] = s
        alpha[:, t] = a / s[:, None]
    for t in range(t_max - 2, -1, -1):
        b = ((e[:, t + 1] * beta[:, t + 1]) @ m.T) / scale[:, t + 1][:, None]
        beta[:, t] = np.where((sizes > t + 1)[:, None], b, 1.0)
    gamma = alpha * beta
    gamma /= gamma.sum(axis=2, keepdims=True)
    mask = np.arange(t_max)[None, :] < sizes[:, None]
    both = np.zeros((d, 2, 2))
    if t_max > 1:
        right = e[:, 1:] * beta[:, 1:] / scale[:, 1:, None] * mask[:, 1:, None]
        both = np.einsum("dti,dtj->dij", alpha[:, :-1], right) * m[None]
    z = (np.log(scale) * mask).sum(axis=1) + (top[:, :, 0] * mask).sum(axis=1)
    return gamma, both, z


@dataclass(frozen=True)
class LineModel:
    """Weights of the good label over standardised features, transitions, and the calibration."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float
    step: np.ndarray
    slope: float
    shift: float
    prior: float

    def good(self, texts: list[str], group: int = 64) -> list[tuple[np.ndarray, np.ndarray]]:
        """Each text's P(good) per line and the lines' lengths."""
        found = [line_features(t) for t in texts]
        out: list = [(np.zeros(0), s) for _, s in found]
        order = sorted((i for i in range(len(texts)) if len(found[i][0])), key=lambda i: len(found[i][0]))
        for at in range(0, len(order), group):
            some = order[at : at + group]
            scores = [((found[i][0] - self.mean) / self.spread) @ self.weights + self.bias for i in some]
            unary, sizes = _padded([np.stack([np.zeros_like(s), s], axis=1) for s in scores])
            gamma = forward_backward(unary, sizes, self.step)[0]
            for k, i in enumerate(some):
                out[i] = (gamma[k, : sizes[k], 1], found[i][1])
        return out

    def raw(self, texts: list[str]) -> np.ndarray:
        """Length-weighted mean of the lines' P(good); NaN for a text without lines."""
        return np.array([(p * s).sum() / s.sum() if len(p) else np.nan for p, s in self.good(texts)])

    def scores(self, texts: list[str]) -> np.ndarray:
        raw = self.raw(texts)
        scored = sigmoid(self.slope * logit(np.nan_to_num(raw, nan=0.5), 1e-4) + self.shift)
        return np.where(np.isnan(raw), self.prior, scored)


def fit_chain(
    chains: list[np.ndarray], labels: np.ndarray, rounds: int = 150, rate: float = 0.1, ridge: float = 1e-3
):
    """Weights, bias and transitions that maximise the likelihood, each document weighing the same."""
    x, sizes = _padded(chains)
    mask = (np.arange(x.shape[1])[None, :] < sizes[:, None]).astype(float)
    share = mask / sizes[:, None] / len(sizes)
    per_doc = 1.0 / sizes / len(sizes)
    params = np.zeros(x.shape[2] + 1 + 4)
    m, v = np.zeros_like(params), np.zeros_like(params)
    pairs = (sizes - 1.0) * per_doc
    for k in range(1, rounds + 1):
        w, b, step = params[:-5], params[-5], params[-4:].reshape(2, 2)
        s = x @ w + b
        gamma, both, _ = forward_backward(np.stack([np.zeros_like(s), s], axis=2), sizes, step)
        miss = (gamma[:, :, 1] - labels[:, None]) * share
        want = np.zeros((2, 2))
        want[0, 0], want[1, 1] = pairs[labels == 0].sum(), pairs[labels == 1].sum()
        g_step = (both * per_doc[:, None, None]).sum(axis=0) - want
        g = np.r_[np.tensordot(miss, x, 2) + ridge * w, miss.sum(), (g_step + ridge * step).ravel()]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        params = params - rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return params[:-5], float(params[-5]), params[-4:].reshape(2, 2)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 4000, max_lines: int = 200) -> LineModel:
    """Fit on at most about `max_rows` labelled rows (`labels` is `(doc_id, quality)`), held-out rows
    excepted. Documents of more than `max_lines` lines, or none, are not used for fitting; scoring reads every line.
    Seven tenths fit the chain, the rest its calibration. Rows of one class only give a constant score.
    """
    rows = training_rows(docs, labels, "quality", max_rows, "crf")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, label in zip(*(batch.column(i).to_pylist() for i in range(3))):
                x, sizes = line_features(text or "")
                if len(x) <= max_lines:
                    out.append((doc, label, x.astype("<f4").tobytes(), sizes.astype("<f4").tobytes()))
            columns = list(zip(*out)) if out else [[]] * 4
            types = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "label", "x", "sizes"]
            )

    # Bounded by max_rows, max_lines and the number of features.
    found = (
        rows.select(F.col("doc_id").cast("long"), "text", "label")
        .mapInArrow(run, "doc_id long, label int, x binary, sizes binary")
        .toPandas()
        .sort_values(["doc_id", "label"])
    )
    y = (found["label"].to_numpy() == 1).astype(float)
    prior = float((y.sum() + 1) / (len(y) + 2))
    x = [np.frombuffer(b, "<f4").reshape(-1, WIDTH).astype(float) for b in found["x"]]
    sizes = [np.frombuffer(b, "<f4").astype(float) for b in found["sizes"]]
    some = [i for i in range(len(x)) if len(x[i])]
    if len(some) < 20 or len(set(y[some])) < 2:
        return LineModel(
            np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH), 0.0, np.zeros((2, 2)), 0.0,
            float(logit(np.array([prior]))[0]), prior,
        )
    every = np.vstack([x[i] for i in some])
    mean, spread = every.mean(axis=0), np.maximum(every.std(axis=0), 1e-3)
    # The rows are ordered by id, which says nothing about the text; every tenth to seventh fits.
    parts = {k: [i for n, i in enumerate(some) if (n % 10 < 7) == k] for k in (True, False)}
    w, b, step = fit_chain([(x[i] - mean) / spread for i in parts[True]], y[parts[True]])
    raw = []
    for at in range(0, len(parts[False]), 64):
        group = parts[False][at : at + 64]
        scores = [((x[i] - mean) / spread) @ w + b for i in group]
        unary, n = _padded([np.stack([np.zeros_like(s), s], axis=1) for s in scores])
        gamma = forward_backward(unary, n, step)[0]
        raw += [float((gamma[k, : n[k], 1] * sizes[i]).sum() / sizes[i].sum()) for k, i in enumerate(group)]
    slope, shift = platt(logit(np.array(raw), 1e-4), y[parts[False]])
    return LineModel(mean, spread, w, b, step, slope, shift, prior)


def score(
    docs: DataFrame, model: LineModel, id_col: str = "doc_id", text_col: str = "text", bar: float = 0.3
) -> DataFrame:
    """`(doc_id, held_out, score, predicted)` per row of `docs`.

    score is the calibrated probability of label 1. Null, empty and blank texts get the training rows'
    share of label 1; very long texts are read whole; repeated rows give repeated results; a null id
    counts as the empty text in the held-out test; an empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                values = model.scores([t or "" for t in some.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(values, pa.float64())], ["doc_id", "score"]
                )

    rows = two_columns(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= bar).cast("int").alias("predicted"),
    )
