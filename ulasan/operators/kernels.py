"""Block kernels run inside Arrow tasks: dense products of two bounded blocks of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TIE_DIGITS = 12  # scores equal to this many digits are ties and fall back to the id order


def matrix(column: pa.Array, normalize: bool) -> np.ndarray:
    """A list column as a double matrix; zero rows stay zero when normalising. Ragged lists raise."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.unique(pc.list_value_length(column)).to_pylist()
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(map(str, sizes))[:5]}")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = flat.reshape(len(column), -1)
    return unit(out) if normalize else out


def unit(rows: np.ndarray) -> np.ndarray:
    norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    return rows / np.where(norms > 0, norms, 1.0)[:, None]


def _of(scores: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of a block whose score reaches the limit of its row."""
    at = np.flatnonzero(scores >= limit[:, None])
    return np.divmod(at, scores.shape[1])


class TopK:
    """The k best ids of each query over the blocks it has seen.

    Inner products are looked through in single precision, with rows scaled to a length of at most one.
    What comes within the error of that of the k-th best so far is worked out in double precision.
    """

    def __init__(self, queries: np.ndarray, k: int, l2: bool, step: int = 1024, tile: int = 4096):
        self.q, self.k, self.l2, self.step, self.tile = queries, k, l2, step, tile
        self.floor = np.full(len(queries), -np.inf)  # score of the k-th best so far
        empty = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        self.best = [empty for _ in range(0, len(queries), step)]  # (query position, id, score) by step
        self.square = np.einsum("ij,ij->i", queries, queries)
        self.size = np.sqrt(self.square)
        self.near = queries if l2 else (queries / np.where(self.size > 0, self.size, 1.0)[:, None]).astype(np.float32)

    def add(self, ids: np.ndarray, v: np.ndarray) -> None:
        if not len(ids) or not len(self.q):
            return
        square = np.einsum("ij,ij->i", v, v)
        longest = float(np.sqrt(square.max())) or 1.0
        near = v if self.l2 else (v / longest).astype(np.float32)
        slack = 1e-9 if self.l2 else (v.shape[1] + 4) * 2.0**-22  # twice the bound on the rounding of a product
        lowest = np.sort(ids)[: self.k]
        for lo in range(0, len(self.q), self.step):
            some = slice(lo, lo + self.step)
            unit = np.where(self.size[some] > 0, self.size[some] * longest, 1.0) if not self.l2 else np.ones(len(self.q[some]))
            zero = np.flatnonzero(self.size[some] == 0) if not self.l2 else np.empty(0, np.int64)
            # A query without length has the same score with every row: its best are the lowest ids.
            new, waiting = [(np.repeat(zero + lo, len(lowest)), np.tile(lowest, len(zero)), np.zeros(len(zero) * len(lowest)))], 0
            for at in range(0, len(v), self.tile):
                part = slice(at, at + self.tile)
                block = self.near[some] @ near[part].T
                if self.l2:
                    block = 2.0 * block - (self.square[some, None] + square[None, part])
                floor = self.floor[some] / unit
                if np.isneginf(floor).any() and block.shape[1] > self.k:
                    first = block[:, : max(256, 2 * self.k)]
                    floor = np.maximum(floor, np.partition(first, -self.k, axis=1)[:, -self.k])
                limit = (floor - slack).astype(block.dtype)
                limit[zero] = np.inf
                row, col = _of(block, limit)
                new.append((row + lo, ids[col + at], self._exact(row + lo, v, col + at)))
                waiting += len(row)
                if waiting > 4 * self.k * len(block):
                    self._keep(lo, new)
                    new, waiting = [], 0
            if new:
                self._keep(lo, new)

    def _exact(self, row: np.ndarray, v: np.ndarray, col: np.ndarray) -> np.ndarray:
        out, most = np.empty(len(row)), max(1, (1 << 21) // max(1, v.shape[1]))
        for at in range(0, len(row), most):
            q, x = self.q[row[at : at + most]], v[col[at : at + most]]
            if self.l2:
                x = x - q
                out[at : at + most] = -np.einsum("ij,ij->i", x, x)
            else:
                out[at : at + most] = np.einsum("ij,ij->i", q, x)
        return out

    def _keep(self, lo: int, new: list[tuple[np.ndarray, ...]]) -> None:
        pos, ids, score = (np.concatenate(x) for x in zip(self.best[lo // self.step], *new))
        order = np.lexsort((ids, -np.round(score, TIE_DIGITS), pos))
        pos, ids, score = pos[order], ids[order], score[order]
        first = np.searchsorted(pos, pos)  # where the query's rows begin
        best = np.arange(len(pos)) - first < self.k
        pos, ids, score = self.best[lo // self.step] = pos[best], ids[best], score[best]
        n = np.bincount(pos - lo, minlength=len(self.q[lo : lo + self.step]))
        full = np.flatnonzero(n == self.k)
        self.floor[full + lo] = score[np.cumsum(n)[full] - 1]

    def rows(self):
        """(query position, id, score) arrays; distances are positive again."""
        if not self.best:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        pos, ids, score = (np.concatenate(x) for x in zip(*self.best))
        return pos, ids, -score if self.l2 else score


def lowest_copies(ids: np.ndarray, v: np.ndarray, k: int) -> np.ndarray:
    """Positions of the rows that are among the k lowest ids of their vector, in order of position."""
    if not v.shape[1]:
        return np.sort(np.argsort(ids, kind="stable")[:k])
    same = np.ascontiguousarray(v).view(np.dtype((np.void, v.shape[1] * v.itemsize))).reshape(-1)
    _, group = np.unique(same, return_inverse=True)
    order = np.lexsort((ids, group))
    sorted_ = group[order]
    return np.sort(order[np.arange(len(order)) - np.searchsorted(sorted_, sorted_) < k])


HEADS = (0.25, 0.375, 0.5)  # shares of the dimensions that may be looked at first
FINISH = 10_000.0  # multiplications in the time that it takes to finish one open pair of up to 64 dimensions


def _head(left: np.ndarray, right: np.ndarray, order: np.ndarray, threshold: float) -> int:
    """How many of the dimensions to look at first, by what a bound on the others leaves open in a few rows.

    All of them if no bound is worth its while.
    """
    d = left.shape[1]
    a, b = (x[:: max(1, len(x) // 256)][:256][:, order] for x in (left, right))
    best, least = d, float(d)
    for share in HEADS:
        h = max(1, round(share * d))
        rest = [np.sqrt(np.einsum("ij,ij->i", x[:, h:], x[:, h:])) for x in (a, b)]
        left_open = np.count_nonzero(a[:, :h] @ b[:, :h].T + rest[0][:, None] * rest[1][None, :] > threshold)
        cost = h + 1 + FINISH * (left_open / (len(a) * len(b))) * max(1, d / 64)
        if h < d and cost < least:
            best, least = h, cost
    return best


def pairs_above(left_ids, left, right_ids, right, same: bool, threshold: float, step: int = 1024, tile: int = 4096):
    """Batches of (i, j, similarity) of unit rows above the threshold, each pair with the smaller id first.

    Dimensions are put in order of their weight. Over the first of them the dot products are worked out for
    all pairs, in single precision; what the others can add is at most the product of their norms, which is
    one more dimension. Only pairs that may still pass, with room for rounding, are finished, in double
    precision. No more than `step` by `tile` products are held. With `same` both sides are one block: its
    pairs come once.
    """
    if not len(left) or not len(right):
        return
    if same:  # the same rows, perhaps in another order
        right_ids, right = left_ids, left
    d = left.shape[1]
    order = np.argsort(-np.einsum("ij,ij->j", left, left), kind="stable")
    h = _head(left, right, order, threshold)
    limit = np.float32(threshold - (d + 4) * 2.0**-22)

    def looked_at(x: np.ndarray) -> np.ndarray:
        if h == d:
            return x.astype(np.float32)
        rest = x[:, order[h:]]
        return np.column_stack([x[:, order[:h]], np.sqrt(np.einsum("ij,ij->i", rest, rest))]).astype(np.float32)

    first = looked_at(left)
    other = first if same else looked_at(right)
    most = max(1, (1 << 21) // d)
    for lo in range(0, len(left), step):
        for at in range(lo if same else 0, len(right), tile):
            block = first[lo : lo + step] @ other[at : at + tile].T
            a, b = np.divmod(np.flatnonzero(block > limit), block.shape[1])
            a, b = a + lo, b + at
            if same and at < lo + step:
                a, b = a[a < b], b[a < b]
            for n in range(0, len(a), most):
                x, y = a[n : n + most], b[n : n + most]
                found = np.einsum("ij,ij->i", left[x], right[y])
                i, j = left_ids[x], right_ids[y]
                keep = (found > threshold) & (i != j)
                if keep.any():
                    yield np.minimum(i, j)[keep], np.maximum(i, j)[keep], found[keep]
