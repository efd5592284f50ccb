"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

A text is cut into words by the tokenizer's pattern. In each word the ranks of all adjacent pairs are
the leaves of a segment tree whose nodes hold the least (rank, place) below them, so the root yields
the leftmost pair of the lowest rank. A merge changes three leaves (the pair itself, the one before,
the one swallowed), each in as many steps as the tree is high; it ends when no pair can be merged.
A word of n bytes thus takes O(n log n) steps, also where a whole text is one word. Short words that
are new to a worker are merged side by side, as rows of one array of trees.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ulasan.llm.common import two_columns

#: The words that a byte-level BPE cuts a text into before it merges bytes; a fixed value.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Letters, numbers and spaces are not the same in every version of Unicode. A text with a character
#: outside these ranges, in which `regex` and `tokenizers` agree, is cut by `tokenizers`.
RANGES = ((0x0, 0x557), (0xCDD, 0x208E), (0x20A0, 0xA7CD), (0xAC00, 0xD7A3), (0xF900, 0xFFFF), (0x1F000, 0x1FAFF))
DISPUTED = re.compile("[^" + "".join(f"{chr(a)}-{chr(b)}" for a, b in RANGES) + "]")
#: A cut before white space that follows something else never parts a word of the pattern.
SAFE_CUT = regex.compile(r"(?<=\S)\s")
TEXT_STEP = 1 << 20


def agreed_pattern() -> re.Pattern:
    """BYTE_LEVEL for the standard library's faster matcher, with its classes spelled out over RANGES."""
    chars = "".join(chr(c) for a, b in RANGES for c in range(a, b + 1))

    def spelled(kind: str) -> str:
        points = np.array([ord(c) for c in regex.findall(kind, chars)])
        runs = np.split(points, np.flatnonzero(np.diff(points) != 1) + 1)
        return "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in runs)

    letter, number, space = (spelled(k) for k in (r"\p{L}", r"\p{N}", r"\s"))
    # The lookahead and the negated class first: their `\s` stands inside brackets or alone.
    pattern = BYTE_LEVEL.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letter}{number}]").replace(r"(?!\S)", f"(?![^{space}])")
    return re.compile(pattern.replace(r"\p{L}", f"[{letter}]").replace(r"\p{N}", f"[{number}]").replace(r"\s", f"[{space}]"))


NO_PAIR = 1 << 62
PLACE_BITS = 32
CACHE_WORDS, CACHE_BYTES = 500_000, 64
HELD_WORDS = 300_000


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves,
    the others in order from code point 256 on."""
    printable = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class PairTree:
    """The least key over the adjacent pairs of one word; leaf i is the pair that begins at place i."""

    def __init__(self, keys: list[int]):
        self.m = m = len(keys)
        self.least = least = [NO_PAIR] * m + keys
        for i in range(m - 1, 0, -1):
            a, b = least[2 * i], least[2 * i + 1]
            least[i] = a if a < b else b

    def root(self) -> int:
        return self.least[1]

    def put(self, leaf: int, key: int) -> None:
        least, i = self.least, leaf + self.m
        least[i] = key
        while i > 1:
            other = least[i ^ 1]
            now = key if key < other else other
            i >>= 1
            if least[i] == now:
                return
            least[i] = key = now


class PairTrees:
    """The trees of many words at once, a row each: `m` leaves, of which the last ones hold no pair."""

    def __init__(self, keys: np.ndarray):
        n, self.m = keys.shape
        self.least = np.empty((n, 2 * self.m), np.int64)
        self.least[:, self.m :] = keys
        at = self.m
        while at > 1:
            np.minimum(self.least[:, at : 2 * at : 2], self.least[:, at + 1 : 2 * at : 2], out=self.least[:, at // 2 : at])
            at //= 2

    def put(self, rows: np.ndarray, leaves: np.ndarray, keys: np.ndarray) -> None:
        """One leaf in each of the rows."""
        at = leaves + self.m
        self.least[rows, at] = keys
        for _ in range(self.m.bit_length() - 1):
            at >>= 1
            self.least[rows, at] = np.minimum(self.least[rows, 2 * at], self.least[rows, 2 * at + 1])


class Bpe:
    """Encoder and decoder of one `tokenizers` file that holds a plain byte-level BPE.

    Strings of added tokens stand for their own id wherever they occur, as in `tokenizers`. Files with
    a normalizer, word affixes, dropout or another cut into words raise ValueError.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut, added = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
        plain = (
            model.get("type") == "BPE"
            and spec.get("normalizer") is None
            and spec.get("post_processor") is None
            and not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
            and cut.get("type") == "ByteLevel"
            and not cut.get("add_prefix_space")
            and cut.get("use_regex", True)
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added)
        )
        if not plain:
            raise ValueError(f"{path} is not a plain byte-level BPE")
        byte_of, vocab = byte_characters(), model["vocab"]
        self.path = path
        self.added = {t["content"]: t["id"] for t in added}
        self.bytes_of: dict[int, bytes] = {
            i: bytes(byte_of[c] for c in token) for token, i in vocab.items() if token not in self.added
        }
        self.bytes_of |= {i: token.encode() for token, i in self.added.items()}
        self.first = [vocab[c] for c, _ in sorted(byte_of.items(), key=lambda x: x[1])]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank: dict[int, int] = {}
        self.result = [vocab[a + b] for a, b in pairs]
        for k, (a, b) in enumerate(pairs):
            self.rank.setdefault(vocab[a] << PLACE_BITS | vocab[b], k)
        self.pattern = agreed_pattern()
        # The same ranks as sorted arrays, for many words at once.
        ranked = sorted(self.rank.items())
        self.pair_keys, self.pair_ranks = (np.array([x[i] for x in ranked], np.int64) for i in (0, 1))
        self.results, self.first_ids = np.array(self.result, np.int64), np.array(self.first, np.int64)
        # The longest first, so that one that begins another does not hide it.
        names = sorted(self.added, key=len, reverse=True)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.library = None
        self.cache = WordCache(self)

    def _words(self, text: str) -> list[str]:
        if not DISPUTED.search(text):
            return self.pattern.findall(text)
        if self.library is None:
            from tokenizers import pre_tokenizers

            self.library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def merged(self, word: bytes) -> list[int]:
        """The ids of one word."""
        ids, n = [self.first[b] for b in word], len(word)
        if n < 2:
            return ids
        rank, result, no = self.rank, self.result, NO_PAIR

        def key(at: int, following: int) -> int:
            k = rank.get(ids[at] << PLACE_BITS | ids[following])
            return no if k is None else k << PLACE_BITS | at

        tree = PairTree([key(i, i + 1) for i in range(n - 1)])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (best := tree.root()) != no:
            at = best & ((1 << PLACE_BITS) - 1)
            gone = after[at]
            following = after[gone]
            ids[at] = result[best >> PLACE_BITS]
            ids[gone] = -1
            after[at] = following
            if gone < n - 1:
                tree.put(gone, no)
            if following < n:
                before[following] = at
                tree.put(at, key(at, following))
            else:
                tree.put(at, no)
            if before[at] >= 0:
                tree.put(before[at], key(before[at], at))
        return [i for i in ids if i >= 0]

    def _keys(self, left: np.ndarray, right: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Rank and place of pairs; an id below zero is no id."""
        pair = left << PLACE_BITS | right
        at = np.minimum(np.searchsorted(self.pair_keys, pair), len(self.pair_keys) - 1)
        known = (self.pair_keys[at] == pair) & (left >= 0) & (right >= 0)
        return np.where(known, self.pair_ranks[at] << PLACE_BITS | places, NO_PAIR)

    def merged_many(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of many short words, which are merged side by side, each by its own tree."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        high = 0
        while (sizes > high).any():
            low, high = high, max(2, 2 * high)
            here = np.flatnonzero((sizes > low) & (sizes <= high))
            for lo in range(0, len(here), 4096):
                some = here[lo : lo + 4096]
                for i, ids in zip(some, self._side_by_side([words[i] for i in some], sizes[some], high)):
                    out[i] = ids
        return out

    def _side_by_side(self, words: list[bytes], sizes: np.ndarray, m: int) -> list[bytes]:
        n, places = len(words), np.arange(m)
        raw = np.frombuffer(b"".join(w.ljust(m, b"\0") for w in words), np.uint8).reshape(n, m)
        ids = np.full((n, m + 1), -1, np.int64)
        ids[:, :m] = np.where(places < sizes[:, None], self.first_ids[raw], -1)
        trees = PairTrees(self._keys(ids[:, :-1], ids[:, 1:], places[None, :]))
        after, before = np.tile(np.arange(1, m + 2), (n, 1)), np.tile(np.arange(-1, m), (n, 1))
        rows = np.arange(n)
        while True:
            best = trees.least[rows, 1]
            rows, best = rows[best != NO_PAIR], best[best != NO_PAIR]
            if not len(rows):
                break
            at = best & ((1 << PLACE_BITS) - 1)
            gone = after[rows, at]
            following = after[rows, gone]
            ids[rows, at], ids[rows, gone] = self.results[best >> PLACE_BITS], -1
            after[rows, at], before[rows, np.minimum(following, m)] = following, at
            trees.put(rows, gone, np.full(len(rows), NO_PAIR))
            trees.put(rows, at, self._keys(ids[rows, at], ids[rows, np.minimum(following, m)], at))
            some = before[rows, at] >= 0
            left, mid, those = before[rows, at][some], at[some], rows[some]
            trees.put(those, left, self._keys(ids[those, left], ids[those, mid], left))
        kept = ids >= 0
        flat, ends = ids[kept].astype("<u4").tobytes(), 4 * np.cumsum(kept.sum(axis=1))
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def _learn(self, words: set[str]) -> None:
        """Put the words that are new and short into the cache, all at once."""
        new = words.difference(self.cache)
        raw = {w: b for w in new if len(b := w.encode("utf-8", "surrogatepass")) <= CACHE_BYTES}
        self.cache.add(list(raw), self.merged_many(list(raw.values())))

    def _parts(self, text: str) -> Iterator[str | int]:
        """The text in parts that are cut into words as they would be in the whole; added tokens by id."""
        if self.specials is None or not any(s in text for s in self.added):
            pieces = [text]
        else:
            pieces = self.specials.split(text)
        for piece in pieces:
            if piece in self.added:
                yield self.added[piece]
                continue
            at = 0
            while len(piece) - at > 2 * TEXT_STEP and (cut := SAFE_CUT.search(piece, at + TEXT_STEP)):
                yield piece[at : cut.start()]
                at = cut.start()
            yield piece[at:] if at else piece

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text as unsigned 32-bit numbers. Words are held and learnt some hundred thousand
        at a time, so that new ones are merged together."""
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, list[str] | int]] = []
        n = 0

        def settle() -> None:
            self._learn(set().union(*(x for _, x in held if isinstance(x, list))))
            for i, x in held:
                out[i].append(np.array([x], "<u4").tobytes() if isinstance(x, int) else b"".join(map(self.cache.__getitem__, x)))
            held.clear()

        for i, text in enumerate(texts):
            for part in self._parts(text):
                words = part if isinstance(part, int) else self._words(part)
                held.append((i, words))
                n += 1 if isinstance(words, int) else len(words)
                if n >= HELD_WORDS:
                    settle()
                    n = 0
        settle()
        return [np.frombuffer(b"".join(x), "<u4") for x in out]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_many([text])[0]

    def decode(self, ids) -> str:
        """The text of ids; unknown ids have none, bytes that are not UTF-8 become U+FFFD."""
        table = self.bytes_of
        try:
            found = b"".join(map(table.__getitem__, ids))
        except KeyError:
            found = b"".join(table.get(i, b"") for i in ids)
        return found.decode("utf-8", "replace")


class WordCache(dict):
    """Packed ids of words seen before. It holds a bounded number of short words and is emptied when full."""

    def __init__(self, bpe: Bpe):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, word: str) -> bytes:
        raw = word.encode("utf-8", "surrogatepass")
        packed = np.array(self.bpe.merged(raw), "<u4").tobytes()
        if len(raw) <= CACHE_BYTES:
            self.add([word], [packed])
        return packed

    def add(self, words: list[str], packed: list[bytes]) -> None:
        if len(self) + len(words) > CACHE_WORDS:
            self.clear()
        self.update(zip(words, packed))


_LOADED: dict[str, Bpe] = {}


def loaded(path: str) -> Bpe:
    """One encoder for each worker and file."""
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


def _by_rows(
    rows: DataFrame, columns: dict[str, pa.DataType], work: Callable[[pa.Array], list[list]], at_once: int = 1 << 22
) -> DataFrame:
    """`doc_id` and the columns that `work` makes of the second column, some rows of about `at_once` bytes
    together, or a single longer one."""
    id_type = rows.schema["doc_id"].dataType.simpleString()
    ddl = {pa.string(): "string", pa.list_(pa.int32()): "array<int>"}

    def array(values: list, kind: pa.DataType) -> pa.Array:
        if kind == pa.string():
            return pa.array(values, kind)
        ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
        flat = np.concatenate([*values, np.empty(0, "<u4")]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # Bytes of a text, elements of a list.
            size = pc.binary_length(b.column(1)) if pa.types.is_binary(b.column(1).type) else pc.list_value_length(b.column(1))
            size = np.asarray(pc.fill_null(size, 0))
            step = np.cumsum(size) // at_once
            starts = np.flatnonzero(np.diff(step, prepend=-1)) if len(step) else []
            for lo, hi in zip(starts, [*starts[1:], len(step)]):
                made = work(b.column(1).slice(lo, hi - lo))
                arrays = [array(values, kind) for values, kind in zip(made, columns.values())]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), *arrays], ["doc_id", *columns])

    return rows.mapInArrow(run, ", ".join([f"doc_id {id_type}", *(f"{c} {ddl[k]}" for c, k in columns.items())]))


def _bytes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return two_columns(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary"))


def _texts(values: pa.Array) -> list[str]:
    return [(v or b"").decode("utf-8", "replace") for v in values.to_pylist()]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`(doc_id, ids)` per row, ids as `tokenizers` gives them for the file without added special tokens.

    Null and empty texts have no ids. A text of any length is encoded whole, also one that is a single
    word. Repeated rows and null ids stay as they are; other columns are not read, whatever their names;
    an empty table gives no rows. Rows are independent, so nothing is shuffled.
    """
    return _by_rows(
        _bytes(docs, id_col, text_col),
        {"ids": pa.list_(pa.int32())},
        lambda v: [loaded(path).encode_many(_texts(v))],
    )


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """`(doc_id, text)` per row of ids. Null lists are empty texts; null and unknown ids add nothing."""
    rows = tokens.select(F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return _by_rows(rows, {"text": pa.string()}, lambda v: [[loaded(path).decode(x or []) for x in v.to_pylist()]])


def encode_and_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`(doc_id, ids, decoded)`: what `encode` gives, and what `decode` makes of it, in one pass."""

    def work(values: pa.Array) -> list[list]:
        bpe = loaded(path)
        ids = bpe.encode_many(_texts(values))
        return [ids, [bpe.decode(x.tolist()) for x in ids]]

    return _by_rows(
        _bytes(docs, id_col, text_col), {"ids": pa.list_(pa.int32()), "decoded": pa.string()}, work
    )


def joined_ids(ids: Column) -> Column:
    """Decimal ids joined by commas."""
    return F.array_join(ids.cast("array<string>"), ",")
