"""Bounded-space online packing of tokenized documents into fixed windows.

Each task keeps `open_windows` windows open and places every document as it comes: whole windows are
cut off first, the rest goes into the fullest window that still has room (best fit). When none has
room and no further window may be opened, the fullest one is emitted. If more than `max_gap` places
of it are free, the document is cut to fill them, so a sequence never has more padding than that.
At the end of a task its open windows are poured together, which leaves at most one window that is
not full; those of all tasks are merged in groups of `fan_in` until one group is left.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ulasan.llm.common import two_columns
from ulasan.session import stored

ID_BYTES = 4


#: The words that a byte-level BPE cuts a text into before it merges bytes; a fixed value.
BYTE_LEVEL = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)

#: The faster encoder's pattern keeps a place to go back to for each character of a run of white space
#: and panics at about a million, so texts with a run this long go to `tokenizers`. Python's \s holds all of the pattern's.
LONG_RUN = 1 << 16
LONG_SPACE = re.compile(rf"(?<!\s)\s{{{LONG_RUN}}}")  # tried once for each run


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves,
    the others in order from code point 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def _fast(path: str):
    """The same merges for a faster encoder, if the file is a plain byte-level BPE; else None.

    That encoder takes the next merge by the id of its result, so ids must be in order of the merges.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    if (
        spec.get("normalizer") is not None
        or model.get("type") != "BPE"
        or cut.get("type") != "ByteLevel"
        or cut.get("add_prefix_space")
        or not cut.get("use_regex", True)
    ):
        return None
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    special = {t["content"] for t in spec.get("added_tokens", [])}
    if any(model["vocab"][a + b] != 256 + i for i, (a, b) in enumerate(merges)):
        return None
    byte_of = _byte_of()
    ranks = {
        bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in special
    }
    return tiktoken.Encoding("packing", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}), special


class TextEncoder:
    """Token ids as little-endian unsigned 32-bit bytes, as a `tokenizers` file gives them.

    For a plain byte-level BPE the same vocabulary runs in an encoder several times as fast. Each
    encoder compares the first texts it gets, and goes on with `tokenizers` if they differ; texts
    that hold a special token's string or a very long run of white space are always left to `tokenizers`.
    """

    def __init__(self, path: str, compare: int = 16):
        # Spark runs a worker for each core, so the library must not start threads of its own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.compare = Tokenizer.from_file(path), compare
        self.fast, self.special = _fast(path) or (None, set())

    def _plain(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(found.ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if self.fast is None or any(s in text for s in self.special):
            return self._plain(text)
        if len(text) >= LONG_RUN and LONG_SPACE.search(text):
            return self._plain(text)
        ids = np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
        if self.compare:
            self.compare -= 1
            want = self._plain(text)
            if want != ids:
                self.fast = None
                return want
        return ids


PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("part", pa.int64()),
        ("ids", pa.binary()),
    ]
)
PIECES_SQL = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, part long, ids binary"
)

#: A piece: (doc id, start in the document, ids, tokens of the document).
Piece = tuple[int | None, int, bytes, int]


class Packer:
    """Open windows and finished rows of one task. Sequence ids are `base`, `base + 1`, ..."""

    def __init__(self, window: int, open_windows: int, max_gap: int, base: int):
        self.window, self.most, self.gap, self.next = window, open_windows, max_gap, base
        self.open: list[list] = []  # [tokens, pieces]
        self.rows: list[tuple] = []

    def emit(self, pieces: list[Piece]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // ID_BYTES
            self.rows.append((doc, start, n, zlib.crc32(ids), total, self.next, offset, None, None))
            offset += n
        self.next += 1

    def add(self, doc: int | None, ids: bytes) -> None:
        total, size = len(ids) // ID_BYTES, self.window * ID_BYTES
        whole = len(ids) // size * size
        for at in range(0, whole, size):
            self.emit([(doc, at // ID_BYTES, ids[at : at + size], total)])
        if whole < len(ids):
            self.place((doc, whole // ID_BYTES, ids[whole:], total))

    def place(self, piece: Piece) -> None:
        doc, start, ids, total = piece
        n = len(ids) // ID_BYTES
        best = max((w for w in self.open if w[0] + n <= self.window), key=lambda w: w[0], default=None)
        if best is None and len(self.open) >= self.most:
            fullest = max(self.open, key=lambda w: w[0])
            self.open.remove(fullest)
            free = self.window - fullest[0]
            if free > self.gap:
                fullest[1].append((doc, start, ids[: free * ID_BYTES], total))
                start, ids, n = start + free, ids[free * ID_BYTES :], n - free
            self.emit(fullest[1])
        if best is None:
            self.open.append([n, [(doc, start, ids, total)]])
            return
        best[0] += n
        best[1].append((doc, start, ids, total))
        if best[0] == self.window:
            self.open.remove(best)
            self.emit(best[1])

    def pour(self, pieces: list[Piece]) -> list[Piece]:
        """Fill windows one after the other, cutting freely; returns what the last one holds."""
        held, free = [], self.window
        for doc, start, ids, total in pieces:
            while ids:
                take = ids[: free * ID_BYTES]
                held.append((doc, start, take, total))
                n = len(take) // ID_BYTES
                start, ids, free = start + n, ids[len(take) :], free - n
                if not free:
                    self.emit(held)
                    held, free = [], self.window
        return held

    def left(self) -> list[Piece]:
        """Pour the open windows together, the fullest first."""
        order = sorted(self.open, key=lambda w: -w[0])
        self.open = []
        return self.pour([p for _, pieces in order for p in pieces])

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows)) if rows else [[] for _ in PIECES]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, PIECES)], schema=PIECES
        )

    def keep(self, pieces: list[Piece], part: int) -> None:
        """Rows for the next merge, with their ids."""
        for i, (doc, start, ids, total) in enumerate(pieces):
            self.rows.append((doc, start, len(ids) // ID_BYTES, None, total, None, i, part, ids))


def _merger(window: int, open_windows: int, max_gap: int, level: int, last: bool):
    """Pours the windows of one group together; the last merge emits what is not full as well."""

    def merge(key, table):
        group = key[0].as_py()
        packer = Packer(window, open_windows, max_gap, (level << 56) | (group << 32))
        pieces = table.sort_by([("part", "ascending"), ("offset", "ascending")]).to_pylist()
        rest = packer.pour([(p["doc_id"], p["start"], p["ids"], p["doc_tokens"]) for p in pieces])
        if last and rest:
            packer.emit(rest)
        elif rest:
            packer.keep(rest, group)
        return pa.Table.from_batches([packer.batch()])

    return merge


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 1024,
    end_id: int = 0,
    open_windows: int = 32,
    max_gap: int = 8,
    fan_in: int = 256,
) -> DataFrame:
    """One row per piece: `doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`.

    Every token of every row lies in one piece, each document ends with `end_id`, and the offsets of a
    sequence run from 0 without gaps. A null or empty text is the end token alone; a null id stays
    null; repeated rows are packed once each; an empty table gives no rows; only the two columns are
    read. Rows are packed in the order of the scan, without a shuffle of texts; the pieces are stored
    once, so the merge of what is left sees the same windows that were emitted.
    """
    if window * ID_BYTES < 1 or open_windows < 1 or fan_in < 2:
        raise ValueError("window and open_windows must be positive, fan_in at least 2")
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(tokenizer)
        part = TaskContext.get().partitionId()
        packer = Packer(window, open_windows, max_gap, part << 32)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                for doc, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    packer.add(doc, encoder.encode(text or "") + tail)
            yield packer.batch()
        packer.keep(packer.left(), part)
        yield packer.batch()

    rows = two_columns(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    spread = docs.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < spread:  # a scan with fewer splits than cores
        rows = rows.repartition(spread, "doc_id")
    found = stored(rows.mapInArrow(run, PIECES_SQL), "packed")
    done, left, level = [found.where("part IS NULL")], found.where("part IS NOT NULL"), 1
    groups = (left.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        last = groups <= fan_in

        # A group is at most fan_in windows that are not full.
        merged = stored(
            left.groupBy(F.floor(F.col("part") / fan_in).cast("long").alias("group"))
            .applyInArrow(_merger(window, open_windows, max_gap, level, last), PIECES_SQL),
            "packed",
        )
        done.append(merged.where("part IS NULL"))
        if last:
            break
        left, level, groups = merged.where("part IS NOT NULL"), level + 1, -(-groups // fan_in)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("part", "ids")
