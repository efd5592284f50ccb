"""Document fingerprints by one-permutation MinHash.

The words' shingles are hashed once; the high part of a hash says which bin it falls in, and each bin
keeps its smallest hash. An empty bin takes the value of a full one, found by a fixed sequence of
random probes for that bin (optimal densification), so equal sets of shingles fill it alike. Of each
bin only the lowest `bits` bits are stored; that two different values agree in these bits by chance is
taken out of the likeness.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ulasan.llm.common import two_columns
from ulasan.session import stored

U64 = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Minhash:
    """Fingerprints of `bins` bins and `bits` bits each, over shingles of `shingle` words."""

    def __init__(self, bins: int = 512, bits: int = 4, shingle: int = 5, probes: int = 64):
        if bins < 8 or bins & (bins - 1) or bits not in (1, 2, 4, 8):
            raise ValueError("bins must be a power of two of at least 8, bits 1, 2, 4 or 8")
        self.bins, self.bits, self.shingle, self.probes = bins, bits, shingle, probes
        self.tables: list[np.ndarray] = []

    def _probes(self, k: int) -> np.ndarray:
        """Rows k x probes and on of the probe sequences, a column for each bin, by a rule."""
        while len(self.tables) <= k:
            first = len(self.tables) * self.probes
            at = np.arange(first, first + self.probes, dtype=U64)[:, None] * U64(self.bins)
            at = mixed(at + np.arange(self.bins, dtype=U64)[None, :] + U64(0x9E3779B97F4A7C15))
            self.tables.append((at & U64(self.bins - 1)).astype(np.int32))
        return self.tables[k]

    def words(self, text: str) -> np.ndarray:
        digest = xxhash.xxh64_intdigest
        found = text.encode("utf-8", "surrogatepass").split()
        return np.fromiter(map(digest, found), U64, len(found))

    def shingles(self, words: np.ndarray) -> np.ndarray:
        """Hashes of all shingles; of fewer words, that of the whole sequence."""
        n = max(1, len(words) - self.shingle + 1)
        out = np.full(n, U64(len(words) if len(words) < self.shingle else self.shingle))
        for k in range(min(self.shingle, len(words))):
            out = mixed(out * U64(0x9E3779B97F4A7C15) + words[k : k + n])
        return out

    def fingerprint(self, words: np.ndarray) -> np.ndarray | None:
        """One number of `bits` bits per bin; None without words."""
        if not len(words):
            return None
        hashes = self.shingles(words)
        least = np.full(self.bins, U64(0xFFFFFFFFFFFFFFFF))
        shift = U64(64 - self.bins.bit_length() + 1)
        np.minimum.at(least, (hashes >> shift).astype(np.int64), hashes)
        full = least != U64(0xFFFFFFFFFFFFFFFF)
        if full.sum() == 1:
            least[:] = least[full][0]
        else:
            empty, k = np.flatnonzero(~full), 0
            while len(empty):
                probe = self._probes(k)[:, empty]
                hit = full[probe]
                first = hit.argmax(axis=0)
                done = hit[first, np.arange(len(empty))]
                least[empty[done]] = least[probe[first[done], np.flatnonzero(done)]]
                empty, k = empty[~done], k + 1
        # The low bits of a mixed hash do not depend on the bin, which took the high ones.
        return (mixed(least) & U64((1 << self.bits) - 1)).astype(np.uint8)

    def packed(self, fp: np.ndarray | None) -> str:
        """Hexadecimal; a text without words has the empty string."""
        if fp is None:
            return ""
        if self.bits == 8:
            return fp.tobytes().hex()
        bits = np.unpackbits(fp[:, None], axis=1)[:, 8 - self.bits :]
        return np.packbits(bits.reshape(-1)).tobytes().hex()

    def unpacked(self, text: str) -> np.ndarray | None:
        if not text:
            return None
        bits = np.unpackbits(np.frombuffer(bytes.fromhex(text), np.uint8)).reshape(-1, self.bits)
        return np.packbits(bits, axis=1).reshape(-1) >> (8 - self.bits)

    def likeness(self, a: np.ndarray | None, b: np.ndarray | None) -> float:
        """Estimated Jaccard likeness of the shingle sets, 0 to 1; two texts without words are equal."""
        if a is None or b is None:
            return float(a is None and b is None)
        chance = 0.5**self.bits
        return min(1.0, max(0.0, (float(np.mean(a == b)) - chance) / (1.0 - chance)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`(doc_id, fingerprint)` per row. Null and empty texts have the empty fingerprint, repeated rows
    repeated ones, null ids stay null; other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Minhash(**options)
        for batch in batches:
            out = [m.packed(m.fingerprint(m.words(t.as_py() or ""))) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "fingerprint"])

    rows = two_columns(docs, id_col, text_col)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def beside_next(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_run: int = 2000
) -> tuple[DataFrame, int]:
    """`(run, kind, doc_id, text)` such that, in each run ordered by kind and then descending doc_id, a
    row of kind 0 is followed by its next document; the number of partitions to deal runs into.

    Ids are cut into runs by value. The last row of a run needs the first row of the next run that has
    any, so that row is put in both (kind 1). Only ids are read to find these heads.
    """
    rows = two_columns(docs, id_col, text_col).where("doc_id IS NOT NULL")
    low, high, n = rows.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    if not n:
        return rows.select(F.lit(0).cast("long").alias("run"), F.lit(0).alias("kind"), "doc_id", "text"), 1
    width = max(1, -(-(high - low + 1) * rows_per_run // n))
    run = F.floor((F.lit(high) - F.col("doc_id")) / F.lit(width)).cast("long")
    rows = rows.withColumn("run", run)
    # One short row per run, so the lead over all of them stays small: n / rows_per_run rows.
    heads = rows.groupBy("run").agg(F.max("doc_id").alias("head"))
    heads = stored(heads, "heads")
    previous = heads.select(
        F.col("head"), F.lag("run").over(Window.orderBy("run")).alias("previous")
    )
    last = heads.agg(F.max("run")).first()[0]
    previous = previous.select("head", F.coalesce("previous", F.lit(last)).alias("previous"))
    extra = rows.join(previous, rows["doc_id"] == previous["head"]).select(
        F.col("previous").alias("run"), F.lit(1).alias("kind"), "doc_id", "text"
    )
    both = rows.select("run", F.lit(0).alias("kind"), "doc_id", "text").unionByName(extra)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return both, parts


COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compare_with_edits(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_run: int = 2000, **options
) -> DataFrame:
    """Each document against an edited form of itself and against the next document.

    The next document is that of the next smaller id; after the smallest comes the largest. In the
    edited text the last half of the code points (rounded down) is replaced by as many of the first
    code points of the next document, or all it has. Columns: `doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next`. Null texts are empty; rows without an
    id have no place in the order and are left out; rows that share an id stand side by side; a
    single document is its own next; an empty table gives no rows. Texts are shuffled once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Minhash(**options)
        held = None

        def row(this, following):
            _, doc, text, _, fp = this
            half = len(text) // 2
            edited = text[: len(text) - half] + following[2][:half]
            other = m.fingerprint(m.words(edited))
            return (
                doc, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                m.packed(fp), m.packed(other), m.likeness(fp, other), m.likeness(fp, following[4]),
            )

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out = []
                some = batch.slice(at, 256)
                for where, kind, doc, text in zip(*(some.column(i).to_pylist() for i in range(4))):
                    text = text or ""
                    now = (where, doc, text, kind, m.fingerprint(m.words(text)))
                    if held is not None and held[3] == 0 and held[0] == where:
                        out.append(row(held, now))
                    held = now
                columns = list(zip(*out)) if out else [[] for _ in range(7)]
                types = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)],
                    [x.split()[0] for x in COMPARED.split(", ")],
                )

    both, parts = beside_next(docs, id_col, text_col, rows_per_run)
    return (
        both.repartition(parts, "run")
        .sortWithinPartitions("run", "kind", F.desc("doc_id"))
        .mapInArrow(run, COMPARED)
    )
