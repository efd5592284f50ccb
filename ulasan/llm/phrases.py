"""Phrase collocations from bidirectional FM-indexes over word ids, one index for each shard of text.

A task reads its texts in order and closes a shard of a language at about `shard_words` words. A shard
holds the Burrows-Wheeler transforms of its word ids read forwards and backwards, sorted by the first
four words only: deeper order is never asked for. An n-gram is an interval in each of the two;
extending it by a word to the left is one rank query in the forward transform, which also says how far
the interval in the backward one moves, and the same the other way round. A shard thus enumerates its
words, then their left extensions, then the right extensions of these, then the left ones of those, each with
its count. A task adds up the counts of its shards, some rows at a time, and Spark those of all tasks.

Before the next depth an n-gram must be frequent over all shards, and so must both n-grams inside it.
Shards learn which are from a Bloom filter of bounded size made of the summed counts. A false
positive costs a row that the sums drop again; a count is never wrong, whatever the filter's size.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ulasan.session import stored

#: Pieces end at these; phrases do not cross them. A `.` is never in a word and stands for all of them.
ENDS = b".,;:!?\n\x0b\x0c\r"
LOWER = bytes(ord(".") if b in ENDS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
DEPTH = 4
TEXT_STEP = 1 << 20
STEP_ROWS = 1 << 18
HELD_ROWS = 1 << 19
OPEN_SHARDS = 3
BATCH_BYTES = 1 << 22
TASK_SHARDS = 12
FILTER_BITS = 1 << 29  # at most 64 MB
U64 = np.uint64

INDEX = (
    "shard long, lang string, n long, ids array<long>, words array<binary>, counts array<long>, "
    "forward binary, backward binary, size long"
)


@contextmanager
def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> Iterator[None]:
    """What runs inside gets its rows in Arrow batches of about `most` bytes (and one row) at most. A batch
    of Spark's own 64 MB is held in full by the JVM and by Python, for each core."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


# --- the index of one shard ---------------------------------------------------


def places(keys: np.ndarray) -> np.ndarray:
    """Positions in order of their keys, which are at least zero; equal keys in order of position."""
    n = len(keys)
    if n and int(keys.max()) < (1 << 62) // n:
        keys = keys * n
        keys += np.arange(n)
        keys.sort()
        keys %= n
        return keys
    return np.argsort(keys, kind="stable")


def transform(ids: np.ndarray, size: int) -> np.ndarray:
    """The Burrows-Wheeler transform of ids below `size`, read as a circle and sorted by four ids."""
    keys = ids.astype(np.int64)
    keys *= size
    keys += np.roll(ids, -1)
    at = places(keys)
    keys = keys[at]
    pair = np.empty(len(ids), np.int32)
    pair[at] = np.cumsum(np.append(False, keys[1:] != keys[:-1]), dtype=np.int32)
    del at
    keys = pair.astype(np.int64)
    keys *= int(pair.max()) + 1
    keys += np.roll(pair, -2)
    return ids[places(keys) - 1]


def packed(ids: np.ndarray) -> bytes:
    """Compressed by byte planes; the high bytes of most ids are alike."""
    planes = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<i4").reshape(-1)


class Side:
    """Rank queries on one transform."""

    def __init__(self, bwt: np.ndarray):
        self.bwt, self.n = bwt, len(bwt)
        self.occurrences = bwt.astype(np.int64) * self.n + np.arange(self.n)
        self.occurrences.sort()

    def first(self, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Rows that begin with a smaller id, and those that begin with `ids` and stand before `rows`
        once their first id is taken off: where the extended interval begins."""
        return np.searchsorted(self.occurrences, ids.astype(np.int64) * self.n + rows)


@dataclass
class Nodes:
    """N-grams of a shard: their ids, and where their intervals begin forwards and backwards."""

    grams: np.ndarray
    count: np.ndarray
    forward: np.ndarray
    backward: np.ndarray

    def keep(self, which: np.ndarray) -> Nodes:
        return Nodes(self.grams[which], self.count[which], self.forward[which], self.backward[which])


class Index:
    """The bidirectional index of a shard whose ids are below `size`; id 0 parts the pieces."""

    def __init__(self, forward: np.ndarray, backward: np.ndarray, size: int):
        self.sides = Side(forward), Side(backward)
        self.size = size

    def words(self) -> Nodes:
        ids = np.arange(1, self.size, dtype=np.int32)
        first = self.sides[0].first(ids, np.zeros_like(ids))
        count = np.append(first[1:], self.sides[0].n) - first
        return Nodes(ids[:, None], count, first, first.copy())

    def _extended(self, nodes: Nodes, right: bool) -> Nodes:
        """All extensions by one word. The words before an n-gram are the ids of its forward interval;
        in the backward interval its extensions stand in their order."""
        side = self.sides[right]
        here, there = (nodes.backward, nodes.forward) if right else (nodes.forward, nodes.backward)
        ends = np.cumsum(nodes.count)
        which = np.repeat(np.arange(len(ends)), nodes.count)
        rows = np.arange(int(ends[-1]) if len(ends) else 0) - (ends - nodes.count)[which] + here[which]
        keys, count = np.unique(which * self.size + side.bwt[rows], return_counts=True)
        node, word = keys // self.size, keys % self.size
        # Extensions of a node stand together, the parting id 0 first among them.
        before = np.cumsum(count) - count
        shift = before - before[np.searchsorted(node, node)]
        near, far = side.first(word, here[node]), there[node] + shift
        grams = nodes.grams[node]
        new = word[:, None].astype(grams.dtype)
        grams = np.hstack([grams, new] if right else [new, grams])
        found = Nodes(grams, count, *((far, near) if right else (near, far)))
        return found.keep(word > 0)

    def extended(self, nodes: Nodes, right: bool, wanted: Callable[[np.ndarray], np.ndarray]) -> Nodes:
        """The extensions by one word whose n-grams are `wanted`, some nodes at a time, so that no more
        than about `STEP_ROWS` rows (or those of one n-gram) and what is kept are held."""
        step = np.cumsum(nodes.count) // STEP_ROWS
        starts = np.flatnonzero(np.diff(step, prepend=-1)) if len(step) else np.zeros(1, np.int64)
        out = []
        for lo, hi in zip(starts, [*starts[1:], len(step)]):
            found = self._extended(nodes.keep(slice(lo, hi)), right)
            out.append(found.keep(wanted(found.grams)))
        return Nodes(*(np.concatenate([getattr(x, f) for x in out]) for f in ("grams", "count", "forward", "backward")))

    def left(self, nodes: Nodes) -> Nodes:
        return self.extended(nodes, False, lambda grams: np.ones(len(grams), bool))

    def right(self, nodes: Nodes) -> Nodes:
        return self.extended(nodes, True, lambda grams: np.ones(len(grams), bool))


# --- shards of a table --------------------------------------------------------


class Shards:
    """Collects the word ids of one language in one task and gives index rows."""

    def __init__(self, lang: str, shard_words: int, seed: int, hash_bits: int):
        self.lang, self.most, self.seed = lang, shard_words, seed
        self.mask = (1 << hash_bits) - 1
        self._clear()

    def _clear(self) -> None:
        self.known: defaultdict[bytes, int] = defaultdict()
        self.known.default_factory = self.known.__len__
        self.known[b"."] = 0
        self.parts, self.held = [np.zeros(1, np.int32)], 1

    def add(self, text: bytes) -> None:
        data, at = text.translate(LOWER), 0
        while at < len(data):
            end = data.find(b" ", at + TEXT_STEP)
            end = len(data) if end < 0 else end
            words = data[at:end].replace(b".", b" . ").split()
            self.parts.append(np.fromiter(map(self.known.__getitem__, words), np.int32, len(words)))
            self.held += len(words)
            at = end
        self.parts.append(np.zeros(1, np.int32))
        self.held += 1

    def full(self) -> bool:
        return self.held >= self.most

    def rows(self) -> Iterator[tuple]:
        """Index rows of what was added; a very long text is parted where a piece ends."""
        ids, names = np.concatenate(self.parts), list(self.known)
        self._clear()
        while len(ids) > 1:
            cut = len(ids)
            if cut > 2 * self.most:
                ends = np.flatnonzero(ids[self.most :] == 0)
                cut = self.most + int(ends[0]) + 1
            yield from self._row(ids[:cut], names)
            ids = ids[cut - 1 :]

    def _row(self, ids: np.ndarray, names: list[bytes]) -> Iterator[tuple]:
        counts = np.bincount(ids, minlength=len(names))
        used = np.flatnonzero(counts)
        if len(used) < 2:
            return
        ids = (np.cumsum(counts > 0, dtype=np.int32) - 1)[ids]
        counts, words = counts[used], [names[i] for i in used[1:]]
        salt = self.lang.encode() + b"\0"
        keys = [xxhash.xxh64_intdigest(salt + w, self.seed) & self.mask for w in words]
        size = len(used)
        yield (
            self.lang,
            int(counts[1:].sum()),
            np.array(keys, U64).view(np.int64).tolist(),
            words,
            counts[1:].tolist(),
            packed(transform(ids, size)),
            packed(transform(ids[::-1], size)),
            len(ids),
        )


def build(docs: DataFrame, shard_words: int, seed: int, hash_bits: int = 64) -> DataFrame:
    """One row for each shard of `docs(lang, text as bytes)`. Texts are neither moved nor shuffled."""
    schema = pa.schema(
        [("shard", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), ("ids", pa.list_(pa.int64()))]
        + [("words", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64()))]
        + [("forward", pa.binary()), ("backward", pa.binary()), ("size", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, Shards] = {}
        numbers = itertools.count(TaskContext.get().partitionId() << 32)

        def closed(shards: Shards) -> Iterator[pa.RecordBatch]:
            for row in shards.rows():
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (next(numbers), *row)))], schema)

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                if lang not in open_:
                    open_[lang] = Shards(lang, shard_words, seed, hash_bits)
                open_[lang].add(text.as_py())
                if open_[lang].full():
                    yield from closed(open_[lang])
                elif len(open_) > 64 or sum(x.held for x in open_.values()) > OPEN_SHARDS * shard_words:
                    # Many languages in one task: the fullest is closed, so that memory stays bounded.
                    fullest = max(open_, key=lambda x: open_[x].held)
                    yield from closed(open_.pop(fullest))
        for shards in open_.values():
            yield from closed(shards)

    return docs.mapInArrow(run, INDEX)


# --- which n-grams are frequent -----------------------------------------------


def mixed(ids: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of word ids."""
    out = np.zeros(len(ids), U64)
    for k in range(ids.shape[1]):
        out = (out ^ ids[:, k].astype(np.int64).view(U64)) * U64(0x9E3779B97F4A7C15)
        out ^= out >> U64(29)
        out *= U64(0xBF58476D1CE4E5B9)
        out ^= out >> U64(32)
    return out


@dataclass
class Filter:
    """A Bloom filter of n-grams; it holds every n-gram it was made of, and few others."""

    cells: np.ndarray
    probes: int = 4

    @staticmethod
    def positions(grams: np.ndarray, bits: int, probes: int) -> np.ndarray:
        h = mixed(grams)
        step = (h >> U64(17)) | U64(1)
        return np.stack([(h + U64(i) * step) & U64(bits - 1) for i in range(probes)])

    def holds(self, grams: np.ndarray) -> np.ndarray:
        at = self.positions(grams, 64 * len(self.cells), self.probes)
        return ((self.cells[at >> U64(6)] >> (at & U64(63))) & U64(1)).all(axis=0)


PAGE = 4096  # cells of 64 bits that travel together


def filter_of(grams: DataFrame, names: list[str], most_bits: int = FILTER_BITS) -> Filter:
    """A filter of all rows of a stored table: 16 bits a row, up to `most_bits`.

    Tasks set bits in pages and Spark joins the pages; at most `most_bits` reach the driver.
    """
    n, probes = grams.count(), 4
    bits = 64
    while bits < min(most_bits, 16 * n):
        bits *= 2
    page = min(PAGE, bits // 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages: dict[int, np.ndarray] = {}
        for b in batches:
            rows = np.stack([c.to_numpy() for c in b.columns], axis=1)
            at = np.sort(Filter.positions(rows, bits, probes).reshape(-1))
            cell = (at >> U64(6)).astype(np.int64)
            starts = np.flatnonzero(np.diff(cell, prepend=-1))
            if not len(starts):
                continue
            set_, cell = np.bitwise_or.reduceat(U64(1) << (at & U64(63)), starts), cell[starts]
            for lo in np.flatnonzero(np.diff(cell // page, prepend=-1)):
                number = int(cell[lo] // page)
                here = slice(lo, np.searchsorted(cell, (number + 1) * page))
                pages.setdefault(number, np.zeros(page, U64))[cell[here] % page] |= set_[here]
        for number, held in pages.items():
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([held.tobytes()], pa.binary())], ["page", "bits"])

    def joined(some: pa.Table) -> pa.Table:
        held = [np.frombuffer(x.as_py(), U64) for x in some.column("bits")]
        return pa.table({"page": some.column("page")[:1], "bits": pa.array([np.bitwise_or.reduce(held).tobytes()], pa.binary())})

    pages = grams.select(*names).mapInArrow(run, "page long, bits binary")
    found = pages.groupBy("page").applyInArrow(joined, "page long, bits binary").toArrow()
    out = np.zeros(bits // 64, U64)
    for number, held in zip(found.column("page").to_pylist(), found.column("bits").to_pylist()):
        out[number * page : (number + 1) * page] = np.frombuffer(held, U64)
    return Filter(out, probes)


def names_of(depth: int) -> list[str]:
    return [f"w{i}" for i in range(1, depth + 1)]


def added_up(ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One row for each n-gram, with the sum of its counts, in order of their ids."""
    at = np.lexsort(ids.T[::-1])
    new = np.zeros(len(ids), bool)
    new[:1] = True
    for word in ids.T:
        word = word[at]
        new[1:] |= word[1:] != word[:-1]
    starts = np.flatnonzero(new)
    return ids[at[starts]], np.add.reduceat(count[at], starts) if len(starts) else count


def summed(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray]:
    """What is held added up; the list is emptied before, so that its rows are not there twice."""
    ids, count = map(np.concatenate, zip(*held))
    held.clear()
    return added_up(ids, count)


def combined(parts: Iterator[tuple[np.ndarray, ...]], most: int) -> Iterator[tuple[np.ndarray, ...]]:
    """N-grams and counts of many shards with those of the same n-gram added up. About `most` rows are
    held; when adding up leaves more than half of that, they are given out. A shard with over a quarter
    of that goes by, since few of so many n-grams come again."""
    held, rows = [], 0
    for part in parts:
        if len(part[1]) > most // 4:
            yield part
            continue
        held.append(part)
        rows += len(part[1])
        if rows >= most:
            held = [summed(held)]
            rows = len(held[0][1])
            if rows > most // 2:
                yield held.pop()
                rows = 0
    if held:
        yield summed(held)


def gathered(index: DataFrame, least: int = TASK_SHARDS) -> DataFrame:
    """The index in fewer tasks where Spark's splits are small: a task has `least` shards on average,
    and every core two tasks."""
    most = max(-(-index.count() // least), 2 * index.sparkSession.sparkContext.defaultParallelism)
    return index.coalesce(most) if most < index.rdd.getNumPartitions() else index


def counted(found: DataFrame, depth: int) -> DataFrame:
    """The sums of what all tasks have found. Rows are dealt out by n-gram before Spark adds them up: tasks
    have added up their own, so a sum ahead of the shuffle would hold each task's rows and merge few."""
    names = names_of(depth)
    return found.repartition(*names).groupBy(*names).agg(F.sum("a").alias("a"))


def enumerated(index: DataFrame, depth: int, filters: list[Filter], held_rows: int = HELD_ROWS) -> DataFrame:
    """`(w1 .. wk, a)`: the n-grams of `depth` words of each shard whose parts pass the filters, with
    their count there. Each shard is worked on alone, from its stored row. A task adds up the counts of
    its shards, within `held_rows`, so that an n-gram comes once from a task and not from every shard."""
    spark, names = index.sparkSession, names_of(depth)
    shared = [spark.sparkContext.broadcast(f) for f in filters]

    def of_shard(b: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray]:
        ids = np.concatenate([[0], b.column(0)[row].values.to_numpy()])
        n = b.column(3)[row].as_py()
        forward, backward = (unpacked(b.column(i)[row].as_py(), n) for i in (1, 2))
        fm = Index(forward, backward, len(ids))
        known = lambda grams, k: shared[k - 1].value.holds(ids[grams])
        nodes = fm.words()
        nodes = nodes.keep(known(nodes.grams, 1).astype(bool))
        for k in range(2, depth + 1):
            right = bool(k % 2)

            def wanted(grams: np.ndarray, k: int = k, right: bool = right) -> np.ndarray:
                # The n-gram that was extended is frequent; the other one inside is tested too.
                out = known(grams[:, 1:] if right else grams[:, :-1], k - 1).astype(bool)
                if k < depth:
                    out[out] = known(grams[out], k)
                return out

            nodes = fm.extended(nodes, right, wanted)
        return ids[nodes.grams], nodes.count.astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = (of_shard(b, row) for b in batches for row in range(b.num_rows))
        for ids, count in combined(shards, held_rows):
            for at in range(0, len(count), 1 << 17):
                some = slice(at, at + (1 << 17))
                columns = [pa.array(np.ascontiguousarray(ids[some, i])) for i in range(depth)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(count[some])], [*names, "a"])
            del ids, count  # not held while the next shard is worked on

    ddl = ", ".join(f"{c} long" for c in [*names, "a"])
    # Pairs and triples fill a task's sums from few shards; only longer n-grams are few enough to wait for more.
    index = gathered(index) if depth > 3 else index
    return index.select("ids", "forward", "backward", "size").mapInArrow(run, ddl)


# --- collocations -------------------------------------------------------------


def indexed(
    docs: DataFrame, shard_words: int, lang_col: str, text_col: str, hash_bits: int = 64
) -> tuple[DataFrame, DataFrame]:
    """The stored index, and all words as `(w1, lang, word, a)`.

    Word ids are hashes of language and word. Should two words share one, the index is made anew with
    another seed, so ids are exact.
    """
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )
    for seed in itertools.count():
        with small_batches(docs.sparkSession):
            index = stored(build(rows, shard_words, seed, hash_bits), "phrase-index")
        each = index.select("lang", F.explode(F.arrays_zip("ids", "words", "counts")).alias("x"))
        words = each.groupBy(F.col("x.ids").alias("w1"), "lang", F.col("x.words").cast("string").alias("word")).agg(
            F.sum("x.counts").alias("a")
        )
        words = stored(words, "words")
        if words.groupBy("w1").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            return index, words


def frequent_phrases(
    docs: DataFrame,
    longest: int = DEPTH,
    least: int = 30,
    shard_words: int = 1_000_000,
    lang_col: str = "lang",
    text_col: str = "text",
    filter_bits: int = FILTER_BITS,
    hash_bits: int = 64,
) -> tuple[list[DataFrame], DataFrame]:
    """Stored tables of the n-grams of 1, 2 .. `longest` words with at least `least` occurrences, as word
    ids and count `a` (the first with `lang, word`), and `(lang, n)` with all words of a language."""
    if not 1 <= longest <= DEPTH:
        raise ValueError(f"phrases have 1 to {DEPTH} words")
    index, words = indexed(docs, shard_words, lang_col, text_col, hash_bits)
    tables = [stored(words.where(F.col("a") >= least), "frequent-1")]
    filters: list[Filter] = []
    for depth in range(2, longest + 1):
        filters.append(filter_of(tables[-1], names_of(depth - 1), filter_bits))
        counts = counted(enumerated(index, depth, filters), depth)
        with small_batches(docs.sparkSession):
            tables.append(stored(counts.where(F.col("a") >= least), f"frequent-{depth}"))
    return tables, index.groupBy("lang").agg(F.sum("n").alias("n"))


def scored(tables: list[DataFrame], scale: int = 2_000_000) -> list[DataFrame]:
    """Each phrase of two or more words with its text, its cuts' least score and that cut's parts.

    Every part of a frequent phrase is frequent, so a phrase takes what it needs from the phrase without
    its last and that without its first word. `heads` and `tails` are the counts of its first and last
    1, 2 .. words.
    """
    first = tables[0].select("w1", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "a").select(
        "*", F.array("a").alias("heads"), F.array("a").alias("tails")
    )
    out, shorter = [], first
    for depth in range(2, len(tables) + 1):
        names = names_of(depth)
        left = shorter.select(*names[:-1], "lang", F.col("phrase").alias("begin"), "heads")
        right = shorter.select(*(F.col(f"w{i}").alias(f"w{i + 1}") for i in range(1, depth)), "last", "tails")
        joined = tables[depth - 1].join(left, names[:-1]).join(right, names[1:])
        cuts = []
        for k in range(1, depth):
            l, r = F.col("heads")[k - 1], F.col("tails")[depth - k - 1]
            cuts.append(F.struct(score_of(F.col("a"), l, r, scale).alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r")))
        phrases = joined.select(
            *names,
            "lang",
            F.concat_ws(" ", "begin", "last").alias("phrase"),
            "last",
            "a",
            F.concat("heads", F.array("a")).alias("heads"),
            F.concat("tails", F.array("a")).alias("tails"),
            (F.least(*cuts) if len(cuts) > 1 else cuts[0]).alias("cut"),
        )
        shorter = stored(phrases, f"phrases-{depth}")
        out.append(shorter)
    return out


def score_of(a: Column, l: Column, r: Column, scale: int) -> Column:
    """floor(scale * a / (l + r)), exact: the product is a decimal of 38 digits."""
    product = a.cast("decimal(20,0)") * F.lit(scale).cast("decimal(10,0)")
    return F.call_function("div", product, l.cast("decimal(20,0)") + r.cast("decimal(20,0)"))


def collocations(
    docs: DataFrame,
    longest: int = DEPTH,
    least: int = 30,
    top: int = 2000,
    share: int = 80,
    shard_words: int = 1_000_000,
    lang_col: str = "lang",
    text_col: str = "text",
    **options,
) -> DataFrame:
    """The `top` phrases of each language: `lang, rank, phrase, a, l, r, n, score, best_left, best_right`.

    A-Z are lower-cased, pieces end at `.,;:!?` and line ends, words at spaces and tabs. A phrase has 2 to
    `longest` words of one piece and at least `least` occurrences `a`, overlapping ones included. Its score
    is the least of floor(2000000 a / (l + r)) over its cuts into two parts with counts l and r. It is
    dropped if 100 f >= `share` a for the count f of some longer phrase around it; the longest such count
    is that of an extension by one word (`best_left`, `best_right`: the most frequent on either side, null
    below `least`). n counts all words of the language. Order: score, then a, both falling, then phrase.

    Null texts are empty, null languages are `und`. Texts of any length are read whole, in steps; repeated
    rows count as often as they stand there; ties are settled by the phrase; an empty table gives no rows;
    other columns are not read, whatever their names. Counts and filters cover all rows; a shard that
    closes early or late changes no result. Shards and sums are written to the shared folder, so a lost executor repeats only its tasks.
    """
    tables, sizes = frequent_phrases(docs, longest, least, shard_words, lang_col, text_col, **options)
    phrases = scored(tables)
    kept = []
    for depth, these in enumerate(phrases, start=2):
        names = names_of(depth)
        found = these.select("lang", "phrase", "a", "cut", *names)
        if depth - 1 < len(phrases):
            longer = tables[depth]
            for side, parts in (("best_left", names_of(depth + 1)[1:]), ("best_right", names)):
                best = longer.groupBy(*(F.col(w).alias(n) for w, n in zip(parts, names))).agg(F.max("a").alias(side))
                found = found.join(best, names, "left")
        else:
            found = found.select("*", *(F.lit(None).cast("long").alias(c) for c in ("best_left", "best_right")))
        around = F.coalesce(F.greatest("best_left", "best_right"), F.lit(0))
        kept.append(found.where(around * 100 < F.col("a") * share).drop(*names))
    if not kept:
        raise ValueError("phrases have at least two words")
    every = kept[0]
    for more in kept[1:]:
        every = every.unionByName(more)
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    # The first `top` of each of 64 parts hold the first of all; a language is never sorted in one task.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    every = every.select("*", F.col("cut.score").cast("long").alias("score"), part.alias("part"))
    every = every.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    every = every.where(F.col("rank") <= top)
    every = every.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return (
        every.where(F.col("rank") <= top)
        .join(sizes, "lang")
        .select(
            "lang", "rank", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", "score",
            "best_left", "best_right",
        )
    )
