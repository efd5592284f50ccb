"""Near-duplicate groups by SimHash and a hierarchical index in Gray order.

Fingerprints are 64 bits. To find all pairs within `max_bits` differing bits, the bits are cut into
`blocks` blocks; two such fingerprints agree on at least `blocks - max_bits` of them, whichever they
are. For each choice of that many blocks (a table) the chosen bits are moved to the front, the result
is read as a Gray code word and replaced by its rank, and the table is range-partitioned and sorted
by rank. Words that share the chosen bits are one contiguous run (a bucket) of that order, and
neighbours in it share further bits. Over each run a tree is built: a node keeps the bits that all
its members share (mask and pattern); a child counts only the bits its parent has not counted. A
query walks down the levels, adds up differing bits, and drops a whole group as soon as the sum
passes `max_bits`. Only members of groups that remain are compared.

A range partition can cut a bucket anywhere, so no bucket has to fit in a task: buckets that touch
the edge of a partition, and pieces of buckets above `block_rows`, are written as blocks with mask
and pattern, and pairs of blocks of one bucket meet by an equi-join after the same test on their
patterns.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ulasan.llm.common import sheltered, two_columns
from ulasan.session import stored

FANOUT = 16
U64 = np.uint64
SIGN = U64(1 << 63)


# --- fingerprints -------------------------------------------------------------


def shingle_hashes(text: str | None, shingle: int, step: int = 1 << 16) -> Iterator[np.ndarray]:
    """XXH64 of the word shingles in order, at most `step` at a time; a text without words has none."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return
    joined = memoryview(b" ".join(found))
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(found) - shingle + 1)
    starts, ends = starts[:n], ends[min(shingle, len(found)) - 1 :][:n]
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, step):
        spans = zip(starts[at : at + step].tolist(), ends[at : at + step].tolist())
        yield np.fromiter([digest(joined[a:b], 42) for a, b in spans], U64, min(step, n - at))


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash over all word shingles, repeats included; no word gives zero."""
    n, set_bits = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes(text, shingle):
        n += len(hashes)
        octets = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n).view(">u8").astype(U64)[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4
) -> DataFrame:
    """`(doc_id, fp)` per row, `fp` the 64 bits as a signed long. Null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter(
                (fingerprint(t.as_py(), shingle) for t in batch.column(1)), U64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values.view(np.int64))], ["doc_id", "fp"]
            )

    rows = two_columns(docs, id_col, text_col)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- Gray order ---------------------------------------------------------------


def layout(max_bits: int, blocks: int) -> list[tuple[list[tuple[int, int]], int]]:
    """For each table the (shift, width) of the bit blocks, chosen ones first, and the chosen width."""
    widths = [64 // blocks + (i < 64 % blocks) for i in range(blocks)]
    shifts = [64 - sum(widths[: i + 1]) for i in range(blocks)]
    tables = []
    for chosen in itertools.combinations(range(blocks), blocks - max_bits):
        order = [*chosen, *(i for i in range(blocks) if i not in chosen)]
        tables.append(([(shifts[i], widths[i]) for i in order], sum(widths[i] for i in chosen)))
    return tables


def blocks_for(n: int, max_bits: int, per_bucket: int = 64) -> int:
    """The fewest blocks whose chosen bits leave about `per_bucket` of n fingerprints in a bucket.

    Every choice finds the same pairs; more blocks mean more tables with smaller buckets.
    """
    blocks = max_bits + 1
    while blocks < max_bits + 4 and n > per_bucket << (64 * (blocks - max_bits) // blocks):
        blocks += 1
    return blocks


def permuted(fps: np.ndarray, parts: list[tuple[int, int]]) -> np.ndarray:
    out, at = np.zeros_like(fps), 64
    for shift, width in parts:
        at -= width
        out |= ((fps >> U64(shift)) & U64((1 << width) - 1)) << U64(at)
    return out


def gray_rank(words: np.ndarray) -> np.ndarray:
    """The place of each word in the reflected Gray code; its first bits depend on first bits only."""
    out = words.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> U64(shift)
    return out


def gray_word(ranks: np.ndarray) -> np.ndarray:
    return ranks ^ (ranks >> U64(1))


# --- the tree -----------------------------------------------------------------


class GrayTree:
    """Words in Gray order under nodes of shared bits. `buckets` (ascending) must be equal under one root."""

    def __init__(self, words: np.ndarray, buckets: np.ndarray):
        self.words = words
        starts = np.arange(len(words))
        group, self.levels = buckets, []
        all_and, all_or = words, words
        last = starts
        while True:
            # The place of each child within its bucket decides under which node it comes.
            new = np.r_[True, group[1:] != group[:-1]] if len(group) else np.zeros(0, bool)
            first = np.flatnonzero(new)
            place = np.arange(len(group)) - np.repeat(first, np.diff(np.r_[first, len(group)]))
            heads = np.flatnonzero(place % FANOUT == 0)
            if not len(heads):
                break
            all_and = np.bitwise_and.reduceat(all_and, heads)
            all_or = np.bitwise_or.reduceat(all_or, heads)
            ends = np.r_[heads[1:], len(group)]
            last = last[ends - 1]
            group = group[heads]
            self.levels.append(
                {"child": heads, "end": ends, "last": last, "mask": ~(all_and ^ all_or), "word": all_and}
            )
            if len(np.unique(group)) == len(group):
                break
        for lower, upper in zip(self.levels, self.levels[1:]):
            above = np.repeat(upper["mask"], upper["end"] - upper["child"])
            lower["rest"] = lower["mask"] & ~above
        if self.levels:
            self.levels[-1]["rest"] = self.levels[-1]["mask"]
        self.roots = group

    def pairs(self, queries: np.ndarray, roots: np.ndarray, max_bits: int, after: np.ndarray | None):
        """Yields (query index, member index) within `max_bits`; `after` keeps members beyond it only."""
        widest = max((x["last"][0] + 1 for x in self.levels[-1:]), default=1)
        if self.levels:
            widest = int(np.max(np.diff(np.r_[-1, self.levels[-1]["last"]])))
        step = max(1, min(1 << 14, (1 << 22) // max(1, widest)))
        for at in range(0, len(queries), step):
            q = np.arange(at, min(at + step, len(queries)))
            node, sums = roots[q], np.zeros(len(q), np.int64)
            for depth in range(len(self.levels) - 1, -1, -1):
                level = self.levels[depth]
                differing = np.bitwise_count((queries[q] ^ level["word"][node]) & level["rest"][node])
                sums = sums + differing
                keep = sums <= max_bits
                if after is not None:
                    keep &= level["last"][node] > after[q]
                q, node, sums = q[keep], node[keep], sums[keep]
                n = level["end"][node] - level["child"][node]
                offsets = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                node = np.repeat(level["child"][node], n) + offsets
                q, sums = np.repeat(q, n), np.repeat(sums, n)
            keep = np.bitwise_count(queries[q] ^ self.words[node]) <= max_bits
            if after is not None:
                keep &= node > after[q]
            if keep.any():
                yield q[keep], node[keep]


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each index reaches, after adding the links a-b."""
    while True:
        low = np.minimum(labels[a], labels[b])
        new = labels.copy()
        np.minimum.at(new, labels[a], low)
        np.minimum.at(new, labels[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, labels):
            return labels
        labels = new


def linked(words: np.ndarray, buckets: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what the words of each bucket join: every word to the first it reaches."""
    tree, n = GrayTree(words, buckets), len(words)
    labels = np.arange(n)
    if n:
        roots = np.searchsorted(tree.roots, buckets)
        for a, b in tree.pairs(words, roots, max_bits, np.arange(n)):
            labels = merge_labels(labels, a, b)
    off = np.flatnonzero(labels != np.arange(n))
    return off, labels[off]


def linked_across(left: np.ndarray, right: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two sorted blocks of one bucket, reduced in the same way (right after left)."""
    tree = GrayTree(right, np.zeros(len(right), np.int64))
    labels = np.arange(len(left) + len(right))
    for a, b in tree.pairs(left, np.zeros(len(left), np.int64), max_bits, None):
        labels = merge_labels(labels, a, b + len(left))
    off = np.flatnonzero(labels != np.arange(len(labels)))
    return off, labels[off]


# --- over Spark ---------------------------------------------------------------

FOUND = pa.schema(
    [
        ("a", pa.int64()),
        ("b", pa.int64()),
        ("tab", pa.int32()),
        ("bucket", pa.int64()),
        ("block", pa.int64()),
        ("mask", pa.int64()),
        ("word", pa.int64()),
        ("ranks", pa.binary()),
        ("ids", pa.binary()),
    ]
)
FOUND_SQL = (
    "a long, b long, tab int, bucket long, block long, mask long, word long, ranks binary, ids binary"
)


def _edge_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    n = len(a)
    nulls = [pa.nulls(n, f.type) for f in list(FOUND)[2:]]
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *nulls], schema=FOUND)


def _block_batch(tab: int, bucket: int, ranks: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    words = gray_word(ranks)
    all_and, all_or = np.bitwise_and.reduce(words), np.bitwise_or.reduce(words)
    signed = lambda x: int(np.array([x], U64).view(np.int64)[0])
    row = [
        None, None, tab, bucket, signed(ranks[0] ^ SIGN), signed(~(all_and ^ all_or)),
        signed(all_and), ranks.tobytes(), ids.tobytes(),
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array([v], f.type) for v, f in zip(row, FOUND)], schema=FOUND
    )


def near_links(
    fps: DataFrame, max_bits: int = 4, blocks: int | None = None, block_rows: int = 16_384
) -> DataFrame:
    """Links `(a, b)` between ids of `fps (id long, fp long)` whose connected parts are exactly those
    of all pairs within `max_bits` bits. Both columns must be unique and not null; the frame is read
    more than once, so hand over a stored one. With a further column `kind` (int from 0) only
    fingerprints of the same kind meet, and both columns are unique within a kind.
    """
    if blocks is None:
        blocks = blocks_for(fps.count(), max_bits)
    tables = layout(max_bits, blocks)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).to_numpy(zero_copy_only=False).view(U64)
            first = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int32) * len(tables)
            for t, (parts, _) in enumerate(tables):
                ranks = gray_rank(permuted(values, parts)) ^ SIGN
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first + np.int32(t)), pa.array(ranks.view(np.int64)), batch.column(0)],
                    ["tab", "rank", "id"],
                )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True

        def settle(tabs, ranks, ids, edge_before, edge_after):
            """Link inside buckets; write out those at an edge and the pieces of large ones."""
            width = np.array([w for _, w in tables], np.int64)[tabs % len(tables)]
            keys = (ranks >> (64 - width).astype(U64)).astype(np.int64)
            new = np.r_[True, (keys[1:] != keys[:-1]) | (tabs[1:] != tabs[:-1])]
            starts = np.flatnonzero(new)
            sizes = np.diff(np.r_[starts, len(ranks)])
            number = np.repeat(np.arange(len(starts)), sizes)
            place = np.arange(len(ranks)) - np.repeat(starts, sizes)
            piece = place // block_rows
            cut = np.r_[True, (number[1:] != number[:-1]) | (piece[1:] != piece[:-1])]
            a, b = linked(gray_word(ranks), np.cumsum(cut) - 1, max_bits)
            if len(a):
                yield _edge_batch(ids[a], ids[b])
            out = set(np.flatnonzero(sizes > block_rows).tolist())
            out |= {0} if edge_before else set()
            out |= {len(starts) - 1} if edge_after else set()
            for k in sorted(out):
                for at in range(starts[k], starts[k] + sizes[k], block_rows):
                    to = min(at + block_rows, starts[k] + sizes[k])
                    yield _block_batch(int(tabs[at]), int(keys[at]), ranks[at:to], ids[at:to])

        held = [np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.int64)]
        for batch in batches:
            tabs = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ranks = batch.column(1).to_numpy(zero_copy_only=False).view(U64) ^ SIGN
            ids = batch.column(2).to_numpy(zero_copy_only=False)
            held = [np.r_[x, y] for x, y in zip(held, (tabs, ranks, ids))]
            if len(held[0]) < 8 * block_rows:
                continue
            # Settle up to the start of the last bucket, which may go on in the next batch.
            width = U64(64 - tables[int(held[0][-1]) % len(tables)][1])
            same = (held[0] == held[0][-1]) & ((held[1] >> width) == (held[1][-1] >> width))
            stop = int(np.argmax(same))
            if stop == 0:  # one bucket fills all that is held: its full blocks go out
                stop = len(held[0]) - len(held[0]) % block_rows
                yield from settle(*(x[:stop] for x in held), True, False)
            else:
                yield from settle(*(x[:stop] for x in held), first, False)
            cut_inside = stop and bool(same[stop - 1])
            held, first = [x[stop:] for x in held], cut_inside
        if len(held[0]):
            yield from settle(*held, first, True)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                left, right = (np.frombuffer(row[k], U64) for k in ("ranks", "ranks2"))
                ids = np.r_[np.frombuffer(row["ids"], np.int64), np.frombuffer(row["ids2"], np.int64)]
                a, b = linked_across(gray_word(left), gray_word(right), max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], ["a", "b"])

    kind = F.col("kind") if "kind" in fps.columns else F.lit(0).alias("kind")
    dealt = fps.select("id", "fp", kind).mapInArrow(deal, "tab int, rank long, id long")
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = stored(
        dealt.repartitionByRange(parts, "tab", "rank")
        .sortWithinPartitions("tab", "rank")
        .mapInArrow(search, FOUND_SQL),
        "simhash-found",
    )
    blocks_of = found.where("block IS NOT NULL").drop("a", "b")
    other = blocks_of.select(
        "tab", "bucket", *(F.col(c).alias(f"{c}2") for c in ("block", "mask", "word", "ranks", "ids"))
    )
    met = blocks_of.join(other, ["tab", "bucket"]).where(
        (F.col("block") < F.col("block2"))
        & (
            F.bit_count(
                F.col("word").bitwiseXOR(F.col("word2")).bitwiseAND(F.col("mask")).bitwiseAND(F.col("mask2"))
            )
            <= max_bits
        )
    )
    inside = found.where("block IS NULL").select("a", "b")
    return inside.unionByName(
        met.select("ranks", "ids", "ranks2", "ids2").mapInArrow(across, "a long, b long")
    )


def components(links: DataFrame) -> DataFrame:
    """`(node, root)` for every id of `links (a, b)`: root is the smallest id it reaches.

    Alternates two star contractions until the links stop changing: larger neighbours are hung on the
    smallest neighbour, then smaller ones. Each round is two aggregations that combine in the map
    tasks and two equi-joins, whose hot keys the adaptive planner splits, and is written to the shared
    folder. Roots themselves have no row.
    """
    def smallest(e: DataFrame, by: str, value: str) -> DataFrame:
        return e.groupBy(by).agg(F.min(value).alias("low"))

    def state(e: DataFrame):
        return tuple(
            e.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        )

    edges = stored(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
        .distinct(),
        "links",
    )
    before = None
    while (now := state(edges)) != before and now[0]:
        before = now
        both = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
        low = smallest(both, "node", "root").select("node", F.least("low", "node").alias("low"))
        large = (
            both.join(low, "node")
            .where("root > node")
            .select(F.col("root").alias("node"), F.col("low").alias("root"))
            .where("node <> root")
            .distinct()
        )
        large = stored(large, "links")
        low = smallest(large, "node", "root")
        pairs = large.join(low, "node").select("node", "root", "low")
        small = (
            pairs.select(F.explode(F.array(
                F.struct(F.col("root").alias("node"), F.col("low").alias("root")),
                F.struct(F.col("node"), F.col("low").alias("root")),
            )).alias("e"))
            .select("e.node", "e.root")
            .where("node <> root")
            .distinct()
        )
        edges = stored(small, "links")
    return edges


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    max_bits: int = 4,
    blocks: int | None = None,
) -> DataFrame:
    """`(doc_id, fp, component_id)` per row of `docs`.

    component_id is the smallest id reachable over fingerprints that differ in at most `max_bits`
    bits, the row's own included. Null and empty texts have fingerprint 0, linked like any other.
    Repeated rows and ties share a fingerprint and a component. A row with a null id gets a
    fingerprint, takes no part in links and has a null component. Ids must be whole numbers. An empty
    table gives an empty result; other columns are not read.
    """
    marked = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    # One node for each different fingerprint, so copies cost nothing further.
    distinct = stored(
        marked.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").cast("long").alias("id")),
        "simhash-distinct",
    )
    roots = components(near_links(distinct, max_bits, blocks))
    groups = distinct.join(roots, distinct["id"] == roots["node"], "left").select(
        F.col("fp").alias("_fp"), F.coalesce("root", "id").alias("_root")
    )
    joined = marked.join(groups, F.col("fp") == F.col("_fp"), "left")
    return joined.select(
        "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("_root")).alias("component_id")
    )


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row of `docs` (with `doc_id`, `text`) of each component of `near_duplicates`, columns as they are.

    The row with the smallest id stays, null ids last; of rows that share it, repeated ones included, the
    first in order of the table. Rows are told apart by a number of their own, which is written with them,
    so neither repeated rows nor rows without an id gather in one place. Null and empty texts are one
    component; extra columns of any name are kept; an empty table gives an empty one; texts of any
    length are read whole, in steps.
    """

    def keep(rows: DataFrame) -> DataFrame:
        rows = stored(rows.withColumn("row_number", F.monotonically_increasing_id()), "numbered")
        groups = near_duplicates(rows, id_col="row_number", **options).select(
            F.col("doc_id").alias("row_number"), F.col("component_id").alias("component")
        )
        place = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_number").alias("row_number"))
        first = groups.join(rows.select("row_number", "doc_id"), "row_number").groupBy("component").agg(
            F.min(place)["row_number"].alias("row_number")
        )
        return rows.join(first.select("row_number"), "row_number", "left_semi").drop("row_number")

    return sheltered(docs, ("doc_id", "text"), keep)
