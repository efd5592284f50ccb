"""Vector tables: building, exact top-k search, near duplicates and cluster centres."""

from __future__ import annotations

import math
import time
from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ulasan.functions.text import label_name
from ulasan.functions.vector import l2_normalize
from ulasan.operators import kernels
from ulasan.operators.sampling import random_sample
from ulasan.session import discard, scratch_path, small_batches, stored
from ulasan.settings import IndexParams

HITS = "query_id long, vec_id long, score double"
BLOCKS = "block long, n int, width int, ids binary, vecs binary"
BLOCK_BYTES = 8 << 20  # of vectors, in a packed block
BLOCK_ROWS = 16_384  # in a packed block, at most
FILE_BLOCKS = 4  # in a file of packed blocks, so that a split is not much larger
SIDE_BYTES = 64 << 20  # of the index, in packed blocks, that a task of a product holds
MOST_CELLS = 4096  # of a grid that is dealt out by a shuffle
PAIRS = "i long, j long, similarity double"
CROWDED = 1000  # rows of a bucket of the banded search that one task may pair
HOT = 10_000  # copies of a vector above which they are linked in several tasks
SALTS = 32
KNN = 10  # neighbours looked at by the k-nearest form of the near-duplicate search, by default


def _is_l2(params: IndexParams) -> bool:
    """Unknown index types fall back to the inner product."""
    return params.index_type == "l2"


# --- tables -----------------------------------------------------------------


def alignment(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: keys on both sides, and keys missing on either side."""
    a = left.select(key, F.lit(1).alias("_l"))
    b = right.select(key, F.lit(1).alias("_r"))
    return a.join(b, key, "full").agg(
        F.count_if(F.col("_l").isNotNull() & F.col("_r").isNotNull()).alias("n_both"),
        F.count_if(F.col("_r").isNull()).alias("n_left_only"),
        F.count_if(F.col("_l").isNull()).alias("n_right_only"),
    )


def align(table: DataFrame, vectors: DataFrame, key: str, check: bool = True) -> DataFrame:
    """Each table row with its vector; a row without partner on either side is an error."""
    if check:
        row = alignment(table, vectors, key).head()
        if row["n_left_only"] or row["n_right_only"]:
            raise ValueError(f"table and vectors do not match: {row.asDict()}")
    return table.join(vectors, key)


def build_index(
    vectors: DataFrame,
    metadata: DataFrame | None = None,
    params: IndexParams = IndexParams(),
    key: str = "vec_id",
    col: str = "embedding",
    check: bool = True,
) -> DataFrame:
    """The vector table `(vec_id, unit_vec, metadata…)`. Rejects empty and mismatching input."""
    if check:
        shape = vectors.agg(F.count("*"), F.min(F.size(col)), F.max(F.size(col))).head()
        if shape[0] == 0:
            raise ValueError("no vectors")
        if shape[1] != shape[2]:
            raise ValueError("vectors differ in length")
    v = l2_normalize(F.col(col)) if params.normalize else F.col(col)
    rest = [c for c in vectors.columns if c not in (key, col)]
    index = vectors.select(
        F.col(key).cast("long").alias("vec_id"), v.cast("array<float>").alias("unit_vec"), *rest
    )
    if metadata is None:
        return index
    return align(index, metadata.withColumnRenamed(key, "vec_id"), "vec_id", check)


def index_statistics(index: DataFrame, params: IndexParams = IndexParams(), label: str = "sentimen") -> DataFrame:
    """One row per label value, with the size, dimension, type and float32 bytes of the table."""
    counts = index.groupBy(F.col(label).alias("label")).agg(
        F.count("*").alias("n"), F.max(F.size("unit_vec")).alias("_d")
    )
    everything = Window.partitionBy(F.lit(1))
    total, dim = F.sum("n").over(everything), F.max("_d").over(everything)
    return counts.select(
        "label",
        "n",
        total.alias("total_vectors"),
        dim.cast("int").alias("dimension"),
        F.lit("l2" if _is_l2(params) else "inner_product").alias("index_type"),
        (total * dim * 4).alias("approx_bytes"),
    )


# --- sizes --------------------------------------------------------------------


def _held(width: int | None, params: IndexParams) -> int:
    """Rows of a side that one task may hold: `max_query_rows`, or `max_broadcast_bytes` of doubles."""
    return max(1, min(params.max_query_rows, params.max_broadcast_bytes // (8 * max(1, width or 0))))


def _shape(rows: DataFrame, vec: str) -> tuple[int, int | None]:
    n, width = rows.agg(F.count(vec), F.max(F.size(vec))).first()
    return n, width


# --- top-k search -----------------------------------------------------------


def _hits_of(top: kernels.TopK, ids: np.ndarray) -> pa.RecordBatch:
    pos, vec_id, score = top.rows()
    columns = [pa.array(ids[pos], pa.int64()), pa.array(vec_id, pa.int64()), pa.array(score, pa.float64())]
    return pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])


def _kind(rows: DataFrame, vec: str) -> str:
    return "<f4" if rows.schema[vec].dataType.elementType.typeName() == "float" else "<f8"


def _packed(rows: DataFrame, key: str, vec: str, copies: int | None = None, most: int = BLOCK_ROWS) -> DataFrame:
    """Rows `(key, vec)` without nulls as blocks of bytes: `block, n, width, ids, vecs`, of `most` rows at most.
    Of a block's equal vectors only those of the `copies` lowest ids stay, where that is given."""
    kind = _kind(rows, vec)
    size = int(kind[2])

    def block(at: int, ids: np.ndarray, vecs: np.ndarray) -> pa.RecordBatch:
        row = (at, len(ids), vecs.shape[1], ids.astype("<i8").tobytes(), vecs.tobytes())
        types = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], ["block", "n", "width", "ids", "vecs"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, n = TaskContext.get().partitionId() << 32, [], 0

        def closed() -> pa.RecordBatch:
            ids, vecs = (np.concatenate(x) for x in zip(*held))
            if copies is not None:
                some = kernels.lowest_copies(ids, vecs, copies)
                ids, vecs = ids[some], vecs[some]
            return block(number, ids, vecs)

        for whole in batches:
            at = 0
            while at < whole.num_rows:
                width = len(whole.column(1)[at])
                full = max(1, min(most, BLOCK_BYTES // (size * max(1, width))))
                b = whole.slice(at, full - n)
                held.append((b.column(0).to_numpy(), kernels.matrix(b.column(1), False).astype(kind)))
                if held[0][1].shape[1] != held[-1][1].shape[1]:
                    raise ValueError("vectors of different lengths")
                at, n = at + b.num_rows, n + b.num_rows
                if n >= full:
                    yield closed()
                    number, held, n = number + 1, [], 0
        if n:
            yield closed()

    some = rows.select(key, vec).where(F.col(vec).isNotNull())
    return some.mapInArrow(pack, BLOCKS)


def _stored_blocks(blocks: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Blocks written once, a few to a file, and where they are."""
    path = scratch_path(blocks.sparkSession, name)
    with small_batches(blocks.sparkSession, 2 * BLOCK_BYTES):
        blocks.write.option("maxRecordsPerFile", FILE_BLOCKS).option("compression", "zstd").parquet(path)
    return blocks.sparkSession.read.schema(BLOCKS).parquet(path), path


def _dealt(blocks: DataFrame, parts: int) -> DataFrame:
    """Stored blocks in about `parts` partitions; they are shuffled only where a scan has far fewer splits."""
    n = blocks.rdd.getNumPartitions()
    return blocks.coalesce(parts) if n > parts else blocks.repartition(parts, "block") if 2 * n < parts else blocks


def _block(n: int, width: int, ids: pa.Scalar, vecs: pa.Scalar, kind: str, normalize: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids and double vectors of a packed block."""
    out = np.frombuffer(vecs.as_buffer(), kind).reshape(n, width).astype(np.float64)
    return np.frombuffer(ids.as_buffer(), "<i8"), kernels.unit(out) if normalize else out


def _search_in_place(
    index: DataFrame, asked: DataFrame, vec: str, kind: str, k: int, params: IndexParams
) -> DataFrame:
    """Hits of a query set that is known to be small: it is sent to the tasks that scan the index."""
    rows = asked.select("n", "width", "ids", "vecs").toArrow()  # at most `_held` rows
    found = [
        _block(n.as_py(), width.as_py(), ids, vecs, kind, params.normalize)
        for n, width, ids, vecs in zip(*(rows.column(i) for i in range(4)))
    ]
    held = tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64), np.zeros((0, 1)))
    shared, l2 = index.sparkSession.sparkContext.broadcast(held), _is_l2(params)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = shared.value
        top = kernels.TopK(q, k, l2)
        for b in batches:
            b = b.filter(b.column(1).is_valid())
            if b.num_rows and len(ids):
                top.add(b.column(0).to_numpy(), kernels.matrix(b.column(1), params.normalize))
        yield _hits_of(top, ids)

    return index.select("vec_id", vec).mapInArrow(scan, HITS)


SIDES = [f"{side}_{c}" for side in "qx" for c in ("block", "n", "width", "ids", "vecs")]


def _sides(asked: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return asked.toDF(*SIDES[:5]), rows.toDF(*SIDES[5:])


def _search_by_grid(asked: DataFrame, rows: DataFrame, kinds: tuple[str, str], k: int, params: IndexParams) -> DataFrame:
    """Hits where few blocks meet few: each two of them are dealt to a cell of their own by a shuffle."""
    l2 = _is_l2(params)
    every = [
        F.explode(F.array(*[F.lit(r[0]).cast("long") for r in x.select("block").collect()])) for x in (asked, rows)
    ]  # at most MOST_CELLS ids
    asked, rows = _sides(asked, rows)
    left = asked.select(F.col("q_block").alias("_a"), every[1].alias("_b"), *SIDES[1:5])
    right = rows.select(every[0].alias("_a"), F.col("x_block").alias("_b"), *SIDES[6:])

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        (ids, q), (found, vecs) = (
            _block(*(t.column(f"{s}_{c}")[0].as_py() for c in ("n", "width")), *(t.column(f"{s}_{c}")[0] for c in ("ids", "vecs")), kind, params.normalize)
            for t, s, kind in ((a, "q", kinds[0]), (b, "x", kinds[1]))
        )
        top = kernels.TopK(q, k, l2)
        top.add(found, vecs)
        return pa.Table.from_batches([_hits_of(top, ids)])

    return left.groupBy("_a", "_b").cogroup(right.groupBy("_a", "_b")).applyInArrow(meet, HITS)


def _search_by_product(
    asked: DataFrame, rows: DataFrame, sizes: tuple[int, int], kinds: tuple[str, str], k: int, params: IndexParams
) -> DataFrame:
    """Hits of a query set of any size. Each task reads some blocks of the queries and some of the index from
    where they are stored, and each two of them meet there: neither side is shuffled or copied, whatever the
    number of blocks. One block of queries is held at a time; its best are given out once it has met all."""
    cores, l2 = rows.sparkSession.sparkContext.defaultParallelism, _is_l2(params)
    across = max(1, math.ceil(sizes[1] / SIDE_BYTES))
    down = max(math.ceil(sizes[0] / SIDE_BYTES), math.ceil(4 * cores / across))
    left, right = _sides(_dealt(asked, down), _dealt(rows, across))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, top, ids = None, None, None
        for b in batches:
            for i in range(b.num_rows):
                x = {c: b.column(c)[i] for c in SIDES}
                if x["q_block"].as_py() != at:
                    if top is not None:
                        yield _hits_of(top, ids)
                    at = x["q_block"].as_py()
                    ids, q = _block(x["q_n"].as_py(), x["q_width"].as_py(), x["q_ids"], x["q_vecs"], kinds[0], params.normalize)
                    ids, top = ids.copy(), kernels.TopK(q, k, l2)
                top.add(*_block(x["x_n"].as_py(), x["x_width"].as_py(), x["x_ids"], x["x_vecs"], kinds[1], params.normalize))
        if top is not None:
            yield _hits_of(top, ids)

    with small_batches(rows.sparkSession, BLOCK_BYTES):
        return stored(left.crossJoin(right.hint("shuffle_replicate_nl")).select(*SIDES).mapInArrow(meet, HITS), "hits")


def search(
    index: DataFrame,
    queries: DataFrame,
    k: int = 5,
    params: IndexParams = IndexParams(),
    vec: str = "unit_vec",
    qvec: str = "query_vec",
) -> DataFrame:
    """Exact top-k rows per query: `query_id, rank, vec_id, similarity` (or `distance` for L2).

    The queries are packed into blocks, stored once and counted. Up to `max_query_rows` of them (and
    `max_broadcast_bytes`) are sent to the tasks that scan the index. More of them meet the packed index
    block by block, past the driver: in a grid of cells dealt out by a shuffle while that copies no more
    than `max_broadcast_bytes`, else in a product that reads both sides where they are stored. Each task
    gives its own k best, of which the best are ranked. Ties go to the lower `vec_id`; `k` is at least
    one, and a small index gives fewer rows. Rows without a vector take no part.
    """
    k, spark = max(1, k), index.sparkSession
    l2 = _is_l2(params)
    kinds = (_kind(queries, qvec), _kind(index, vec))
    asked, at = _stored_blocks(_packed(queries, "query_id", qvec), "queries")
    n, width, n_blocks = asked.agg(F.sum("n"), F.max("width"), F.count("*")).first()
    if (n or 0) <= _held(width, params):
        found = _search_in_place(index, asked, vec, kinds[0], k, params)
        discard(spark, at)
    else:
        rows, of_index = _stored_blocks(_packed(index, "vec_id", vec, copies=k), "vectors")
        n_rows, n_parts = rows.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        sizes = (n * width * int(kinds[0][2]), max(1, n_rows * width * int(kinds[1][2])))
        if n_blocks * n_parts <= MOST_CELLS and sizes[0] * n_parts + sizes[1] * n_blocks <= params.max_broadcast_bytes:
            found = _search_by_grid(asked, rows, kinds, k, params)
        else:
            found = _search_by_product(asked, rows, sizes, kinds, k, params)
            discard(spark, at)
            discard(spark, of_index)
    return _ranked(found.withColumnRenamed("score", "distance" if l2 else "similarity"), k)


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits of each query: `query_id, rank, vec_id` and the score."""
    score = "similarity" if "similarity" in hits.columns else "distance"
    nearest = F.round(score, kernels.TIE_DIGITS)
    order = Window.partitionBy("query_id").orderBy(nearest.desc() if score == "similarity" else nearest, "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", score)


def attach_metadata(hits: DataFrame, metadata: DataFrame) -> DataFrame:
    """Hits with their rows; hits without a row are dropped."""
    return hits.join(metadata, "vec_id")


def ranked_hits(hits: DataFrame, metadata: DataFrame) -> DataFrame:
    """Rank, score, text, clean text, label name and label of every hit."""
    score = "similarity" if "similarity" in hits.columns else "distance"
    joined = attach_metadata(hits, metadata)
    return joined.select(
        "query_id",
        "rank",
        "vec_id",
        score,
        F.coalesce("review", F.lit("")).alias("text"),
        F.coalesce("review_clean", F.lit("")).alias("clean_text"),
        label_name(F.col("sentimen")).alias("sentiment"),
        F.col("sentimen").alias("sentiment_label"),
    )


def capped_queries(queries: DataFrame, cap: int = 10, row_index: str = "row_index") -> DataFrame:
    """Only the first rows of a batch ask for neighbours."""
    return queries.filter(F.col(row_index) < cap)


# --- near duplicates --------------------------------------------------------


def _paired(left: pa.Table, right: pa.Table, same: bool, threshold: float) -> pa.Table:
    """Pairs above the threshold of two tables `(vec_id, unit_vec)`."""
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    if left.num_rows and right.num_rows:
        ids = [np.asarray(x.column("vec_id")) for x in (left, right)]
        vecs = [kernels.matrix(x.column("unit_vec"), True) for x in (left, right)]
        found += kernels.pairs_above(ids[0], vecs[0], ids[1], vecs[1], same, threshold)
    return pa.table([pa.array(np.concatenate(x)) for x in zip(*found)], ["i", "j", "similarity"])


def _pairs_by_product(items: DataFrame, threshold: float, params: IndexParams) -> DataFrame:
    """Every pair above the threshold: each packed block meets itself and each later block, all in one job.

    The tasks read the blocks where they are stored, nothing is shuffled, and pairs are given out as they are
    found: a task holds two blocks and a batch of pairs, however many there are.
    """
    n, width = _shape(items, "unit_vec")
    cores, kind = items.sparkSession.sparkContext.defaultParallelism, _kind(items, "unit_vec")
    down = max(math.ceil(math.sqrt(24 * cores)), math.ceil(2 * n * max(1, width or 0) * int(kind[2]) / SIDE_BYTES))
    most = max(1, min(_held(width, params), BLOCK_ROWS, max(2048, math.ceil(n / down))))
    blocks, _ = _stored_blocks(_packed(items, "vec_id", "unit_vec", most=most), "vectors")
    blocks = _dealt(blocks, max(1, min(down, math.ceil(n / most))))
    left, right = _sides(blocks, blocks)
    met = left.join(right.hint("shuffle_replicate_nl"), F.col("q_block") <= F.col("x_block")).select(*SIDES)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            for i in range(b.num_rows):
                x = {c: b.column(c)[i] for c in SIDES}
                same = x["q_block"].as_py() == x["x_block"].as_py()
                q = _block(x["q_n"].as_py(), x["q_width"].as_py(), x["q_ids"], x["q_vecs"], kind, True)
                v = q if same else _block(x["x_n"].as_py(), x["x_width"].as_py(), x["x_ids"], x["x_vecs"], kind, True)
                for found in kernels.pairs_above(*q, *v, same, threshold):
                    held.append(found)
                    rows += len(found[0])
                    if rows >= 1 << 16:
                        yield _pairs_of(held)
                        held, rows = [], 0
        if held:
            yield _pairs_of(held)

    return met.mapInArrow(meet, PAIRS)


def _pairs_of(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], ["i", "j", "similarity"])


def bands_for(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """Sign bits per band and number of bands for n vectors.

    A band has about as many buckets as there are vectors. A random plane separates two vectors at
    the threshold with chance angle / pi, which gives the bands needed for the recall there; pairs above
    it are found more often.
    """
    bits = min(60, max(4, math.ceil(math.log2(max(2, n)))))
    together = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log1p(-together)))


def _pairs_by_bands(
    items: DataFrame, threshold: float, recall: float, seed: int, full: int = CROWDED
) -> DataFrame:
    """Pairs that share a bucket of random planes in some band, tested by their exact cosine.

    Only keys and ids are copied to the bands; a vector is read by its own row and by its candidates,
    and by the cells of buckets of more than `full` rows.
    """
    items = stored(items, "items")
    n, dim = items.agg(F.count("*"), F.max(F.size("unit_vec"))).first()
    bits, bands = bands_for(n, threshold, recall)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng(seed).normal(size=(dim or 1, bands * bits))
        powers = np.int64(1) << np.arange(bits, dtype=np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                above = (kernels.matrix(b.column(1), False) @ planes > 0).reshape(b.num_rows, bands, bits)
                keys = (above * powers).sum(axis=2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(b.column(0).to_numpy(), bands)),
                        pa.array(np.tile(np.arange(bands, dtype=np.int32), b.num_rows)),
                        pa.array(keys.reshape(-1)),
                    ],
                    ["id", "band", "key"],
                )

    keys = stored(items.select("vec_id", "unit_vec").mapInArrow(sign, "id long, band int, key long"), "bands")
    sizes = keys.groupBy("band", "key").agg(F.count("*").alias("n"))
    crowded = stored(sizes.where(F.col("n") > full), "crowded")
    light = keys
    if not crowded.isEmpty():
        light = keys.join(crowded, ["band", "key"], "left_anti")
    a, b = light.withColumnRenamed("id", "i"), light.withColumnRenamed("id", "j")
    candidates = a.join(b, ["band", "key"]).where("i < j").select("i", "j").distinct()
    left = items.select(F.col("vec_id").alias("i"), F.col("unit_vec").alias("_a"))
    right = items.select(F.col("vec_id").alias("j"), F.col("unit_vec").alias("_b"))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (kernels.matrix(b.column(c), True) for c in (2, 3))
            value = np.einsum("ij,ij->i", x, y)
            keep = value > threshold
            ids = (b.column(c).to_numpy()[keep] for c in (0, 1))
            yield pa.RecordBatch.from_arrays([*map(pa.array, ids), pa.array(value[keep])], ["i", "j", "similarity"])

    found = candidates.join(left, "i").join(right, "j").select("i", "j", "_a", "_b").mapInArrow(test, PAIRS)
    if crowded.isEmpty():
        return found
    # A pair may share several buckets; its similarity can differ in the last digits by way of reckoning.
    more = _pairs_of_crowded(items, keys.join(crowded, ["band", "key"]), threshold, full)
    return found.unionByName(more).groupBy("i", "j").agg(F.max("similarity").alias("similarity"))


def _pairs_of_crowded(items: DataFrame, keys: DataFrame, threshold: float, full: int) -> DataFrame:
    """Pairs above the threshold in buckets of more than `full` rows.

    Further planes would part near vectors too, so a bucket is dealt into parts of about `full` rows and
    each two of them meet in a cell of their own: no pair of the bucket is lost, no task holds more than
    two parts, and only pairs that pass leave the cell.
    """
    parts = F.ceil(F.col("n") / F.lit(full)).cast("int")
    dealt = keys.select(
        "band", "key", "id", parts.alias("_n"), F.pmod(F.xxhash64("id"), parts.cast("long")).cast("int").alias("_p")
    ).join(items.select(F.col("vec_id").alias("id"), "unit_vec"), "id")
    later = F.explode(F.sequence(F.col("_p"), F.col("_n") - 1))
    earlier = F.explode(F.sequence(F.lit(0), F.col("_p")))
    cell = ("band", "key", "_a", "_b")
    row = (F.col("id").alias("vec_id"), F.col("unit_vec").alias("unit_vec"))
    bucket = (F.col("band").alias("band"), F.col("key").alias("key"))
    left = dealt.select(*bucket, F.col("_p").alias("_a"), later.alias("_b"), *row)
    right = dealt.select(*bucket, earlier.alias("_a"), F.col("_p").alias("_b"), *row)

    def meet(key: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        return _paired(a, b, key[2].as_py() == key[3].as_py(), threshold)

    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(meet, PAIRS)


def _nearest_of_groups(groups: DataFrame, threshold: float, k: int, params: IndexParams) -> DataFrame:
    """The k-nearest form over `(vec_id, unit_vec, ids)`: a vector, its lowest ids in order, and the first of them.

    Vectors are searched once for all their ids. Each of a vector's k nearest ids belongs to one of its k
    nearest vectors, as the first id of any nearer vector comes before it.
    """
    twice = groups.groupBy("vec_id").count().where("count > 1")
    if twice.isEmpty():
        asking = groups.select(F.col("vec_id").alias("query_id"), F.col("unit_vec").alias("query_vec"))
        hits = search(groups, asking, k, params).select("query_id", "vec_id", "similarity")
        ids = groups.select("vec_id", "ids")
        hits = hits.join(ids, "vec_id").select("query_id", F.explode("ids").alias("vec_id"), "similarity")
        hits = _ranked(hits, k).drop("rank")
        askers = ids.withColumnRenamed("vec_id", "query_id")
        hits = hits.join(askers, "query_id").select(F.explode("ids").alias("query_id"), "vec_id", "similarity")
        ranked = _ranked(hits, k)
    else:  # ids of several vectors don't tell these apart
        items = groups.select(F.explode("ids").alias("vec_id"), "unit_vec")
        asking = items.select(F.col("vec_id").alias("query_id"), F.col("unit_vec").alias("query_vec"))
        ranked = search(items, asking, k, params)
    found = ranked.where((F.col("rank") > 1) & (F.col("similarity") > threshold) & (F.col("query_id") < F.col("vec_id")))
    return found.select(F.col("query_id").alias("i"), F.col("vec_id").alias("j"), "similarity", F.lit("near").alias("kind"))


def near_duplicates(
    index: DataFrame,
    threshold: float = 0.95,
    mode: str = "pairs",
    params: IndexParams = IndexParams(),
    recall: float = 0.99,
    k: int = KNN,
    seed: int = 42,
    crowded: int = CROWDED,
) -> DataFrame:
    """Near-duplicate pairs `(i, j, similarity, kind)` with `i < j` and cosine above the threshold.

    `pairs`: exact copies are merged first. Every pair of distinct vectors above the threshold is
    returned once, between the lowest ids of both vectors (kind `near`), and each further copy is linked
    to the lowest id of its own vector with similarity 1 (kind `copy`). A group of m copies thus gives
    m - 1 rows, from which all its pairs follow, and no task meets the whole group. The work is
    quadratic, over blocks of bounded size that meet two by two; only pairs that a bound on part of
    the dimensions leaves open are finished.

    `banded`: the same rows, with pairs of distinct vectors looked for in bands of random planes. Each
    pair at the threshold is found with chance `recall`, closer ones more surely; what is returned is
    exact. Buckets of more than `crowded` rows are dealt over many tasks. This is the form for large tables.

    `knn10`: the `k` (ten) nearest of each row by similarity then id, the first dropped as the row
    itself. Of one group of copies only the k lowest ids can be among anyone's k nearest, and a
    later copy has no partner above its own id, so the rest is left out before the search, and equal
    vectors are searched once.
    """
    if _is_l2(params):
        raise ValueError("near duplicates need an inner-product index")
    if not 0 <= threshold < 1:
        raise ValueError("threshold must be in [0, 1)")
    base = index.select("vec_id", "unit_vec").filter(F.col("unit_vec").isNotNull())

    if mode == "knn10":
        copies = Window.partitionBy("unit_vec").orderBy("vec_id")
        items = base.withColumn("_copy", F.row_number().over(copies)).filter(F.col("_copy") <= k)
        groups = items.groupBy("unit_vec").agg(F.sort_array(F.collect_list(F.struct("vec_id"))).alias("ids"))
        # Groups go by a number of their own: the lowest id may stand for several vectors.
        groups = groups.select(F.col("ids")[0]["vec_id"].alias("vec_id"), "unit_vec", F.col("ids.vec_id").alias("ids"))
        return _nearest_of_groups(stored(groups, "groups"), threshold, k, replace(params, normalize=True))
    if mode not in ("pairs", "banded"):
        raise ValueError(f"unknown mode: {mode}")

    groups = stored(
        base.groupBy("unit_vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")), "groups"
    )
    items = groups.select(F.col("rep").alias("vec_id"), "unit_vec")
    if mode == "pairs":
        near = _pairs_by_product(items, threshold, params)
    else:
        near = _pairs_by_bands(items, threshold, recall, seed, crowded)
    # Rows of a hot vector are spread over several join keys; the few hot ones are sent to all tasks by a hash.
    mark = F.xxhash64("unit_vec")
    hot = F.broadcast(groups.filter(F.col("n") > HOT).select(mark.alias("_mark")).distinct().withColumn("_hot", F.lit(True)))
    marked = groups.filter(F.col("n") > 1).withColumn("_mark", mark).join(hot, "_mark", "left")
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copied = marked.select("unit_vec", "rep", F.explode(every).alias("salt"))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int")).otherwise(0)
    salted = base.withColumn("_mark", mark).join(hot, "_mark", "left").select("vec_id", "unit_vec", salt.alias("salt"))
    nonzero = F.exists("unit_vec", lambda x: x != 0)
    links = (
        salted.join(copied, ["unit_vec", "salt"])
        .filter((F.col("vec_id") > F.col("rep")) & nonzero)
        .select(F.col("rep").alias("i"), F.col("vec_id").alias("j"), F.lit(1.0).alias("similarity"))
    )
    return near.withColumn("kind", F.lit("near")).unionByName(links.withColumn("kind", F.lit("copy")))


# --- clusters, benchmark ----------------------------------------------------


def cluster_centers(
    index: DataFrame,
    n_clusters: int = 10,
    max_iter: int = 20,
    seed: int = 42,
    params: IndexParams | None = None,
) -> DataFrame:
    """k-means centres with the index row nearest to each, by the measure of the index's `params`.

    Without parameters that is the greatest inner product.
    """
    params = replace(params or IndexParams(), normalize=False)
    points = index.select(array_to_vector(F.col("unit_vec").cast("array<double>")).alias("features"))
    model = KMeans(k=n_clusters, maxIter=max_iter, seed=seed).fit(points)
    spark = index.sparkSession
    centers = spark.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())],
        "query_id long, query_vec array<double>",
    )
    hits = search(index, centers, k=1, params=params)
    rows = attach_metadata(hits, index.drop("unit_vec"))
    return rows.join(F.broadcast(centers), "query_id").select(
        F.col("query_id").cast("int").alias("cluster_id"),
        F.col("query_vec").cast("array<float>").alias("centroid"),
        F.col("vec_id").alias("closest_item_index"),
        *[c for c in ("review",) if c in index.columns],
        label_name(F.col("sentimen")).alias("sentiment"),
    )


def benchmark_search(index: DataFrame, n_queries: int = 100, k: int = 5, seed: int = 42) -> DataFrame:
    """Wall time of one search for `min(n_queries, rows)` sampled rows."""
    sample = random_sample(index.select("vec_id", "unit_vec"), n_queries, "vec_id", seed)
    queries = sample.select(
        F.col("vec_id").alias("query_id"), F.col("unit_vec").alias("query_vec")
    ).cache()
    n = queries.count()
    start = time.perf_counter()
    search(index, queries, k).write.format("noop").mode("overwrite").save()
    total = time.perf_counter() - start
    queries.unpersist()
    row = (n, k, total, total / max(n, 1), n / total)
    return index.sparkSession.createDataFrame(
        [row],
        "n_queries long, k int, total_time double, avg_time_per_query double, queries_per_second double",
    )


def pairwise_statistics(index: DataFrame, n: int = 1000, seed: int = 42, key: str = "vec_id") -> DataFrame:
    """Off-diagonal cosine mean, population deviation and range over a sample of at most `n` rows.

    The sample is a parameter-sized block; each task pairs its part with it and returns one row of
    partial sums, so no pair is ever a row.
    """
    block = random_sample(index.select(key, "unit_vec"), n, key, seed).select("unit_vec").toArrow()
    size, spark = block.num_rows, index.sparkSession
    shared = spark.sparkContext.broadcast(
        kernels.matrix(block.column(0), True) if size else np.zeros((0, 1))
    )
    step = 128

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = shared.value
            for lo in b.column(0).to_pylist():
                sims = v[lo : lo + step] @ v.T
                off = np.ones(sims.shape, bool)
                off[np.arange(len(sims)), np.arange(lo, lo + len(sims))] = False
                s = sims[off]
                if len(s):
                    cols = [[len(s)], [s.sum()], [(s * s).sum()], [s.min()], [s.max()]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in cols], ["c", "s", "q", "lo", "hi"]
                    )

    starts = spark.range(0, max(size, 1), step)
    parts = starts.mapInArrow(partial, "c long, s double, q double, lo double, hi double")
    mean = F.sum("s") / F.sum("c")
    return parts.agg(
        F.lit(size).cast("long").alias("sample_size"),
        F.coalesce(F.sum("c"), F.lit(0)).alias("n_pairs"),
        mean.alias("avg_similarity"),
        F.sqrt(F.greatest(F.sum("q") / F.sum("c") - mean * mean, F.lit(0.0))).alias("std_similarity"),
        F.min("lo").alias("min_similarity"),
        F.max("hi").alias("max_similarity"),
    )
