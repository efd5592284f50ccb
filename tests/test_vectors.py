import os
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from ulasan.functions import vector as vf
from ulasan.operators import kernels
from ulasan.operators import vectors as vx
from ulasan.session import checkpoint_root
from ulasan.settings import IndexParams

BLOCKS = IndexParams(max_query_rows=40)


def frame(spark, vecs, ids=None):
    ids = range(len(vecs)) if ids is None else ids
    rows = [(int(i), [float(x) for x in v], int(i) % 2) for i, v in zip(ids, vecs)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, sentimen int")


def clustered(n=400, d=8, seed=1, centers=12, noise=0.08):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centers, d))
    return (c[rng.integers(0, centers, n)] + rng.normal(size=(n, d)) * noise).astype(np.float32)


def unit(v):
    v = v.astype(np.float64)
    n = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(n > 0, n, 1)


def stored_unit(v):
    return unit(unit(v).astype(np.float32))


def test_vector_functions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [1.0, 0.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    a, b = F.col("a"), F.col("b")
    rows = df.select(
        vf.l2_norm(a), vf.l2_normalize(a), vf.cosine(a, b), vf.inner_product(a, b), vf.squared_l2(a, b), vf.row_std(a)
    ).collect()
    assert list(rows[0]) == [5.0, [0.6, 0.8], 0.6, 3.0, 20.0, 0.5]
    assert list(rows[1]) == [0.0, [0.0, 0.0], 0.0, 0.0, 2.0, 0.0]


@pytest.mark.parametrize("params", [IndexParams(), BLOCKS])
def test_search_matches_brute_force_with_ties(spark, params):
    v = clustered(150)
    v[100:130] = v[7]  # copies: ties go to the lower id
    index = vx.build_index(frame(spark, v))
    queries = index.select(F.col("vec_id").alias("query_id"), F.col("unit_vec").alias("query_vec"))
    got = {}
    for r in vx.search(index, queries, 5, params).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    u = stored_unit(v)
    sims = np.round(u @ u.T, 12)
    want = {i: [int(j) for j in np.lexsort((np.arange(150), -sims[i]))[:5]] for i in range(150)}
    assert got == want


@pytest.mark.parametrize("block", [False, True])
def test_search_l2_and_clamping(spark, block):
    v = clustered(40)
    raw = frame(spark, v).withColumnRenamed("embedding", "unit_vec")
    params = IndexParams(index_type="l2", normalize=False, max_query_rows=1 if block else 10)
    q = spark.createDataFrame([(9, [float(x) for x in v[3]])], "query_id long, query_vec array<float>")
    rows = vx.search(raw, q, 1000, params).orderBy("rank").collect()
    d = ((v.astype(float) - v[3].astype(float)) ** 2).sum(1)
    assert [r["vec_id"] for r in rows] == [int(i) for i in np.argsort(d, kind="stable")]
    assert np.allclose([r["distance"] for r in rows], np.sort(d), atol=1e-9) and rows[0]["distance"] == 0
    assert vx.search(raw, q, 0, params).count() == 1


def pairs_by_hand(v, t):
    """Representatives of equal stored vectors, their pairs, and one link per further copy."""
    stored = unit(v).astype(np.float32)
    reps, links = {}, set()
    for i, row in enumerate(stored):
        key = row.tobytes()
        if key in reps:
            links.add((reps[key], i))
        else:
            reps[key] = i
    ids = sorted(reps.values())
    u = unit(stored)
    sims = u @ u.T
    return links | {(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if sims[a, b] > t}


@pytest.mark.parametrize("rows,t", [(4096, 0.95), (60, 0.95), (60, 0.6), (60, 0.0), (90, 0.99)])
def test_near_duplicates_are_complete(spark, rows, t):
    v = clustered(300)
    v[200:260] = v[5]  # a hot group of copies
    got = vx.near_duplicates(vx.build_index(frame(spark, v)), t, params=IndexParams(max_query_rows=rows))
    rows = [(r["i"], r["j"]) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == pairs_by_hand(v, t)
    assert got.where("kind = 'copy'").count() >= 59


@pytest.mark.parametrize("d", [64, 768])
def test_banded_pairs_are_exact_and_nearly_complete(spark, d):
    v = clustered(400, d, centers=40, noise=0.02)
    v[200:230] = v[5]
    index = vx.build_index(frame(spark, v))
    got = {(r["i"], r["j"]) for r in vx.near_duplicates(index, 0.95, mode="banded").collect()}
    want = pairs_by_hand(v, 0.95)
    assert got <= want and len(got) >= 0.98 * len(want)


def test_bands_hold_keys_and_not_vectors():
    bits, bands = vx.bands_for(10**9, 0.95, 0.99)
    assert bits == 30 and bands < 128  # keys of 20 bytes, not vectors


@pytest.mark.parametrize("rows", [20, 7])
def test_large_query_sets_are_one_job_past_the_driver(spark, rows):
    """However many parts there are, a search is one plan whose cells are met in one job."""
    index = vx.build_index(frame(spark, clustered(200, 64, centers=40)))
    asked = index.select(F.col("vec_id").alias("query_id"), F.col("unit_vec").alias("query_vec"))
    hits = vx.search(index, asked, 3, IndexParams(max_query_rows=rows))
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "CoGroupsInArrow" in plan and hits.count() == 600


def test_crowded_buckets_are_dealt_over_cells_and_lose_no_pair(spark):
    """Distinct near vectors that share all their planes: the same pairs, whatever a bucket may hold."""
    rng = np.random.default_rng(4)
    v = np.concatenate([clustered(100, 16), 1 + rng.normal(size=(300, 16)) * 1e-3]).astype(np.float32)
    index = vx.build_index(frame(spark, v))
    found = [
        {(r["i"], r["j"]) for r in vx.near_duplicates(index, 0.95, mode="banded", crowded=n).collect()} for n in (10_000, 30)
    ]
    assert found[1] == found[0] and len(found[0]) >= 300 * 299 // 2


@pytest.mark.parametrize("t", [0.0, 0.5, 0.9, 0.999])
@pytest.mark.parametrize("d", [1, 3, 64])
def test_the_bound_on_part_of_the_dimensions_loses_no_pair(t, d):
    rng = np.random.default_rng(d)
    u = unit(rng.normal(size=(400, d)) * np.linspace(0.1, 3, d))
    u[200:210] = u[:10]
    ids = rng.permutation(400).astype(np.int64)
    sims = u @ u.T
    for same, lo in ((True, 0), (False, 150)):
        a, b = (slice(None), slice(None)) if same else (slice(0, lo), slice(lo, None))
        got = [set(zip(i.tolist(), j.tolist())) for i, j, _ in kernels.pairs_above(ids[a], u[a], ids[b], u[b], same, t, step=64)]
        want = {
            (min(ids[x], ids[y]), max(ids[x], ids[y]))
            for x in range(400)
            for y in range(400)
            if sims[x, y] > t and (x < y if same else x < lo <= y)
        }
        close = {(min(ids[x], ids[y]), max(ids[x], ids[y])) for x, y in zip(*np.nonzero(abs(sims - t) < 1e-12))}
        assert set().union(*got) - close == want - close and sum(map(len, got)) == len(set().union(*got))


def test_queries_are_encoded_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    index = vx.build_index(frame(spark, clustered(60)))
    asked = index.select(F.col("vec_id").alias("query_id"), F.col("unit_vec").alias("query_vec"))
    asked = asked.mapInArrow(count, "query_id long, query_vec array<float>")
    assert vx.search(index, asked, 3, BLOCKS).count() == 180 and seen.value == 60


@pytest.mark.parametrize("rows", [4096, 60])
def test_knn10_matches_the_definition(spark, rows):
    v = clustered(250)
    v[150:200] = v[3]
    got = vx.near_duplicates(
        vx.build_index(frame(spark, v)), 0.9, mode="knn10", params=IndexParams(max_query_rows=rows)
    )
    u = stored_unit(v)
    sims = u @ u.T
    want = set()
    for i in range(250):
        best = np.lexsort((np.arange(250), -np.round(sims[i], 12)))[:10]
        want |= {(i, int(j)) for j in best[1:] if sims[i, j] > 0.9 and i < j}
    assert {(r["i"], r["j"]) for r in got.collect()} == want


def test_rejections(spark):
    v = frame(spark, clustered(10))
    with pytest.raises(ValueError):
        vx.build_index(v.limit(0))
    with pytest.raises(ValueError):
        vx.build_index(v, metadata=v.select("vec_id").limit(3))
    with pytest.raises(ValueError):
        vx.build_index(v.unionByName(frame(spark, [[1.0]], [99])))
    with pytest.raises(ValueError):
        vx.near_duplicates(vx.build_index(v), params=IndexParams(index_type="l2"))


def test_metadata_and_names(spark):
    v = frame(spark, clustered(30))
    meta = v.select("vec_id", F.concat(F.lit("text "), "vec_id").alias("review"), F.lit("c").alias("review_clean"))
    index = vx.build_index(v, meta)
    q = index.filter("vec_id = 4").select(F.col("vec_id").alias("query_id"), F.col("unit_vec").alias("query_vec"))
    top = vx.ranked_hits(vx.search(index, q, 2), index.drop("unit_vec")).orderBy("rank").head()
    assert (top["vec_id"], top["text"], top["sentiment"], top["rank"]) == (4, "text 4", "Negative", 1)
    assert top["similarity"] == pytest.approx(1.0)


def test_pairwise_statistics(spark):
    v = clustered(300)
    row = vx.pairwise_statistics(vx.build_index(frame(spark, v)), 1000).head()
    u = stored_unit(v)
    off = (u @ u.T)[~np.eye(300, dtype=bool)]
    assert np.allclose(list(row)[2:], [off.mean(), off.std(), off.min(), off.max()], atol=1e-9)
    assert (row["sample_size"], row["n_pairs"]) == (300, 300 * 299)


def test_cluster_centers_and_benchmark(spark):
    index = vx.build_index(frame(spark, clustered(200, noise=0.01, centers=4)))
    rows = vx.cluster_centers(index, 4).collect()
    assert sorted(r["cluster_id"] for r in rows) == [0, 1, 2, 3]
    assert len({r["closest_item_index"] for r in rows}) == 4
    assert vx.benchmark_search(index, 1000, 3).head()["n_queries"] == 200


@pytest.mark.parametrize("params", [IndexParams(), BLOCKS])
def test_rows_without_a_vector_take_no_part(spark, params):
    v = clustered(20)
    index = vx.build_index(frame(spark, v)).select("vec_id", "unit_vec")
    index = index.unionByName(spark.createDataFrame([(99, None)], "vec_id long, unit_vec array<float>"))
    queries = index.select(F.col("vec_id").alias("query_id"), F.col("unit_vec").alias("query_vec"))
    rows = vx.search(index, queries, 30, params).collect()
    assert len(rows) == 400 and 99 not in {r["vec_id"] for r in rows} | {r["query_id"] for r in rows}


def nearest_by_hand(u, k):
    sims = np.round(u @ u.T, 12)
    return {(i, n + 1, int(j)) for i in range(len(u)) for n, j in enumerate(np.lexsort((np.arange(len(u)), -sims[i]))[:k])}


def test_many_queries_meet_the_index_without_copies_of_either(spark, monkeypatch):
    """Blocks are met where they are stored: neither side is dealt to cells once for each part of the other."""
    monkeypatch.setattr(vx, "BLOCK_ROWS", 9)
    v = clustered(150, 16)
    v[100:130], v[140] = v[7], 0
    index = vx.build_index(frame(spark, v))
    asked = index.select(F.col("vec_id").alias("query_id"), F.col("unit_vec").alias("query_vec"))
    hits = vx.search(index, asked, 5, IndexParams(max_query_rows=4, max_broadcast_bytes=1000))
    assert "CoGroups" not in hits._jdf.queryExecution().executedPlan().toString()
    assert {(r["query_id"], r["rank"], r["vec_id"]) for r in hits.collect()} == nearest_by_hand(stored_unit(v), 5)


def test_packed_blocks_are_deleted_when_they_have_been_met(spark):
    index = vx.build_index(frame(spark, clustered(60)))
    asked = index.select(F.col("vec_id").alias("query_id"), F.col("unit_vec").alias("query_vec"))
    for params in (IndexParams(), IndexParams(max_query_rows=4, max_broadcast_bytes=1000)):
        before = set(os.listdir(checkpoint_root(spark)))
        assert vx.search(index, asked, 3, params).count() == 180
        left = {x.split("-")[0] for x in set(os.listdir(checkpoint_root(spark))) - before}
        assert left <= {"hits"}


def test_pairs_hold_a_tile_of_products_however_long_a_side_is():
    rng = np.random.default_rng(2)
    a, b = unit(rng.normal(size=(600, 8))), unit(rng.normal(size=(60_000, 8)))
    tracemalloc.start()
    found = sum(len(x[0]) for x in kernels.pairs_above(np.arange(600), a, np.arange(1000, 61_000), b, False, 0.999))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == np.count_nonzero(a @ b.T > 0.999) and peak < 100e6


def test_pairs_close_to_the_threshold_are_decided_in_double_precision():
    t = 0.9
    turned = [np.array([t + e, np.sqrt(1 - (t + e) ** 2), 0, 0]) for e in (-1e-9, 1e-9)]
    right = unit(np.array(turned))
    got = [x for i, j, _ in kernels.pairs_above(np.array([0]), np.eye(4)[:1], np.array([5, 6]), right, False, t) for x in j]
    assert got == [6]


def test_candidates_of_the_bands_are_tested_in_blocks(spark):
    """Not element by element in expressions of the plan."""
    plan = vx.near_duplicates(vx.build_index(frame(spark, clustered(200))), 0.95, mode="banded")
    assert "zip_with" not in plan._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("twice", [False, True])
def test_knn10_searches_equal_vectors_once(spark, monkeypatch, twice):
    v = clustered(120, 6)
    v[60:] = v[:60]  # a copy of each
    rows = frame(spark, v)
    if twice:  # one id for two vectors, and a row that comes twice
        rows = rows.unionByName(frame(spark, [v[5], v[3]], [0, 3]))
    index, seen, search = vx.build_index(rows), [], vx.search
    monkeypatch.setattr(vx, "search", lambda x, q, *a, **b: (seen.append(x.count()), search(x, q, *a, **b))[1])
    got = vx.near_duplicates(index, 0.9, mode="knn10")
    assert twice or seen == [60]
    monkeypatch.undo()
    asked = index.select(F.col("vec_id").alias("query_id"), F.col("unit_vec").alias("query_vec"))
    want = vx.search(index, asked, 10).where("rank > 1 and similarity > 0.9 and query_id < vec_id")
    assert sorted((r["i"], r["j"]) for r in got.collect()) == sorted((r["query_id"], r["vec_id"]) for r in want.collect())


def test_copies_of_a_hot_vector_are_linked_in_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(vx, "HOT", 20)
    v = clustered(200)
    v[50:110], v[150:155] = v[5], v[3]
    got = vx.near_duplicates(vx.build_index(frame(spark, v)), 0.95).collect()
    assert {(r["i"], r["j"]) for r in got} == pairs_by_hand(v, 0.95) and len(got) == len(pairs_by_hand(v, 0.95))
