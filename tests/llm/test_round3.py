"""Phrases, centroid clustering and BPE against brute force, on small fixtures with awkward rows."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ulasan.llm import bpe, phrases, ptolemy
from ulasan.llm.queries import tokenizer_path

# Columns with the names that operators use inside.
EXTRA = ["v", "x", "to_pivots", "cluster", "w1", "a", "shard", "n", "ids", "decoded", "part", "score", "rank"]


def table(spark, rows, schema):
    """Rows of (key, value ...) with extra columns of clashing names."""
    fields = [*schema, *(T.StructField(c, T.StringType()) for c in EXTRA)]
    return spark.createDataFrame([(*r, *["z"] * len(EXTRA)) for r in rows], T.StructType(fields))


# --- phrases -------------------------------------------------------------------


def brute_phrases(rows, least, top, longest=4, share=80):
    lower = {i: i + 32 for i in range(65, 91)}
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        dropped = {
            p[i : i + k]
            for p, a in found.items()
            for k in range(2, len(p))
            for i in range(len(p) - k + 1)
            if 100 * a >= share * c[p[i : i + k]]
        }
        ranked = []
        for p, a in found.items():
            if p in dropped:
                continue
            s, _, l, r = min((2_000_000 * a // (c[p[:j]] + c[p[j:]]), j, c[p[:j]], c[p[j:]]) for j in range(1, len(p)))
            ranked.append((-s, -a, " ".join(p).encode(), l, r))
        for i, (s, a, p, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, i, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out, key=lambda x: (x[0], x[1]))


@pytest.fixture(scope="module")
def phrase_rows():
    rng = random.Random(3)
    few = [f"w{i}" for i in range(25)] + ["É", "ß", "\x00", "'", "\xa0b"]
    def prose(n):
        return "".join(rng.choice(few) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n"]) for _ in range(n))
    rows = [(rng.choice(["en", "en", "en", "de", None, "und"]), prose(rng.randint(1, 120))) for _ in range(120)]
    rows += [("en", "New York City IS big")] * 40 + [("en", "york city")] * 3 + [("de", "New York")] * 2
    rows += [("en", None), (None, None), ("en", ""), ("fr", " .,;"), ("en", "a b " * 30_000), ("en", "x" * 50_000)]
    rows += [("x\x00y", "a b c d e"), ("x", "a b")]
    return rows


def found_phrases(spark, rows, **options):
    schema = [T.StructField("lang", T.StringType()), T.StructField("text", T.StringType())]
    docs = table(spark, rows, schema).repartition(4)
    got = phrases.collocations(docs, **options).drop("best_left", "best_right").collect()
    return sorted((tuple(r) for r in got), key=lambda x: (x[0], x[1]))


@pytest.mark.parametrize(
    "options",
    [
        {"least": 3, "top": 2000},
        {"least": 30, "top": 7, "shard_words": 500},
        # A full filter and word hashes that clash: other seeds and more rows, the same result.
        {"least": 2, "top": 50, "shard_words": 3000, "filter_bits": 64, "hash_bits": 12},
    ],
)
def test_phrases_equal_counts_of_all_ngrams(spark, phrase_rows, options):
    got = found_phrases(spark, phrase_rows, **options)
    assert got == brute_phrases(phrase_rows, options["least"], options["top"])
    assert {"und", "en", "de"} <= {r[0] for r in got} or options["least"] > 3


def test_phrases_of_empty_and_wordless_tables(spark):
    assert found_phrases(spark, []) == []
    assert found_phrases(spark, [("en", None), (None, "...")]) == []


def test_phrase_extensions(spark):
    rows = [("en", "a b c")] * 10 + [("en", "a b")] * 30 + [("en", "z a b")] * 12
    schema = [T.StructField("lang", T.StringType()), T.StructField("text", T.StringType())]
    got = {r["phrase"]: r for r in phrases.collocations(table(spark, rows, schema), least=5).collect()}
    assert (got["a b"]["a"], got["a b"]["best_left"], got["a b"]["best_right"]) == (52, 12, 10)


def test_index_intervals_count_every_ngram():
    rng = np.random.default_rng(1)
    ids = np.concatenate([[0], rng.integers(0, 6, 400), [0]])
    forward, backward = phrases.transform(ids, 6), phrases.transform(ids[::-1], 6)
    assert (phrases.unpacked(phrases.packed(forward), len(ids)) == forward).all()
    fm = phrases.Index(forward, backward, 6)
    for steps in ("LLL", "RRR", "LRL", "RLR"):
        nodes = fm.words()
        for step in steps:
            nodes = fm.left(nodes) if step == "L" else fm.right(nodes)
            k = nodes.grams.shape[1]
            want = Counter(tuple(ids[i : i + k]) for i in range(len(ids) - k + 1) if ids[i : i + k].all())
            assert {tuple(g): c for g, c in zip(nodes.grams.tolist(), nodes.count.tolist())} == want
            # Both intervals hold the n-gram's occurrences.
            starts = sorted(range(len(ids)), key=lambda i: [int(x) for x in np.roll(ids, -i)[:4]])
            for g, c, lo in zip(nodes.grams.tolist(), nodes.count, nodes.forward):
                assert all(np.roll(ids, -starts[row])[: len(g)].tolist() == g for row in range(lo, lo + c))


def test_filters_hold_what_they_were_made_of(spark):
    rng = np.random.default_rng(9)
    rows = rng.integers(-(2**63), 2**63 - 1, (30_000, 2))
    table = spark.createDataFrame([tuple(map(int, r)) for r in rows], "w1 long, w2 long").repartition(3)
    made = phrases.filter_of(table, ["w1", "w2"])
    assert made.holds(rows).all() and len(made.cells) == 8192
    assert made.holds(rng.integers(-(2**63), 2**63 - 1, (30_000, 2))).mean() < 0.02
    full = phrases.filter_of(table, ["w1", "w2"], most_bits=1 << 10)
    assert full.holds(rows).all() and len(full.cells) == 16
    assert not phrases.filter_of(table.limit(0), ["w1", "w2"]).holds(rows).any()


def test_tasks_add_up_the_counts_of_their_shards(spark):
    """A phrase in every shard of a task is one row, not one for each shard."""
    rows = [("en", "a b c d e f")] * 400 + [("de", "a b c")] * 200
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(1)
    index, words = phrases.indexed(docs, 100, "lang", "text")
    ids = {(r["lang"], r["word"]): r["w1"] for r in words.collect()}
    want = {("en", k): 400 for k in ("abc", "bcd", "cde", "def")} | {("de", "abc"): 200}
    want = {tuple(ids[lang, w] for w in k): a for (lang, k), a in want.items()}
    filters = [phrases.filter_of(words, ["w1"])]
    pairs = phrases.enumerated(index, 2, filters).groupBy("w1", "w2").agg(F.sum("a").alias("a"))
    filters.append(phrases.filter_of(pairs, ["w1", "w2"]))
    assert index.count() > 20 and index.rdd.getNumPartitions() == 1
    got = phrases.enumerated(index, 3, filters).collect()
    assert len(got) == 5 and {tuple(r[:3]): r["a"] for r in got} == want
    # Where sums are given out early, there are more rows with the same sums.
    early = phrases.enumerated(index, 3, filters, held_rows=2).collect()
    sums = Counter()
    for r in early:
        sums[tuple(r[:3])] += r["a"]
    assert len(early) > 5 and sums == want


def test_an_index_in_small_splits_is_gathered(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = [("en", f"a b c d e {i % 7}") for i in range(40 * cores)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(8 * cores)
    index = phrases.build(docs.select("lang", F.col("text").cast("binary")), 10, 1).cache()
    count = index.count()
    assert phrases.gathered(index, least=count).rdd.getNumPartitions() == 2 * cores
    few = phrases.gathered(index, least=3)
    assert few.rdd.getNumPartitions() == -(-count // 3) > 2 * cores and few.count() == count
    assert phrases.gathered(index, least=1).rdd.getNumPartitions() == 8 * cores
    every = phrases.Filter(np.full(1, 2**64 - 1, np.uint64))
    made = phrases.enumerated(index, 4, [every] * 3)
    tasks, sums = made.rdd.getNumPartitions(), made.groupBy("w1", "w2", "w3", "w4").agg(F.sum("a").alias("a"))
    # Nine n-grams of four come once from each task, and not from each shard.
    assert tasks < 8 * cores and made.count() <= 9 * tasks < 2 * count
    assert sums.count() == 9 and sums.agg(F.sum("a")).first()[0] == 3 * len(rows)


def test_counts_add_up_within_the_rows_held():
    rng = np.random.default_rng(4)
    ids, count = rng.integers(-3, 3, (500, 3)), rng.integers(1, 9, 500)
    want = Counter()
    for row, n in zip(ids.tolist(), count.tolist()):
        want[tuple(row)] += n
    steps = [0, 10, 10, 110, 120, 130, 400, 410, 500]
    for most in (1, 50, 300, 5000):
        got, rows = Counter(), 0
        for grams, sums in phrases.combined(iter([(ids[a:b], count[a:b]) for a, b in zip(steps, steps[1:])]), most):
            rows += len(sums)
            for row, n in zip(grams.tolist(), sums.tolist()):
                got[tuple(row)] += n
        assert got == want and (rows == len(want) if most == 5000 else rows > len(want))
    assert list(phrases.combined(iter([]), 50)) == []
    assert [len(x) for _, x in phrases.combined(iter([(ids[:0], count[:0])]), 50)] == [0]


def test_score_is_exact_beyond_64_bits(spark):
    a, l, r = 9_000_000_000_000_000_001, 9_000_000_000_000_000_010, 9_100_000_000_000_000_000
    row = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    got = row.select(phrases.score_of(F.col("a"), F.col("l"), F.col("r"), 2_000_000).alias("s")).first()[0]
    assert int(got) == 2_000_000 * a // (l + r)


# --- centroid clustering ---------------------------------------------------------


def brute_clusters(rows, k, rounds, dims):
    kept = [
        (i, [math.floor(64 * float(x)) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    who = lambda v: min((dist(v, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        at = [who(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            mine = [v for (_, v), x in zip(kept, at) if x == j]
            if mine:
                centroids[j] = [sum(c) // len(mine) for c in zip(*mine)]
    out = [(i, *reversed(who(v))) for i, v in kept]
    return sorted(out, key=str), centroids


def vectors(spark, rows):
    schema = [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))]
    return table(spark, rows, schema).repartition(3)


@pytest.mark.parametrize("k", [1, 2, 16])
def test_clusters_equal_comparing_all(spark, k):
    rng = np.random.default_rng(k)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8) * rng.choice([0.1, 1, 5])]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # copies
    rows += [(5, rows[9][1]), (5, rows[9][1]), (None, rows[3][1]), (None, None), (700, None), (701, []), (702, [1.0] * 7)]
    rows += [(703, [None] + [1.0] * 7), (704, [math.nan] * 8), (705, [math.inf] * 8), (706, [-0.0] * 8), (707, [60_000.0] * 8)]
    found, summary = ptolemy.cluster(vectors(spark, rows), k=k, rounds=3, dims=8)
    want, centroids = brute_clusters(rows, k, 3, 8)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want
    got = {r["cluster"]: r for r in summary.collect()}
    assert [got[j]["centroid"] for j in range(len(centroids))] == centroids
    for j in got:
        assert int(got[j]["inertia"]) == sum(d for _, c, d in want if c == j)
        assert got[j]["n"] == sum(c == j for _, c, _ in want)


def test_clusters_of_equal_few_huge_and_no_vectors(spark):
    same = [(i, [0.5] * 8) for i in range(40)]
    found, summary = ptolemy.cluster(vectors(spark, same), k=4, dims=8)
    assert {(r["cluster"], r["distance"]) for r in found.collect()} == {(0, 0)}
    assert sorted(r["n"] for r in summary.collect()) == [0, 0, 0, 40]
    found, _ = ptolemy.cluster(vectors(spark, [(1, [0.5] * 8), (2, [3e38] * 8)]), k=4, dims=8)
    assert sorted(tuple(r) for r in found.collect()) in ([(1, 0, 0), (2, 1, 0)], [(1, 1, 0), (2, 0, 0)])
    found, summary = ptolemy.cluster(vectors(spark, [(1, None)]), k=4, dims=8)
    assert found.collect() == [] and summary.collect() == []


def test_bounds_are_below_distances_and_spare_comparisons():
    rng = np.random.default_rng(2)
    centers = rng.integers(-60, 60, (16, 64)).astype(float)
    x = np.floor(centers[rng.integers(0, 16, 3000)] + rng.normal(size=(3000, 64)) * 3)
    pivots = ptolemy.Pivots.of(centers)
    moved = np.floor(centers + rng.normal(size=centers.shape))
    for c in (centers, moved, rng.integers(-60, 60, (16, 64)).astype(float)):
        bounds = pivots.squared_bounds(pivots.distances(x), c)
        exact = np.stack([ptolemy.squared(x, row[None, :]) for row in c], axis=1)
        assert (bounds <= exact).all()
        who, best, compared = ptolemy.nearest(x, bounds, c)
        assert (who == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
        if c is not moved and c is not centers:
            continue
        assert compared < 2 * len(x)  # of 16


# --- BPE -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(4)
    pools = [
        "ab c\n\t 1'sé",
        [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000],
        ["<|endoftext|>", "<|", " ", "x"],
        [chr(c) for c in range(0x3000)],
        ["  ", chr(0x3000), "\x1c", "\x85", chr(0x200B), "'ll", "'", "l", chr(0x1F642), chr(0x4E2D), "\u0000"],
    ]
    texts = ["".join(rng.choice(pools[i % 5]) for _ in range(rng.randint(0, 60))) for i in range(1500)]
    texts += ["a" * 30_000, "".join(rng.choice("abcdefgh") for _ in range(30_000)), " " * 50_000 + "x", "the cat " * 9000]
    return [None, "", "<|endoftext|>", *texts]


def test_bpe_equals_the_library(spark, odd_texts, library):
    schema = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    rows = [*enumerate(odd_texts), (None, "no id"), (7, odd_texts[7]), (7, odd_texts[7])]
    docs = table(spark, rows, schema).repartition(4)
    key = lambda r: (str(r[0]), r[1] if r[1] is not None else "")
    found = sorted((tuple(r) for r in bpe.encode_and_decode(docs, tokenizer_path()).collect()), key=lambda r: (str(r[0]), r[1]))
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    assert found == sorted(want, key=lambda r: (str(r[0]), r[1]))
    apart = bpe.decode(bpe.encode(docs, tokenizer_path()), tokenizer_path()).collect()
    assert sorted((tuple(r) for r in apart), key=key) == sorted(((i, t or "") for i, t in rows), key=key)


def test_bpe_cuts_as_the_library_does_in_the_agreed_ranges(library):
    b = bpe.loaded(tokenizer_path())
    cut = library.pre_tokenizer
    for first in range(0, 0x20000, 7):  # a sample of code points; each is tried in four contexts
        if 0xD800 <= first < 0xE000:
            continue
        c = chr(first)
        s = f"a{c}1 {c}! {c}{c} b"
        assert b._words(s) == [s[i:j] for _, (i, j) in cut.pre_tokenize_str(s)], hex(first)


def test_bpe_decodes_any_ids(spark, library):
    rng = random.Random(5)
    lists = [[rng.randrange(50_257) for _ in range(rng.randint(0, 30))] for _ in range(300)]
    rows = [*enumerate(lists), (1000, None), (1001, [5, 999_999, 6])]
    tokens = spark.createDataFrame(rows, "doc_id long, ids array<long>")
    got = {r["doc_id"]: r["text"] for r in bpe.decode(tokens, tokenizer_path()).collect()}
    assert got[1000] == "" and got[1001] == library.decode([5, 6])
    assert all(got[i] == library.decode(x, skip_special_tokens=False) for i, x in enumerate(lists))


def test_pair_tree_yields_the_least_key():
    rng = random.Random(6)
    for n in (1, 2, 3, 7, 64, 100):
        keys = [rng.randrange(50) << 32 | i for i in range(n)]
        tree = bpe.PairTree(list(keys))
        for _ in range(200):
            at = rng.randrange(n)
            keys[at] = rng.choice([bpe.NO_PAIR, rng.randrange(50) << 32 | at])
            tree.put(at, keys[at])
            assert tree.root() == min(keys)


def test_words_merged_side_by_side_equal_words_merged_alone():
    rng = random.Random(7)
    b = bpe.Bpe(tokenizer_path())
    words = [bytes(rng.randrange(256) for _ in range(rng.randint(1, 64))) for _ in range(300)]
    words += ["".join(rng.choice("the andion") for _ in range(rng.randint(1, 64))).encode() for _ in range(700)]
    assert b.merged_many(words) == [np.array(b.merged(w), "<u4").tobytes() for w in words]
    assert b.merged_many([]) == []


def test_long_texts_are_cut_without_a_trace(library, monkeypatch):
    monkeypatch.setattr(bpe, "TEXT_STEP", 20)
    monkeypatch.setattr(bpe, "HELD_WORDS", 5)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 9)
    rng = random.Random(8)
    b = bpe.Bpe(tokenizer_path())
    for _ in range(300):
        text = "".join(rng.choice(["a", "b", "'s", " ", "  ", "\n", "1", "!", chr(0xA0), "<|endoftext|>"]) for _ in range(200))
        assert b.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_are_refused(tmp_path):
    path = tmp_path / "t.json"
    path.write_text('{"model": {"type": "WordPiece", "vocab": {}}, "pre_tokenizer": null}')
    with pytest.raises(ValueError):
        bpe.Bpe(str(path))


def test_empty_documents_table(spark):
    schema = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    assert bpe.encode_and_decode(table(spark, [], schema), tokenizer_path()).collect() == []


# --- pipeline stages ---------------------------------------------------------------


def test_stages_take_columns_of_any_name(spark):
    """Names that stages use inside, and an empty table."""
    import corpus_pipeline

    names = [
        "_w", "_v", "_h", "_o", "_p", "_l", "_base", "_spans", "_stats", "_copies", "_copy", "_id", "label", "row_number",
        "component", "size", "nth", "other column 3", "kept", "base_failed",
    ]
    words = " ".join(f"word{i % 60}" for i in range(80))
    rows = [(i, f"{words} {i} password: hunter{i}abc", "en", "a" if i % 3 else None, 9) for i in range(12)] + [(None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit("x") for c in names})
    labels = spark.createDataFrame([(i, 1, 0) for i in range(12)], "doc_id long, quality int, toxic int")
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            work = {
                "quality_rules": lambda d: corpus_pipeline.rules.keep_good(d, labels),
            }.get(name, lambda d, stage=stage: stage(spark, d, ""))
            out = work(table)
            assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
            assert all(r[c] == "x" for r in out.collect() for c in names), name
            assert bool(out.count()) == bool(table.count()), name
