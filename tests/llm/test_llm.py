"""The training-text operators against brute force, on small fixtures with awkward rows."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ulasan.llm import chat, crf, minhash, mixing, packing, rules, secrets, simhash, toxicity, urls
from ulasan.llm.queries import URL_RULES, tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use inside.
        T.StructField("size", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("fp", T.StringType()),
        T.StructField("_id", T.StringType()),
        T.StructField("label", T.StringType()),
    ]
)


def prose(rng, n, vocabulary=400):
    words = [f"w{int(i):x}" for i in rng.zipf(1.3, n) % vocabulary]
    return " ".join(w + ("\n" if rng.random() < 0.1 else "") for w in words)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(5)
    plain = [prose(rng, int(n)) for n in rng.integers(1, 400, 60)]
    edited = [t.replace("w1 ", "wz ", 1) for t in plain[:20]]
    odd = [None, "", " \n\t ", "one", "two words", "a b c d", "é" * 50 + " ß" * 30, "x " * 3000, "ab " * 40000]
    return plain + edited + plain[:10] + odd


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [
        (i, t, "en", [None, "b", "a", "a", "a"][i % 5], None if t is None else len(t), "s", "i", "f", "u", "l")
        for i, t in enumerate(texts)
    ]
    rows += [(None, texts[0], None, None, None, None, None, None, None, None), rows[3]]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# --- SimHash ------------------------------------------------------------------


def brute_fingerprint(text):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closure(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash_components(spark, docs, none):
    got = simhash.near_duplicates(docs).collect()
    rows = docs.collect()
    want = {r.doc_id: brute_fingerprint(r.text) for r in rows}
    assert len(got) == len(rows)
    assert all(r.fp % 2**64 == want[r.doc_id] for r in got)
    ids = sorted(i for i in want if i is not None)
    links = [p for p in itertools.combinations(ids, 2) if (want[p[0]] ^ want[p[1]]).bit_count() <= 4]
    root = closure(ids, links) | {None: None}
    assert all(r.component_id == root[r.doc_id] for r in got)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in root if i is not None and root[i] == i)
    assert simhash.near_duplicates(none).count() == 0 == simhash.drop_near_duplicates(none).count()


def test_one_row_of_each_near_duplicate_group_stays(spark, docs):
    """Repeated rows, repeated and missing ids: one row a group, and clean texts that share an id stay."""
    rng = np.random.default_rng(31)
    a, b, c = (prose(rng, 300, 9000) for _ in range(3))
    rows = [(5, a), (5, a), (5, a), (3, b), (None, b), (None, c), (None, c), (5, c + " one"), (9, None), (8, ""), (None, " ")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {x: F.lit("kept") for x in ("row_number", "component", "fp", "component_id", "other column 0")}
    )
    kept = simhash.drop_near_duplicates(table)
    assert kept.columns == table.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    near = simhash.fingerprint(c) ^ simhash.fingerprint(c + " one")
    assert near.bit_count() <= 4
    assert got == sorted([(5, a), (3, b), (5, c + " one"), (8, "")], key=str)
    assert kept.where("row_number <> 'kept' OR `other column 0` <> 'kept'").count() == 0


@pytest.mark.parametrize("blocks,block_rows", [(5, 16_384), (6, 16_384), (7, 40), (5, 30)])
def test_near_links_join_what_all_pairs_join(spark, blocks, block_rows):
    rng = np.random.default_rng(blocks)
    base = rng.integers(0, 2**63, 120).astype(np.uint64)
    near = [int(base[i % 7]) ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(1, 4)))) for i in range(500)]
    fps = np.unique(np.array([*map(int, base), *near], np.uint64))
    rows = [(i, int(np.array([f]).view(np.int64)[0])) for i, f in enumerate(fps)]
    frame = spark.createDataFrame(rows, "id long, fp long")
    links = simhash.near_links(frame, 4, blocks, block_rows)
    found = {r.node: r.root for r in simhash.components(links).collect()}
    pairs = [
        (i, int(j) + i + 1)
        for i in range(len(fps))
        for j in np.flatnonzero(np.bitwise_count(fps[i] ^ fps[i + 1 :]) <= 4)
    ]
    want = closure(range(len(fps)), pairs)
    assert {i: found.get(i, i) for i in range(len(fps))} == want


def test_gray_rank_orders_the_code():
    words = np.arange(16, dtype=np.uint64)
    code = simhash.gray_word(words)
    assert all(int(a ^ b).bit_count() == 1 for a, b in zip(code, code[1:]))
    assert np.array_equal(simhash.gray_rank(code), words)


# --- quality rules ------------------------------------------------------------


def brute_base(text):
    text = text or ""
    words = WORD.findall(text)
    triples = list(zip(words, words[1:], words[2:]))
    n = Counter(triples)
    under = {i + k for i, t in enumerate(triples) if n[t] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(under),
    )


def test_rules_statistics_and_list(spark, docs, none):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rng = np.random.default_rng(3)
    good = [prose(rng, 120, 4000) for _ in range(300)]
    bad = [" ".join(w + "##" for w in t.split()) for t in good[:60]] + [t.upper() + "!" * 200 for t in good[60:120]]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 300)) for i in range(420)] + [(5, None), (None, 1)], "doc_id long, quality int")
    got, model = rules.judge(table, labels)
    rows = got.collect()
    assert model.rules and all(r.kept == (r.doc_id < 300) for r in rows if not r.base_failed)
    assert {r.doc_id for r in rules.keep_good(table, labels).collect()} == {r.doc_id for r in rows if r.kept}
    rows = rules.judge(docs, labels.limit(0))[0].collect()
    want = Counter((r.doc_id, brute_base(r.text)) for r in docs.collect())
    assert Counter((r.doc_id, tuple(r._base[c] for c in names)) for r in rows) == want
    failed = lambda b: b[0] < 50 or 100 * b[4] > 50 * b[0]
    assert all(r.base_failed == failed(tuple(r._base[c] for c in names)) == (not r.kept) for r in rows)
    assert rules.judge(none, labels)[0].count() == 0


# --- packing ------------------------------------------------------------------


@pytest.mark.parametrize("window,fan_in", [(64, 2), (1024, 256)])
def test_packing_round_trip(spark, docs, none, window, fan_in):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces = packing.pack(docs, tokenizer_path(), window=window, fan_in=fan_in, open_windows=4).toPandas()
    want = Counter()
    for r in docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        want[(r.doc_id, zlib.crc32(np.array(ids, "<u4").tobytes()), len(ids))] += 1
    by_doc = {(d, n): c for (d, c, n) in want}
    texts = {r.doc_id: r.text for r in docs.collect()}
    lengths = Counter()
    for p in pieces.itertuples():
        doc = None if p.doc_id != p.doc_id else int(p.doc_id)
        assert (doc, p.doc_tokens) in by_doc
        ids = tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids + [0]
        part = np.array(ids[p.start : p.start + p.length], "<u4")
        assert len(part) == p.length and zlib.crc32(part.tobytes()) == p.ids_crc32
        lengths[doc] += p.length
    for doc, n in Counter(r.doc_id for r in docs.collect()).items():
        total = next(k for (d, k) in by_doc if d == doc)
        assert lengths[doc] == n * total
    short = 0
    for _, s in pieces.sort_values("offset").groupby("sequence_id"):
        assert list(s.offset) == [0, *np.cumsum(s.length)[:-1]] and s.length.sum() <= window
        short += s.length.sum() < window - 8
    assert short <= 1
    assert packing.pack(none, tokenizer_path()).count() == 0


def test_text_encoder_equals_tokenizers():
    from tokenizers import Tokenizer

    tokenizer, encoder = Tokenizer.from_file(tokenizer_path()), packing.TextEncoder(tokenizer_path())
    for t in ["", " ", "a  b\n\n c", "it's 'tis don't.", "a² b٣,. \u00a0x", "x <|endoftext|> y", "é" * 999]:
        assert encoder.encode(t) == np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    assert encoder.fast is not None


@pytest.mark.parametrize("run", [" ", "\n", " \n", "\u00a0", "\u3000"])
def test_text_encoder_on_a_very_long_run_of_white_space(run):
    from tokenizers import Tokenizer

    tokenizer, encoder = Tokenizer.from_file(tokenizer_path()), packing.TextEncoder(tokenizer_path(), compare=0)
    for n in (packing.LONG_RUN - 1, packing.LONG_RUN, 1_000_000):
        for t in ("a b" + (run * n)[:n] + "c d", (run * n)[:n]):
            assert encoder.encode(t) == np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    assert encoder.fast is not None


# --- line model ---------------------------------------------------------------


def test_forward_backward_against_all_labellings():
    rng = np.random.default_rng(1)
    unary, step, sizes = rng.normal(size=(3, 4, 2)), rng.normal(size=(2, 2)), np.array([4, 2, 1])
    gamma, both, z = crf.forward_backward(unary, sizes, step)
    for d, n in enumerate(sizes):
        weights = {
            y: np.exp(sum(unary[d, t, y[t]] for t in range(n)) + sum(step[a, b] for a, b in zip(y, y[1:])))
            for y in itertools.product((0, 1), repeat=int(n))
        }
        total = sum(weights.values())
        assert np.isclose(z[d], np.log(total))
        for t in range(n):
            assert np.isclose(gamma[d, t, 1], sum(w for y, w in weights.items() if y[t]) / total)
        for a, b in itertools.product((0, 1), repeat=2):
            n_ab = sum(w * sum(p == (a, b) for p in zip(y, y[1:])) for y, w in weights.items()) / total
            assert np.isclose(both[d, a, b], n_ab)


def test_line_model_learns_and_scores(spark, docs, none):
    rng = np.random.default_rng(2)
    good = [prose(rng, 80, 4000) for _ in range(200)]
    bad = [" ".join(w + "%%" for w in t.split()) for t in good[:80]]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 200)) for i in range(280)], "doc_id long, quality int")
    model = crf.fit(table, labels)
    rows = crf.score(table, model).collect()
    assert all(r.predicted == int(r.doc_id < 200) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    odd = crf.score(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert crf.score(none, crf.fit(none, labels)).count() == 0


# --- secrets ------------------------------------------------------------------


def brute_spans(text):
    text = text or ""
    assign = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_secret_spans_models_and_redaction(spark, docs, none):
    rng = np.random.default_rng(8)
    key = lambda n, chars: "".join(rng.choice(list(chars), n))
    hexes, alnum = "0123456789abcdef", "ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnpqrstuvwxyz0123456789"
    rows = ["é PassWord: 'hunter22' x token=ab", "api_key=" + key(30, alnum), "AKIA" + key(16, "ABCDEF0123"), "AKIA12"]
    rows += [f"ï token = \"{key(40, hexes)}\" and secret:{key(24, alnum)} {key(30, hexes)}" for _ in range(60)]
    rows += ["internationalization_of_ordinary_identifiers and configuration_parameters_directory"] * 40
    rows += [None, "", key(32, alnum) + " plain " + key(32, alnum), "token=" * 500]
    table = spark.createDataFrame([(i, t, 0) for i, t in enumerate(rows)], "doc_id long, text string, n_chars long")
    model = secrets.train(secrets.samples_from(table.where(f"doc_id < {len(rows) - 4}")))
    got = {r.doc_id: r for r in secrets.scan(table, model).collect()}
    for i, t in enumerate(rows):
        assert [tuple(s) for s in got[i]._base] == brute_spans(t)
        assert [tuple(s) for s in got[i]._spans if s.kind < 3] == brute_spans(t)
    extra = [s for s in got[len(rows) - 2]._spans if s.kind == 3]
    assert len(extra) == 2 and not got[80]._spans
    clean = {r.doc_id: r for r in secrets.redact(table).collect()}
    assert clean[0].text == "é [SECRET]' x token=ab" and clean[0].n_chars == len(clean[0].text)
    assert clean[len(rows) - 4].text is None and clean[80].text == rows[80]
    assert secrets.redact(docs).columns == docs.columns and secrets.redact(none).count() == 0
    assert secrets.train(secrets.samples_from(none)) is None


# --- chat ---------------------------------------------------------------------


def test_chat_snapshots(spark):
    talk = [("user", "hi"), ("assistant", "yes"), ("user", "more"), (None, None)]
    logs = {1: talk[:1], 2: talk[:2], 3: talk, 4: talk, 5: [("user", "hi"), ("assistant", "no")], 6: [("user", "yo")] * 9}
    rows = [(c, 10 + t, r, x, "extra") for c, turns in logs.items() for t, (r, x) in enumerate(turns)]
    rows += [(None, 0, "user", "lost", "e"), (7, None, "user", "hi", "e")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place string")
    for part in (4096, 4):
        got = defaultdict(str)
        found = chat.render(table, part).orderBy("conv_id", "part").collect()
        for r in found:
            got[r.conv_id] += r.rendered
        assert set(got) == {3, 5, 6}
        spelled = lambda turns: "".join(f"<|im_start|>{r or ''}\n{x or ''}<|im_end|>\n" for r, x in turns)
        assert all(got[c] == spelled(logs[c]) for c in got)
        assert {r.conv_id: r.n_same for r in found}[3] == 2
    chunked = {(r.conv_id, r.place): (r.d1, r.d2) for r in chat.turns_in_order(table, chunk=3).collect()}
    whole = {(r.conv_id, r.place): (r.d1, r.d2) for r in chat.turns_in_order(table).collect()}
    assert chunked == whole
    assert chat.render(table.limit(0)).count() == 0


# --- toxicity -----------------------------------------------------------------


def test_block_max_index_is_exact():
    rng = np.random.default_rng(4)
    n_terms, vectors = 40, []
    for _ in range(300):
        t = np.sort(rng.choice(n_terms, int(rng.integers(1, 8)), replace=False))
        w = rng.random(len(t)) + 0.1
        vectors.append((t, w / np.sqrt((w * w).sum())))
    index = toxicity.BlockMaxIndex.build(vectors, n_terms, block=16)
    dense = np.zeros((300, n_terms))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for t, w in vectors[:100]:
        ids, cosines = index.nearest(t, w, 5)
        all_ = dense[:, t] @ w
        best = np.lexsort((np.arange(300), -np.round(all_, 12)))[:5]
        assert np.allclose(cosines, all_[best]) and list(ids) == list(best)
    assert index.visited < 100 * 19


def test_toxicity_learns_and_scores(spark, docs, none):
    rng = np.random.default_rng(6)
    clean = [prose(rng, 60, 4000) for _ in range(300)]
    toxic = [t + " " + " ".join(rng.choice(["vile", "nasty", "rotten"], 2)) for t in clean[:120]]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(clean + toxic)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 300)) for i in range(420)] + [(1, None)], "doc_id long, toxic int")
    model = toxicity.fit(table, labels)
    rows = toxicity.score(table, model).collect()
    assert sum(r.predicted != int(r.doc_id >= 300) for r in rows) <= 4
    held = {i for i in range(420) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert not held & set(model.examples.tolist())
    odd = toxicity.score(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0


# --- urls ---------------------------------------------------------------------


def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate({c: c + 32 for c in range(65, 91)})
    best = None
    for verdict, rule in URL_RULES:
        name, _, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail):
            best = max(best or ("", ""), (rule, verdict), key=lambda r: len(r[0]))
    return host, path, best


def test_url_rules_and_trees(spark):
    given = [
        None, "", "no scheme", "http://", "http://COM/", "HTTP://A.example.COM/en/x?q=1", "http://www.example.com/en/1",
        "http://xcom/", "http://a.net/es", "http://a.net/es/1", "http://a.net/fr/x", "http://a.net", "http://b.com?x=/",
        "http://b.com#/", "a://b://c.com/d", "http://É.COM/\n/x", "http://b.org/" + "y" * 50_000,
    ]
    rng = np.random.default_rng(0)
    given += [f"http://h{i}.com/{i}" for i in range(80)] + [f"http://h{i}.net/fr/{i}?a=1&b={i}" for i in range(80)]
    table = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(given)], "page_id long, url string, host string, label int")
    got = {r.page_id: r for r in urls.judge(table, URL_RULES, trees=3).collect()}
    assert len(got) == len(given)
    for i, u in enumerate(given):
        host, path, best = brute_url(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, best and best[0]), u
        assert got[i].verdict == (best[1] if best else "block" if got[i].block_score > 0.5 else "allow")
    assert urls.judge(table.limit(0), URL_RULES).count() == 0
    lexical = spark.createDataFrame(
        [(f"http://{''.join(rng.choice(list('abcdefgh'), 5))}.org/{'9' * 12 if i % 2 else 'about'}", i % 2) for i in range(200)],
        "url string, label int",
    )
    scored = urls.fit(lexical, trees=3).score(lexical).collect()
    assert all((r.block_score > 0.5) == bool(r.label) for r in scored)


# --- mixing -------------------------------------------------------------------


def test_targets_share_all_words():
    got = mixing.source_targets([("a", 10), ("b", 1000), ("c", 1000), (None, 500)])
    assert got[0] == 30 and np.isclose(sum(got), 2510) and np.isclose(got[1] / got[2], 2)
    assert mixing.source_targets([]) == []


def test_mix_copies(spark, docs, none):
    first = mixing.mix(docs, rows_per_group=7).collect()
    again = mixing.mix(docs.repartition(3), rows_per_group=7).collect()
    assert sorted(map(str, first)) == sorted(map(str, again)) and len(first) == docs.count()
    sizes = {r.doc_id: len(WORD.findall(r.text or "")) for r in docs.collect()}
    assert all(r["size"] == sizes[r.doc_id] and r.taken == r.copies * r["size"] <= 3 * r["size"] for r in first)
    rng = np.random.default_rng(1)
    many = spark.createDataFrame(
        [(i, " w" * int(rng.integers(0, 60)), ["a", "b", "c", None][min(3, i % 9)]) for i in range(4000)],
        "doc_id long, text string, source string",
    )
    taken, target = Counter(), {}
    for r in mixing.mix(many, rows_per_group=100).collect():
        taken[r.source_size] += r.taken
        target[r.source_size] = r.target
        assert abs(r.copies - r.target / r.source_size) < 1 and r.copies <= 3
    assert all(abs(taken[s] / target[s] - 1) < 0.01 for s in target)
    copies = {r.doc_id: r.copies for r in mixing.mix(many).collect()}
    assert Counter(r.doc_id for r in mixing.mixed_documents(many).collect()) == Counter({d: c for d, c in copies.items() if c})
    assert mixing.mix(none).count() == 0 == mixing.mixed_documents(none).count()
    assert mixing.mixed_documents(docs).columns == docs.columns


# --- fingerprints -------------------------------------------------------------


def jaccard(a, b):
    def shingles(t):
        w = WORD.findall(t or "")
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_minhash_likeness_and_packing():
    m = minhash.Minhash()
    rng = np.random.default_rng(9)
    misses = []
    for k in (5, 30, 100, 300):
        for _ in range(15):
            a = [f"w{i}" for i in rng.integers(0, 10**6, k)]
            b = a[: int(k * rng.random())] + [f"v{i}" for i in rng.integers(0, 10**6, k // 3)]
            x, y = (m.fingerprint(m.words(" ".join(t))) for t in (a, b))
            misses.append(m.likeness(x, y) - jaccard(" ".join(a), " ".join(b)))
            assert np.array_equal(m.unpacked(m.packed(x)), x)
    assert abs(np.mean(misses)) < 0.03 and np.sqrt(np.mean(np.square(misses))) < 0.12
    assert m.likeness(None, None) == 1.0 and m.likeness(None, x) == 0.0 and m.packed(None) == ""


@pytest.mark.parametrize("rows_per_run", [3, 2000])
def test_fingerprints_beside_the_next_document(spark, docs, none, rows_per_run):
    single = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).where("doc_id <> 17")
    got = {r.doc_id: r for r in minhash.compare_with_edits(single, rows_per_run=rows_per_run).collect()}
    order = sorted(((r.doc_id, r.text or "") for r in single.collect()), reverse=True)
    assert len(got) == len(order)
    for i, (doc, text) in enumerate(order):
        following, half = order[(i + 1) % len(order)][1], len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = got[doc]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_next - jaccard(text, following)) < 0.35
        assert (r.fingerprint == r.edited_fingerprint) or r.near_edited < 1
    by_text = defaultdict(set)
    for doc, text in order:
        by_text[text].add(got[doc].fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    plain = {r.doc_id: r.fingerprint for r in minhash.fingerprints(single).collect()}
    assert plain == {d: got[d].fingerprint for d in got}
    assert minhash.compare_with_edits(none).count() == 0 == minhash.fingerprints(none).count()
    alone = minhash.compare_with_edits(single.where("doc_id = 1")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


# --- the whole ----------------------------------------------------------------


def test_pipeline_stages(spark, sf):
    import corpus_pipeline

    docs = corpus_pipeline.read(spark, sf, "documents")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "simhash_near_dedup", "secret_scans", "mix_sources", "pack_sequences",
    ]
    out = corpus_pipeline.run(spark, sf)
    kept = corpus_pipeline.STAGES[0][1](spark, docs, sf)
    assert kept.columns == columns and 0 < kept.count() < docs.count()
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} <= {r.doc_id for r in kept.collect()}
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0
