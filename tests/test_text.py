import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ulasan.functions import text as tx
from ulasan.settings import SLANG, STOPWORDS, CleanRules


def apply(spark, values, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    rows = df.select("i", column(F.col("t")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in rows]


def test_fixed_values():
    assert len(STOPWORDS) == 36 and len(SLANG) == 24


def test_full_cleaning_cases(spark):
    cases = {
        None: "",
        "": "",
        "   ": "",
        "  ": "",
        "emg gt bagussss": "emang gitu baguss",
        "http://a.com/~u#f": "u f",
        "see HTTPS://A.com/x?y=1 now": "see now",
        "mail a.b@c.id please": "mail please",
        "x\x1ca@b\x1cy": "x y",
        "@home and home@ stay": "home and home stay",
        "a@@b d@@ c@ @@": "c",
        "Gak  bgt!!! 100% 😀": "tidak banget",
        "gaaak": "gaak",
        "knp kenapa gini gitu": "kenapa mengapa begini begitu",
        "Sooo\n\n\ngooood": "soo good",
    }
    assert apply(spark, list(cases), tx.clean_full) == list(cases.values())


def test_basic_cleaning_cases(spark):
    cases = {None: "", "  ": "", "Visit http://a.com NOW!!": "visit http a com now", "gaaak é": "gaaak"}
    assert apply(spark, list(cases), tx.clean_basic) == list(cases.values())


def test_other_patterns_and_case(spark):
    rules = CleanRules(lowercase=False, special_chars=r"[^a-zA-Z0-9\s]")
    assert apply(spark, ["Gak ABC 111 x1"], lambda t: tx.clean_full(t, rules)) == ["tidak ABC 11 x1"]
    assert apply(spark, ["Gak!"], lambda t: tx.clean_full(t, CleanRules(slang={}))) == ["gak"]


def test_stopwords(spark):
    rules = CleanRules(remove_stopwords=True)
    assert apply(spark, ["Yang bagus DAN itu murah"], lambda t: tx.clean(t, rules)) == ["bagus murah"]
    assert apply(spark, ["yang itu"], lambda t: tx.clean(t, rules)) == [""]


def test_lengths_labels_preview(spark):
    assert apply(spark, ["", " a  b\n", "é😀"], tx.char_length) == [0, 6, 2]
    assert apply(spark, ["", "  ", " a  b c\n"], tx.word_count) == [0, 0, 3]
    assert apply(spark, ["abcd", "abc", None], lambda t: tx.preview(t, 3)) == ["abc...", "abc", None]
    labels = spark.createDataFrame([(1,), (0,), (7,), (None,)], "c int")
    got = labels.select(tx.label_name(F.col("c")), tx.label_name_strict(F.col("c"))).collect()
    assert [tuple(r) for r in got] == [
        ("Positive", "Positive"),
        ("Negative", "Negative"),
        ("Negative", None),
        ("Negative", None),
    ]


def test_long_tokens_stay_linear(spark):
    """Whole texts are cleaned, so one very long token must not blow up the pattern search."""
    n = 1_000_000
    texts = ["x" * n, "@" * n, "ab" * n, "http://" + "a" * n, "a@" * (n // 2), "!" * n]
    start = time.perf_counter()
    out = apply(spark, texts, tx.clean_full)
    assert time.perf_counter() - start < 30
    assert out == ["xx", "", "ab" * n, "", "", ""]


@settings(max_examples=15, deadline=None)
@given(texts=st.lists(st.text(alphabet="aAbgk @.:/htp\n\té1~#", max_size=60), min_size=1, max_size=40))
def test_cleaning_properties(spark, texts):
    plain = CleanRules(slang={})
    cleaned = apply(spark, texts, lambda t: tx.clean_full(t, plain))
    again = apply(spark, cleaned, lambda t: tx.clean_full(t, plain))
    assert again == cleaned
    for t in cleaned:
        assert re.fullmatch(r"[a-z]*( [a-z]+)*", t)
        assert not re.search(r"(.)\1\1", t)
