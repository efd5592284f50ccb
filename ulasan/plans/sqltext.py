"""Pieces of the SQL used to check query results."""

from __future__ import annotations

import string

from ulasan.settings import SLANG, STOPWORDS

SPACE = (
    r"\t\n\x0b\f\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

REVIEWS = (
    "reviews AS (SELECT d.doc_id AS row_id, d.text AS review, l.quality AS sentimen, l.toxic "
    "FROM documents d JOIN labels l USING (doc_id))"
)
UNIT = (
    "unit AS (SELECT vec_id, label, CAST(label >= 5 AS INTEGER) AS sentimen, list_transform(e, "
    "lambda x: CAST(CASE WHEN n > 0 THEN x / n ELSE x END AS FLOAT))::DOUBLE[] AS u FROM (SELECT *, "
    "sqrt(list_inner_product(e, e)) AS n FROM (SELECT vec_id, label, embedding::DOUBLE[] AS e "
    "FROM embeddings)))"
)


def r6(expr: str) -> str:
    return f"(round({expr}, 6) + 0.0)"


def repl(expr: str, pattern: str, to: str) -> str:
    return f"regexp_replace({expr}, '{pattern}', '{to}', 'g')"


def urls(expr: str) -> str:
    return repl(expr, "https?://[!$-_a-z]+", "")


def emails(expr: str) -> str:
    return repl(expr, f"[^{SPACE}]+@[^{SPACE}]+", "")


def caps(expr: str) -> str:
    for letter in string.ascii_lowercase:
        expr = repl(expr, letter + "{3,}", letter * 2)
    return expr


def slang(expr: str) -> str:
    pairs = ", ".join(f"'{k}': '{v}'" for k, v in SLANG.items())
    return (
        f"array_to_string(list_transform(string_split({expr}, ' '), "
        f"lambda w: coalesce(MAP {{{pairs}}}[lower(w)], w)), ' ')"
    )


def stopwords(expr: str) -> str:
    words = ", ".join(f"'{w}'" for w in STOPWORDS)
    return (
        f"array_to_string(list_filter(string_split({expr}, ' '), "
        f"lambda w: NOT list_contains([{words}], lower(w))), ' ')"
    )


def clean_full(expr: str) -> str:
    t = emails(urls(f"lower(coalesce({expr}, ''))"))
    return slang(f"trim({repl(caps(repl(t, '[^a-z]', ' ')), ' +', ' ')})")


def clean_basic(expr: str) -> str:
    t = repl(repl(f"coalesce({expr}, '')", r"[^a-zA-Z\s]", " "), r"\s+", " ")
    return f"trim(lower({t}))"


def words(expr: str) -> str:
    return f"len(list_filter(regexp_split_to_array({expr}, '[{SPACE}]+'), lambda w: w <> ''))"


def filled(expr: str) -> str:
    """True where the text is neither null nor blank."""
    return f"({expr} IS NOT NULL AND regexp_matches({expr}, '[^{SPACE}]'))"


def lowest(source: str, key: str, quota: str, by: str | None = None, seed: int = 42) -> str:
    """A subquery flagging the `quota` lowest keys per group in md5 order as `taken`."""
    part = f"PARTITION BY {by} " if by else ""
    return (
        f"(SELECT *, rn <= {quota} AS taken FROM (SELECT *, row_number() OVER ({part}ORDER BY "
        f"md5(CAST({key} AS VARCHAR) || ':{seed}'), {key}) AS rn, count(*) OVER ({part}) AS group_n "
        f"FROM {source}))"
    )
