"""Text columns: cleaning, token maps, lengths and labels. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ulasan.settings import LABEL_NAMES, CleanRules

# Every character that counts as whitespace.
SPACE_CHARS = r"\x09-\x0d\x1c-\x1f\x85\p{Z}"
# Fixed value: characters that may follow the scheme of a URL. `$-_` is a range, so "~" and "#"
# end the URL.
URL_PATTERN = r"https?://[!$-_a-z]+"
# A token holding an inner "@" is removed whole. Starting only at token starts, and never giving
# characters back, keeps the scan linear on very long tokens.
EMAIL_PATTERN = (
    rf"(?<![^{SPACE_CHARS}])[^{SPACE_CHARS}][^{SPACE_CHARS}@]*+@[^{SPACE_CHARS}]++"
)

DEFAULT = CleanRules()


def remove_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL_PATTERN, "")


def remove_emails(text: Column, source: Column | None = None) -> Column:
    """`source` is a plain column that holds "@" whenever `text` does; it spares most rows the scan."""
    has_at = F.contains(text if source is None else source, F.lit("@"))
    return F.when(has_at, F.regexp_replace(text, EMAIL_PATTERN, "")).otherwise(text)


def letters_only(text: Column, special_chars: str = DEFAULT.special_chars) -> Column:
    return F.regexp_replace(text, special_chars, " ")


def cap_runs(text: Column) -> Column:
    """Three or more of one character become two."""
    return F.regexp_replace(text, r"(.)\1{2,}", "$1$1")


def collapse_spaces(text: Column, extra_whitespace: str = DEFAULT.extra_whitespace) -> Column:
    return F.trim(F.regexp_replace(text, extra_whitespace, " "))


def map_slang(text: Column, slang: dict[str, str] = DEFAULT.slang, lowered: bool = False) -> Column:
    """Replace each informal token once. `lowered` says the text is in lower case already."""
    if not slang:
        return text
    keys = list(slang)
    words = F.create_map(*[F.lit(w) for pair in slang.items() for w in pair])

    def standard(token: Column) -> Column:
        key = token if lowered else F.lower(token)
        return F.when(key.isin(keys), F.element_at(words, key)).otherwise(token)

    return F.array_join(F.transform(F.split(text, " "), standard), " ")


def drop_stopwords(text: Column, stopwords=DEFAULT.stopwords) -> Column:
    tokens = F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " ")
    return F.array_join(F.filter(tokens, lambda t: ~F.lower(t).isin(list(stopwords))), " ")


def _letters_and_spaces(text: Column, rules: CleanRules, between=lambda t: t) -> Column:
    """Non-letters to spaces, then `between`, then single spaces."""
    if (rules.special_chars, rules.extra_whitespace) == (
        DEFAULT.special_chars,
        DEFAULT.extra_whitespace,
    ):
        # The default patterns leave letters and spaces only, so one pass does both.
        return F.trim(between(F.regexp_replace(text, "[^a-zA-Z]+", " ")))
    return collapse_spaces(between(letters_only(text, rules.special_chars)), rules.extra_whitespace)


def clean_full(text: Column, rules: CleanRules = DEFAULT) -> Column:
    t = F.coalesce(text, F.lit(""))
    if rules.lowercase:
        t = F.lower(t)
    t = remove_emails(remove_urls(t), text)
    return map_slang(_letters_and_spaces(t, rules, cap_runs), rules.slang, rules.lowercase)


def clean_basic(text: Column, rules: CleanRules = DEFAULT) -> Column:
    """Letters only, single spaces, lower case; null becomes empty."""
    t = _letters_and_spaces(F.coalesce(text, F.lit("")), rules)
    return F.lower(t)


def clean(text: Column, rules: CleanRules = DEFAULT) -> Column:
    """Clean by profile, then drop stopwords when the rules ask for it."""
    t = clean_basic(text, rules) if rules.profile == "basic" else clean_full(text, rules)
    return drop_stopwords(t, rules.stopwords) if rules.remove_stopwords else t


def char_length(text: Column) -> Column:
    return F.length(text).cast("long")


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(text, rf"[{SPACE_CHARS}]+"), "")).cast("long")


def is_blank(text: Column) -> Column:
    """Null, empty, or only whitespace."""
    return text.isNull() | ~F.rlike(text, F.lit(rf"[^{SPACE_CHARS}]"))


def label_name(label: Column) -> Column:
    """1 is Positive; every other value, null too, is Negative."""
    return F.when(label == 1, LABEL_NAMES[1]).otherwise(LABEL_NAMES[0])


def label_name_strict(label: Column) -> Column:
    """1 is Positive, 0 is Negative, other values stay null."""
    return F.when(label == 1, LABEL_NAMES[1]).when(label == 0, LABEL_NAMES[0])


def preview(text: Column, n: int) -> Column:
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("..."))).otherwise(text)
