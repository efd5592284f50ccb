"""What several operators share: word patterns, labelled rows, bounded samples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text in order; null and empty texts have none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the rows that no model may learn from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def two_columns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`(doc_id, text)` only: other columns, whatever their names, stay behind."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def sheltered(docs: DataFrame, known: tuple[str, ...], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What `work` makes of `docs`, with all columns but the `known` ones under names that clash with none.

    `work` returns the columns it got, in their order; their names come back afterwards.
    """
    names = docs.columns
    inner = docs.toDF(*(c if c in known else f"other column {i}" for i, c in enumerate(names)))
    return work(inner).select(*(f"`{c}`" for c in inner.columns)).toDF(*names)


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, max_rows: int, salt: str
) -> DataFrame:
    """`(doc_id, text, label)` of at most about `max_rows` labelled rows that are not held out.

    The share to keep comes from one count over the labels; rows are kept by a hash of their id and
    `salt`, so no row is sorted or moved for it and reruns agree. Labels are joined on doc_id; a
    document with several labels gives several rows, null labels and null ids give none.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(
        F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    share = min(1.0, max_rows / max(1, known.count()))
    place = F.pmod(F.xxhash64(F.lit(salt), "doc_id"), F.lit(1 << 30))
    picked = known.where(place < int(share * (1 << 30)))
    # At most about `max_rows` short rows, by the bound above.
    return two_columns(docs, "doc_id", "text").join(F.broadcast(picked), "doc_id")
