"""Records of CSV files read in splits, also where quoted fields hold line breaks.

A line begins a record if an even number of quotes stands before it in its file (a doubled quote counts
twice, so it changes nothing). A first scan takes from every split its quotes, and how many records
begin in it if it starts inside quotes and if it doesn't; the prefix of the parities over a file's splits
tells which holds, and the prefix of the counts numbers the records. The second scan puts lines together.
A record that crosses splits comes as fragments, at most two of a split, which are joined by a window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ulasan.operators.ranking import settled

WHOLE, HEAD, TAIL, MIDDLE = range(4)
COUNTED = "file string, start long, n long, quotes long, even long, odd long"
PARTS = "file string, start long, nth long, kind int, record string"


def _runs(b: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], slice]]:
    """The stretches of a batch that lie in one split (columns `file`, `start`)."""
    start = b.column("start").to_numpy()
    files = b.column("file").dictionary_encode().indices.to_numpy()
    edges = np.flatnonzero((np.diff(start) != 0) | (np.diff(files) != 0)) + 1
    for lo, hi in zip([0, *edges], [*edges, b.num_rows]):
        if hi > lo:
            yield (b.column("file")[int(lo)].as_py(), int(start[lo])), slice(int(lo), int(hi))


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each split: lines, quotes, records that begin in it at an even and at an odd start."""
    key, sums = None, np.zeros(4, np.int64)

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]]), *(pa.array([int(x)]) for x in (key[1], *sums))], ["file", "start", "n", "quotes", "even", "odd"])

    for b in batches:
        quotes, blank = b.column("quotes").to_numpy(), b.column("blank").to_numpy(zero_copy_only=False)
        for at, part in _runs(b):
            if at != key:
                if key is not None:
                    yield row()
                key, sums = at, np.zeros(4, np.int64)
            q = quotes[part]
            before = (sums[1] + np.cumsum(q) - q) % 2
            filled = ~blank[part]
            sums += (len(q), q.sum(), (filled & (before == 0)).sum(), (filled & (before == 1)).sum())
    if key is not None:
        yield row()


def assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and fragments of records of each split, numbered by where they begin."""
    key, held, began, odd, nth = None, [], False, 0, 0
    out: list[tuple] = []

    def close(kind: int) -> None:
        nonlocal held, nth
        out.append((*key, nth, kind, "\n".join(held)))
        nth, held = nth + (kind in (WHOLE, TAIL)), []

    def batch() -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()))]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, ["file", "start", "nth", "kind", "record"])

    for b in batches:
        lines = b.column("value").to_pylist()
        quotes, blank, inside = b.column("quotes").to_numpy(), b.column("blank").to_pylist(), b.column("inside").to_pylist()
        for at, part in _runs(b):
            if at != key:
                if held:
                    close(TAIL if began else MIDDLE)
                key, nth, began, odd = at, 0, False, int(inside[part.start])
            for i in range(part.start, part.stop):
                if not odd and blank[i] and not quotes[i]:
                    continue
                if not odd:
                    began = True
                held.append(lines[i])
                odd = (odd + int(quotes[i])) % 2
                if not odd:
                    close(WHOLE if began else HEAD)
                    began = False
        if out:
            yield batch()
    if held:
        close(TAIL if began else MIDDLE)
    if out:
        yield batch()


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """`(row_index, record)` of all files under `path`: records in order of file name and place, from 0.

    The first record of every file is its header and has no row; blank lines outside quotes are none.
    Files follow RFC 4180: fields that hold quotes are quoted, quotes in them doubled. An unclosed quote
    at the end of a file ends with it.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.regexp_replace("value", "\r$", "").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    quotes = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).cast("long")
    lines = lines.select("*", quotes.alias("quotes"), (F.trim("value") == "").alias("blank"))
    splits = lines.select("file", "start", "quotes", "blank").mapInArrow(counted, COUNTED)
    of_file = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("inside", F.coalesce(F.sum("quotes").over(of_file), F.lit(0)) % 2 == 1)
    splits = splits.withColumn("records", F.when(F.col("inside"), F.col("odd")).otherwise(F.col("even")))
    splits = splits.withColumn("earlier", F.coalesce(F.sum("records").over(of_file), F.lit(0)))
    splits, sent, _ = settled(splits.select("file", "start", "n", "inside", "records", "earlier"), "csv-splits")
    # One short row for each file.
    files = splits.groupBy("file").agg(F.greatest(F.sum("records") - 1, F.lit(0)).alias("rows"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    marked = lines.withColumn("place", F.monotonically_increasing_id())
    marked = marked.join(F.broadcast(splits) if sent else splits, ["file", "start"])
    if not sent:  # the join has moved the lines
        marked = marked.repartition("file", "start").sortWithinPartitions("file", "start", "place")
    parts = marked.select("file", "start", "value", "quotes", "blank", "inside").mapInArrow(assembled, PARTS)

    last = F.col("kind") == TAIL
    in_order = Window.partitionBy("file").orderBy("start", last)
    pieces = parts.where(F.col("kind") != WHOLE).withColumn("of", F.sum(last.cast("int")).over(in_order))
    joined = pieces.groupBy("file", "of").agg(
        F.min(F.when(last, F.struct("start", "nth"))).alias("at"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", last.alias("last"), "record"))), lambda x: x["record"]), "\n").alias("record"),
    )
    whole = parts.where(F.col("kind") == WHOLE).select("file", "start", "nth", "record").unionByName(
        joined.select("file", "at.start", "at.nth", "record")
    )
    places = splits.select("file", "start", "earlier").join(files, "file")
    row = F.col("first") + F.col("earlier") + F.col("nth") - 1
    numbered = whole.join(F.broadcast(places) if sent else places, ["file", "start"])
    return numbered.where(F.col("earlier") + F.col("nth") > 0).select(row.alias("row_index"), "record")


def parsed(records: DataFrame, schema: T.StructType, options: dict) -> DataFrame:
    """The fields of `record` beside `row_index`."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    fields = F.from_csv("record", ddl, {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()})
    return records.select("row_index", fields.alias("f")).select("row_index", *(F.col(f"f.`{f.name}`") for f in schema.fields))
