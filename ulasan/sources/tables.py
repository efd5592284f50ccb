"""Reading review tables, and the views the queries use over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ulasan.sources.csv_records import csv_records, parsed

REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("review", T.StringType()),
        T.StructField("sentimen", T.IntegerType()),
        T.StructField("translate", T.StringType()),
    ]
)


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give a scan with fewer splits than cores one split per core, by a hash of `key`.

    A large table has more splits than cores and is left alone, so it is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def load_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, spread_by: str | None = None
) -> DataFrame:
    """One Parquet dataset; a path that cannot be read raises."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return spread(df, spread_by) if spread_by else df


def table(spark: SparkSession, sf_dir: str, name: str, spread_by: str | None = None) -> DataFrame:
    return load_table(spark, f"{sf_dir}/{name}.parquet", spread_by=spread_by)


def reviews(spark: SparkSession, sf_dir: str, spread_out: bool = False) -> DataFrame:
    """Labelled reviews: documents joined with their labels. `spread_out` suits costly text work."""
    key = "doc_id" if spread_out else None
    docs = table(spark, sf_dir, "documents", key).select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return docs.join(labels, "doc_id").select(
        F.col("doc_id").alias("row_id"),
        F.col("text").alias("review"),
        F.col("quality").alias("sentimen"),
        "toxic",
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vector table with a two-class label."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        "embedding",
        "label",
        (F.col("label") >= 5).cast("int").alias("sentimen"),
    )


def read_reviews_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = REVIEW_SCHEMA,
    multi_line: bool = True,
    required: tuple[str, ...] = ("review",),
    by_file: bool = False,
) -> DataFrame:
    """A headed CSV with a contiguous 0-based `row_index` in file order.

    Files are read in splits. With `multi_line` (for files whose quotes are balanced, see `csv_records`)
    quoted fields may hold line breaks. `by_file` reads each file in one task by Spark's own reader
    instead, which also takes stray quotes. There rows are numbered inside each file block, and blocks
    are put in order by name and offset, so only one short row per block meets in one task.
    """
    options = {"header": True, "multiLine": multi_line, "escape": '"'}
    present = spark.read.options(**options).csv(path).columns
    missing = [c for c in required if c not in present]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    known = {f.name: f.dataType for f in schema.fields}
    read_schema = T.StructType(
        [T.StructField(c, known.get(c, T.StringType())) for c in present]
    )
    if multi_line and not by_file:
        return parsed(csv_records(spark, path), read_schema, {"escape": '"', "multiLine": True})
    rows = (
        spark.read.options(**options)
        .schema(read_schema)
        .csv(path)
        .select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_start"),
        )
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    blocks = rows.groupBy("_file", "_start").agg(
        F.min("_pos").alias("_first"), F.count("*").alias("_n")
    )
    in_order = Window.orderBy("_file", "_start")
    offsets = blocks.select(
        "_file",
        "_start",
        "_first",
        (F.sum("_n").over(in_order) - F.col("_n")).alias("_offset"),
    )
    return rows.join(offsets, ["_file", "_start"]).select(
        (F.col("_offset") + F.col("_pos") - F.col("_first")).alias("row_index"), *present
    )
