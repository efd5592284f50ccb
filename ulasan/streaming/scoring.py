"""Continuous cleaning and scoring of arriving texts. Stateless, append only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ulasan.operators import prepare
from ulasan.plans.jobs import TrainedRun, score
from ulasan.settings import CleanRules


def read_texts(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    glob: str = "*.parquet",
    files_per_batch: int = 1000,
    spread_to: int | None = None,
) -> DataFrame:
    """Parquet files arriving in a folder.

    `spread_to` deals the rows of a batch out to that many tasks, for batches of few small files.
    """
    texts = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )
    return texts.repartition(spread_to) if spread_to else texts


def read_dataset(spark: SparkSession, path: str, schema: StructType, spread_to: int | None = None) -> DataFrame:
    """One Parquet dataset as a stream: all files of a folder, whatever their names, or a single file."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        return read_texts(spark, path, schema, "*", spread_to=spread_to)
    folder, _, name = path.rpartition("/")
    return read_texts(spark, folder or ".", schema, name, spread_to=spread_to)


def clean_stream(texts: DataFrame, rules: CleanRules = CleanRules(), min_chars: int = 3) -> DataFrame:
    """Cleaned texts long enough to be scored."""
    flagged = prepare.flag_rejects(prepare.with_clean(texts, rules), min_chars)
    return flagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def score_stream(run: TrainedRun, texts: DataFrame) -> DataFrame:
    """Predictions for a stream of `(row_index, review)`."""
    return score(run, texts)[0]


def write_stream(
    stream: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Append to Parquet; `available_now` stops after the files that are there."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
