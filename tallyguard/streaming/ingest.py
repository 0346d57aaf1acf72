"""Topic or files to bronze, and bronze to NDJSON, continuously."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from tallyguard.sources.files import ndjson_lines
from tallyguard.sources.schemas import BRONZE_SCHEMA, TOPIC_SCHEMA
from tallyguard.sources.topic import read_topic_stream, to_bronze

TRIGGER_SECONDS = 10


def triggered(writer: DataStreamWriter, seconds: int, available_now: bool) -> DataStreamWriter:
    """A micro-batch every few seconds, or one run over what is there now."""
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{seconds} seconds")


def read_written(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """What batches have written so far; nothing before the first one."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    file_format: str = "parquet",
    trigger_seconds: int = TRIGGER_SECONDS,
    available_now: bool = False,
) -> StreamingQuery:
    writer = (
        df.writeStream.format(file_format)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return triggered(writer, trigger_seconds, available_now).start()


def write_bronze(
    bronze: DataFrame,
    path: str,
    checkpoint: str,
    trigger_seconds: int = TRIGGER_SECONDS,
    available_now: bool = False,
) -> StreamingQuery:
    """Append bronze rows; a restart with the same checkpoint adds only what is new."""
    return append_files(bronze, path, checkpoint, "parquet", trigger_seconds, available_now)


def replay_topic(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Topic records kept in Parquet files, as a stream."""
    reader = spark.readStream.schema(TOPIC_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def bronze_stream(spark: SparkSession, path: str) -> DataFrame:
    """The bronze table as a stream."""
    return spark.readStream.schema(BRONZE_SCHEMA).parquet(path)


def stream_ingest(
    spark: SparkSession,
    servers: str,
    topic: str,
    path: str,
    checkpoint: str,
    trigger_seconds: int = TRIGGER_SECONDS,
    **options: str,
) -> StreamingQuery:
    """Topic to bronze."""
    bronze = to_bronze(read_topic_stream(spark, servers, topic, **options))
    return write_bronze(bronze, path, checkpoint, trigger_seconds)


def export_topic_stream(
    bronze: DataFrame,
    path: str,
    checkpoint: str,
    trigger_seconds: int = TRIGGER_SECONDS,
    available_now: bool = False,
) -> StreamingQuery:
    """Append messages to NDJSON files; the checkpoint keeps the position, one per reader."""
    return append_files(ndjson_lines(bronze), path, checkpoint, "text", trigger_seconds, available_now)
