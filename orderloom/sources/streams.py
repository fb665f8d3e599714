"""Message streams. Each gives `value` and a `message_seq` that orders messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def text_messages(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """One message per line of the text files arriving in a folder."""
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(path)
    return lines.select(
        "value",
        F.struct(
            "_metadata.file_modification_time", "_metadata.file_path", "_metadata.file_block_start"
        ).alias("message_seq"),
    )


def parquet_messages(
    spark: SparkSession, path: str, sequence_type: str = "bigint", max_files: int = 1000
) -> DataFrame:
    """Parquet files with `value` and `message_seq`."""
    schema = f"message_seq {sequence_type}, value string"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def kafka_options(servers: str, topic: str, max_offsets: int, starting: str = "earliest") -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "maxOffsetsPerTrigger": str(max_offsets),
    }


def kafka_messages(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """A topic's messages; needs the Kafka connector on the class path. Messages of one order must
    share a partition (key them by order id) to be ordered among each other."""
    return (
        spark.readStream.format("kafka")
        .options(**options)
        .load()
        .select(
            F.col("value").cast("string").alias("value"),
            F.struct("offset", "partition").alias("message_seq"),
        )
    )
