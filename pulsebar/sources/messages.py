"""Message sources and sinks: a message broker, or files with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameReader
from pyspark.sql.streaming import DataStreamReader

from pulsebar.layout import MESSAGE_SCHEMA
from pulsebar.sources.workdir import exists

KAFKA = "kafka"


def _load(reader: DataFrameReader | DataStreamReader, fmt: str, options: dict[str, str]) -> DataFrame:
    reader = reader.format(fmt).options(**options)
    if fmt == KAFKA:
        return reader.load().select(
            F.col("value").cast("string").alias("value"),
            "topic",
            "partition",
            "offset",
            "timestamp",
        )
    return reader.schema(MESSAGE_SCHEMA).load()


def read_messages(spark: SparkSession, fmt: str, **options: str) -> DataFrame:
    """All messages there are now, from the oldest on."""
    if fmt == KAFKA:
        options = {"startingOffsets": "earliest", "endingOffsets": "latest", **options}
    return _load(spark.read, fmt, options)


def stream_messages(spark: SparkSession, fmt: str, **options: str) -> DataFrame:
    """Messages as they come. Every job is its own consumer: Spark gives each
    query a group of its own and keeps its position in the query's checkpoint."""
    return _load(spark.readStream, fmt, options)


def broker_options(
    servers: str, topic: str, tasks: int | None = None, per_batch: int | None = None
) -> dict[str, str]:
    """Options of a broker source.

    ``tasks`` reads a topic in at least that many tasks: the long offset ranges
    are cut up, so a topic of one partition, or with one that holds most of the
    messages, is still read in parallel. ``per_batch`` bounds the messages of a
    micro-batch when a stream has to catch up.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if tasks is not None:
        options["minPartitions"] = str(tasks)
    if per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(per_batch)
    return options


def keep(messages: DataFrame, path: str) -> None:
    """Add messages to a folder that stands in for a topic, under offsets it has not yet."""
    spark = messages.sparkSession
    old = spark.read.schema(MESSAGE_SCHEMA).parquet(path) if exists(spark, path) else None
    after = 0 if old is None else (old.agg(F.max("offset")).first()[0] or 0) + 1
    numbered = messages.select(
        "value",
        F.lit(path.rstrip("/").rpartition("/")[2]).alias("topic"),
        F.lit(0).alias("partition"),
        (F.monotonically_increasing_id() + after).alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
    numbered.write.mode("append").parquet(path)


def send(messages: DataFrame, servers: str, topic: str) -> None:
    """Send the ``value`` of each row to a topic."""
    (
        messages.select(F.col("value").cast("binary").alias("value"))
        .write.format(KAFKA)
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
