"""Stream sources and the JSON publisher.

Every source yields the same two columns, ``value`` (message body) and
``timestamp`` (when the source got it), so jobs do not care where events come from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tidelake import schemas

TOPIC = "transport-events"


def kafka_stream(
    spark: SparkSession, servers: str, topic: str = TOPIC, group: str | None = None, starting: str = "latest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Topic read from its newest messages on; needs the Kafka connector on the class path.

    ``max_per_trigger`` bounds a micro-batch, e.g. while a backlog is worked off.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if group:
        reader = reader.option("kafka.group.id", group)
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"), "timestamp")


def file_stream(spark: SparkSession, path: str, fmt: str = "json", files_per_trigger: int | None = None) -> DataFrame:
    """Files of ``value, timestamp`` records, picked up as they arrive."""
    reader = spark.readStream.schema(schemas.RAW_STREAM)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(fmt).load(path)


def to_messages(df: DataFrame, key: Column | None = None) -> DataFrame:
    """Rows as JSON message bodies, NULL fields kept."""
    body = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
    return df.select(body) if key is None else df.select(key.cast("string").alias("key"), body)


def publish(df: DataFrame, servers: str, topic: str = TOPIC, key: Column | None = None) -> None:
    """Send a batch of rows to a topic as JSON."""
    (
        to_messages(df, key)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def publish_stream(df: DataFrame, fmt: str, checkpoint: str, **options: str) -> DataStreamWriter:
    """Writer that sends a stream as JSON to ``kafka``, ``text`` or ``console``."""
    writer = to_messages(df).writeStream.format(fmt).option("checkpointLocation", checkpoint)
    for name, value in options.items():
        writer = writer.option(name, value)
    return writer
