"""Topics as streams and as batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed value: the topic read when none is named.
DEFAULT_TOPIC = "test"


def topic_options(topics: Sequence[str], options: Mapping[str, str]) -> dict[str, str]:
    """Source options: all topics in one subscription, from the earliest offset."""
    return {
        "subscribe": ",".join(topics or [DEFAULT_TOPIC]),
        "startingOffsets": "earliest",
        **options,
    }


def as_messages(records: DataFrame) -> DataFrame:
    """Records of the connector as ``(topic, partition, offset, value, ts)``."""
    return records.select("topic", "partition", "offset", "value", F.col("timestamp").alias("ts"))


def read_topics(
    spark: SparkSession, topics: Sequence[str], options: Mapping[str, str], stream: bool = True
) -> DataFrame:
    """Several topics as one stream (or batch). The Kafka connector comes with the deployment."""
    reader = (spark.readStream if stream else spark.read).format("kafka")
    return as_messages(reader.options(**topic_options(topics, options)).load())


def read_topic_files(
    spark: SparkSession, path: str, schema: str, topics: Sequence[str] = (), per_trigger: int = 0
) -> DataFrame:
    """The same stream from landed parquet records, for replays and tests."""
    reader = spark.readStream.schema(schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    records = reader.parquet(path)
    return records.where(F.col("topic").isin(list(topics))) if topics else records
