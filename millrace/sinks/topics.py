"""Messages to topics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery


def as_records(messages: DataFrame, value: str = "value") -> DataFrame:
    """``(topic, value)`` as the connector takes them; the topic is named by each message."""
    return messages.select("topic", F.col(value).cast("binary").alias("value"))


def write_topics(messages: DataFrame, options: Mapping[str, str], value: str = "value") -> StreamingQuery | None:
    """Publish a batch, or start publishing a stream. The connector comes with the deployment."""
    records = as_records(messages, value)
    if messages.isStreaming:
        return records.writeStream.format("kafka").options(**options).start()
    records.write.format("kafka").options(**options).save()
    return None


def write_topic_files(messages: DataFrame, path: str, mode: str = "append", value: str = "value") -> None:
    """The same records as landed parquet, for replays and tests."""
    as_records(messages, value).write.mode(mode).parquet(path)
