"""JSON message sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyforge.sources.messages import MAX_MESSAGE_BYTES


def to_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Each row as a JSON text `value`, with `key` as the message key if given."""
    value = F.to_json(F.struct("*")).alias("value")
    if key is None:
        return df.select(value)
    return df.select(F.col(key).cast("string").alias("key"), value)


def publish_kafka(
    messages: DataFrame, servers: str, topic: str, checkpoint: str, **options: str
) -> StreamingQuery:
    """Append to a topic; the connector retries and waits for all replicas.
    Needs the Kafka connector on the class path."""
    settings = {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "5",
        "kafka.max.request.size": str(MAX_MESSAGE_BYTES),
        "checkpointLocation": checkpoint,
        **options,
    }
    return messages.writeStream.format("kafka").options(**settings).start()


def publish_files(
    messages: DataFrame, path: str, checkpoint: str, **trigger: bool | str
) -> StreamingQuery:
    """Append one JSON message per line to text files."""
    stream = messages.select("value").writeStream.format("text")
    return stream.option("checkpointLocation", checkpoint).trigger(**trigger).start(path)
