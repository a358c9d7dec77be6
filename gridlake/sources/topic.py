"""Message source of the stream (A7): a topic of the Kafka protocol."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def topic_options(servers: str, topic: str, starting: str = "latest", **options) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, **options}


def read_topic(spark: SparkSession, servers: str, topic: str, starting: str = "latest", **options) -> DataFrame:
    """A streaming frame with the messages as ``value`` (needs the Kafka connector on the classpath)."""
    reader = spark.readStream.format("kafka").options(**topic_options(servers, topic, starting, **options))
    return reader.load().select("key", "value", "timestamp")
