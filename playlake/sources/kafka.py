"""Topic source and sink (Kafka connector, when on the classpath).

Written against the public Structured Streaming Kafka options; the connector
jar is not installed in the test image, so only the payload framing is
exercised by tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake import schema as S
from playlake.operators.layers import bronze_from_topic

# Producer settings of the replay job (durable, batched, compressed).
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "5",
    "kafka.linger.ms": "20",
    "kafka.compression.type": "gzip",
}


def read_topic_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Subscribe to ``topic``; lost offsets do not fail the query."""

    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", "false")
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return bronze_from_topic(reader.load())


def topic_frame(events: DataFrame) -> DataFrame:
    """Events -> (key, value) records: key = session_id or 'unknown', value =
    the event as compact JSON (nulls kept). Keying by session keeps a
    session's events in one partition, in order."""

    fields = [F.col(f) for f in S.EVENT_FIELDS if f in events.columns]
    return events.select(
        F.coalesce(F.col("session_id"), F.lit("unknown")).alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    )


def write_topic(events: DataFrame, bootstrap_servers: str, topic: str) -> None:
    """Publish events to a topic (batch). Pacing is a consumer concern here:
    readers bound each micro-batch with ``maxOffsetsPerTrigger``."""

    writer = topic_frame(events).write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
    for k, v in PRODUCER_OPTIONS.items():
        writer = writer.option(k, v)
    writer.option("topic", topic).save()
