"""Message logs as tables or streams: key, value, topic, partition, offset, timestamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = (
    "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int"
)


def envelope(
    df: DataFrame, key: Column, value: Column, topic: Column, partition: Column, offset: Column, timestamp: Column
) -> DataFrame:
    return df.select(
        key.cast("string").cast("binary").alias("key"),
        value.cast("string").cast("binary").alias("value"),
        topic.alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def subscribe(messages: DataFrame, topics: list[str] | None = None, pattern: str | None = None) -> DataFrame:
    """Messages of the named topics, or of all topics whose whole name matches ``pattern``."""
    if topics is not None:
        return messages.where(F.col("topic").isin(topics))
    return messages.where(F.col("topic").rlike(f"^(?:{pattern})$"))


def from_offsets(messages: DataFrame, starts: dict[tuple[str, int], int]) -> DataFrame:
    """Messages at or after the given offset of their topic and partition; others are not read."""
    wanted = F.lit(False)
    for (topic, partition), start in starts.items():
        here = (F.col("topic") == topic) & (F.col("partition") == partition)
        wanted = wanted | (here & (F.col("offset") >= start))
    return messages.where(wanted)


def offset_ranges(messages: DataFrame) -> DataFrame:
    """First offset and the offset after the last, per topic and partition."""
    return messages.groupBy("topic", "partition").agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset")
    )


def as_message(df: DataFrame, topic: str) -> DataFrame:
    """Each row as the JSON value of a message to ``topic``."""
    return df.select(F.lit(topic).alias("topic"), F.to_json(F.struct("*")).alias("value"))
