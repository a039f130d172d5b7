"""Stream transforms; each is an ordinary DataFrame function that also runs on batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspar.operators.projections import explode_words

CAMERA_SCHEMA = """devices struct<cameras struct<device_id string, last_event struct<
    has_sound boolean, has_motion boolean, has_person boolean, start_time date, end_time date>>>"""
CAMERA_OPTIONS = {"dateFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSX", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSX"}


def camera_counts(messages: DataFrame) -> DataFrame:
    """Messages with a person, counted per flag and start date."""
    event = F.from_json(F.col("value").cast("string"), CAMERA_SCHEMA, CAMERA_OPTIONS).alias("body")
    parsed = messages.select(event).select(
        F.col("body.devices.cameras.last_event.has_person").alias("has_person"),
        F.col("body.devices.cameras.last_event.start_time").alias("start_time"),
    )
    return parsed.filter(F.col("has_person") == True).groupBy("has_person", "start_time").agg(  # noqa: E712
        F.count(F.lit(1)).alias("n")
    )


def word_totals(lines: DataFrame, text: str = "value") -> DataFrame:
    return explode_words(lines.select(text), text).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _once_per_part(rows: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """The rows of each Arrow batch with one per key, the latest, so repeated keys of a task are not all shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by(keys).aggregate([(ts, "max")])
            yield from found.select([*keys, f"{ts}_max"]).rename_columns([*keys, ts]).cast(batch.schema).to_batches()

    return rows.mapInArrow(run, rows.schema)


def distinct_within(df: DataFrame, keys: list[str], ts: str, horizon: str) -> DataFrame:
    """Distinct keys of a stream with bounded state.

    A key is emitted when it is first seen and remembered for ``horizon`` of event time after its
    latest row of that batch part; one that only comes again later than that is emitted again. Rows that are
    themselves later than the horizon are left out, as are rows without a time. Null keys are keys.
    """
    narrow = _once_per_part(df.select(*keys, ts).where(F.col(ts).isNotNull()), keys, ts)
    return narrow.withWatermark(ts, horizon).dropDuplicatesWithinWatermark(keys).select(*keys)


def windowed(df: DataFrame, ts: str, length: str, slide: str | None, keys: list[str], **totals: Column) -> DataFrame:
    """Totals per window and key; with ``slide`` shorter than ``length`` a row counts in several windows."""
    window = F.window(ts, length, slide) if slide else F.window(ts, length)
    grouped = df.groupBy(window.alias("window"), *keys).agg(*[e.alias(n) for n, e in totals.items()])
    return grouped.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *keys,
        *totals,
    )


def with_gaps(df: DataFrame, ts: str, length: int, slide: int) -> DataFrame:
    """Rows inside windows of ``length`` seconds that start every ``slide`` seconds, ``slide`` being longer.

    The rows between two windows belong to none. A tumbling window of ``slide``
    seconds over the result gives the totals.
    """
    seconds = F.unix_micros(F.col(ts)) % (slide * 1_000_000)
    return df.where(seconds < length * 1_000_000)


def with_saved_totals(saved: DataFrame, counted: DataFrame, key: str, value: str) -> DataFrame:
    """Running totals that start from saved ones.

    The saved totals enter the stream as its first rows, so a key without new input
    is in the result too, and the sum per key is combined before the shuffle.
    """
    rows = saved.select(key, value).unionByName(counted.select(key, value))
    return rows.groupBy(key).agg(F.sum(value).alias(value))
