"""Streaming sources, transforms and sinks; tables are staged as files and drained."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspar.catalog.projections import SPLIT_SQL
from larkspar.catalog.registry import query
from larkspar.catalog.sources import unique
from larkspar.sources import folder_log, messages
from larkspar.sources.databases import database_url, delete_batch, read_parallel, write_table
from larkspar.sources.files import Staged, stage
from larkspar.streaming.row_writer import LineWriter
from larkspar.streaming.run import (
    append_to_files,
    appended,
    appended_every,
    batch_folder,
    completed,
    finish,
    for_each_batch,
    preview,
    updates,
)
from larkspar.streaming.state import fold_stream, summed
from larkspar.streaming.transforms import camera_counts, distinct_within, windowed, with_gaps, word_totals

EVENT_DDL = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def read_staged(t, staged: Staged, fmt: str, schema: str, batches: int | None = None, **options) -> DataFrame:
    """Staged files as a stream that takes ``batches`` micro-batches, or as many as it likes."""
    reader = t.spark.readStream.schema(schema).options(**options)
    if batches:
        reader = reader.option("maxFilesPerTrigger", staged.per_trigger(batches))
    return reader.format(fmt).load(staged.path)


def event_stream(t, batches: int | None = None, files: int = 4) -> DataFrame:
    """Events staged as JSON files and read back as a stream."""
    staged = stage(t.timed_events, t.folder("events"), "json", files, **EXACT)
    return read_staged(t, staged, "json", EVENT_DDL, batches, **EXACT)


def plain_time(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def text_stream(t, batches: int | None = None) -> DataFrame:
    """Documents as a stream of lines: a text with line breaks is several lines."""
    staged = stage(t.documents.select(F.col("text").alias("value")), t.folder("lines"), "text", 4)
    return read_staged(t, staged, "text", "value string", batches)


@query("src_stream_json", "SELECT * FROM events")
def src_stream_json(t):
    return plain_time(appended(event_stream(t, batches=3, files=6)))


@query("src_stream_csv", "SELECT * FROM events")
def src_stream_csv(t):
    """All columns; texts with quotes, separators and line breaks are quoted and read back whole."""
    layout = {"sep": ",", "quote": '"', "escape": '"', "multiLine": "true", **EXACT}
    staged = stage(t.timed_events, t.folder("events-csv"), "csv", 4, **layout)
    return plain_time(appended(read_staged(t, staged, "csv", EVENT_DDL, **layout)))


LINES_SQL = "SELECT unnest(string_split(text, chr(10))) AS value FROM documents"


@query("src_stream_text", f"SELECT value, count(*) AS n FROM ({LINES_SQL}) GROUP BY value")
def src_stream_text(t):
    return appended(text_stream(t, batches=2)).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("src_stream_lines", f"""
    SELECT word, count(*) AS n FROM (SELECT unnest({SPLIT_SQL.replace("text", "value")}) AS word FROM ({LINES_SQL}))
    GROUP BY word""")
def src_stream_lines(t):
    """A stream of lines to words, the plan that follows a line source of any kind."""
    return completed(word_totals(text_stream(t)))


CUSTOM_DDL = "event_id bigint, user_id bigint, event_type string, value double"


@query("src_stream_custom", "SELECT event_id, user_id, event_type, value FROM events")
def src_stream_custom(t):
    """User-defined source over a folder, a few files per batch; every file can be read again after a failure."""
    staged = stage(t.events.select("event_id", "user_id", "event_type", "value"), t.folder("log"), "parquet", 4)
    stream = folder_log.read_stream(t.spark, staged.path, CUSTOM_DDL, t.folder("source-log"), staged.per_trigger(2))
    return appended_every(stream, t.folder("custom"), t.folder("stream-log"))


def message_stream(t) -> DataFrame:
    """Events as a message log: topic by type, partition by user, offset by id."""
    log = messages.envelope(
        t.timed_events, F.col("user_id"), F.col("props"), F.concat(F.lit("topic."), "event_type"),
        F.col("user_id") % 4, F.col("event_id"), F.col("ts"),
    )
    return read_staged(t, stage(log, t.folder("messages"), "parquet", 4), "parquet", messages.SCHEMA)


MESSAGES_SQL = """
    (SELECT user_id, props, 'topic.' || event_type AS topic, CAST(user_id % 4 AS INTEGER) AS partition, event_id, ts
     FROM events)"""


@query("src_stream_messages", f"""
    SELECT 'earliest' AS starting, topic, partition, event_id AS "offset", CAST(user_id AS VARCHAR) AS key, props AS value
    FROM {MESSAGES_SQL} WHERE topic IN ('topic.click', 'topic.error')
    UNION ALL SELECT 'assign', topic, partition, event_id, CAST(user_id AS VARCHAR), props
    FROM {MESSAGES_SQL} WHERE topic = 'topic.click' AND ((partition = 0 AND event_id >= 500) OR partition = 1)
    UNION ALL SELECT 'latest', topic, partition, event_id, CAST(user_id AS VARCHAR), props
    FROM {MESSAGES_SQL} WHERE topic LIKE 'topic.%' AND ts >= TIMESTAMP '2024-01-20'""")
def src_stream_messages(t):
    """Three starting points: the whole log, given offsets, and only what came after a cut."""
    log = message_stream(t)
    starts = {("topic.click", 0): 500, ("topic.click", 1): 0}
    chosen = {
        "earliest": messages.subscribe(log, topics=["topic.click", "topic.error"]),
        "assign": messages.from_offsets(log, starts),
        "latest": messages.subscribe(log, pattern="topic\\..*").where(
            F.col("timestamp") >= F.expr("CAST(TIMESTAMP_NTZ '2024-01-20 00:00:00' AS TIMESTAMP)")
        ),
    }
    result = None
    for starting, stream in chosen.items():
        rows = appended(stream.select(
            F.lit(starting).alias("starting"), "topic", "partition", "offset",
            F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        ))
        result = rows if result is None else result.unionByName(rows)
    return result


@query("stream_offset_ranges", f"""
    SELECT topic, partition, min(event_id) AS from_offset, max(event_id) + 1 AS until_offset
    FROM {MESSAGES_SQL} GROUP BY topic, partition""")
def stream_offset_ranges(t):
    path = t.folder("ranges")
    for_each_batch(
        message_stream(t),
        lambda batch, batch_id: messages.offset_ranges(batch).write.mode("overwrite").parquet(batch_folder(path, batch_id)),
    )
    return t.spark.read.parquet(path).drop("batch_id")


@query("st_word_count", f"""
    SELECT word, count(*) AS n FROM (SELECT unnest({SPLIT_SQL.replace("text", "value")}) AS word FROM ({LINES_SQL}))
    GROUP BY word""")
def st_word_count(t):
    """Running word counts over several micro-batches, complete mode."""
    return completed(word_totals(text_stream(t, batches=2)))


@query("st_json_agg", """
    SELECT true AS has_person, CAST(CAST(ts AS DATE) AS VARCHAR) AS start_time, count(*) AS n FROM events
    WHERE event_type <> 'error' GROUP BY CAST(ts AS DATE)""")
def st_json_agg(t):
    """Nested camera messages: parse, pick fields by path, filter, count."""
    day = F.date_format("ts", "yyyy-MM-dd'T'00:00:00.000'Z'")
    event = F.struct(
        (F.col("value") > 10).alias("has_sound"), (F.col("value") > 5).alias("has_motion"),
        (F.col("event_type") != "error").alias("has_person"), day.alias("start_time"), day.alias("end_time"),
    )
    camera = F.struct(F.col("user_id").cast("string").alias("device_id"), event.alias("last_event"))
    body = F.to_json(F.struct(F.struct(camera.alias("cameras")).alias("devices")))
    staged = stage(t.timed_events.select(body.alias("value")), t.folder("cameras"), "text", 4)
    counted = completed(camera_counts(read_staged(t, staged, "text", "value string")))
    return counted.withColumn("start_time", F.col("start_time").cast("string"))


#: Longer than the time the events of any scale folder span.
HORIZON = "10 years"


@query("st_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def st_distinct(t):
    """Pairs once each; the horizon is longer than the events reach, so no pair comes back."""
    return appended(distinct_within(event_stream(t, batches=2), ["user_id", "event_type"], "ts", HORIZON))


@query("st_na_fill", """
    SELECT event_id, CASE WHEN user_id < 3 THEN 0 ELSE user_id END AS user_id,
           CASE WHEN event_type = 'error' THEN 'none' ELSE event_type END AS event_type FROM events""")
def st_na_fill(t):
    holes = event_stream(t).select(
        "event_id", F.when(F.col("user_id") >= 3, F.col("user_id")).alias("user_id"),
        F.nullif("event_type", F.lit("error")).alias("event_type"),
    )
    return appended(holes.na.fill(0).na.fill("none"))


def tumbling_sql(unit: str) -> str:
    return f"""
        SELECT time_bucket(INTERVAL {unit}, ts) AS window_start, time_bucket(INTERVAL {unit}, ts) + INTERVAL {unit} AS window_end,
               event_type, count(*) AS n FROM events GROUP BY ALL"""


@query("st_window_sliding", """
    SELECT w AS window_start, w + INTERVAL 30 SECOND AS window_end, event_type, count(*) AS n FROM (
      SELECT event_type, time_bucket(INTERVAL 10 SECOND, ts) - o * INTERVAL 10 SECOND AS w
      FROM events, (VALUES (0), (1), (2)) s(o)) GROUP BY ALL""")
def st_window_sliding(t):
    return completed(windowed(event_stream(t), "ts", "30 seconds", "10 seconds", ["event_type"], n=F.count(F.lit(1))))


@query("st_window_tumbling", tumbling_sql("5 SECOND"))
def st_window_tumbling(t):
    return completed(windowed(event_stream(t), "ts", "5 seconds", None, ["event_type"], n=F.count(F.lit(1))))


@query("st_window_gaps", """
    SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS window_start, count(*) AS n FROM events
    WHERE epoch_us(ts) % 600000000 < 240000000 GROUP BY ALL""")
def st_window_gaps(t):
    """Four-minute windows every ten minutes: rows in the gaps are skipped."""
    inside = with_gaps(event_stream(t), "ts", 240, 600)
    return completed(windowed(inside, "ts", "10 minutes", None, [], n=F.count(F.lit(1)))).drop("window_end")


@query("st_watermark_append", """
    SELECT w AS window_start, w + INTERVAL 1 DAY AS window_end, count(*) AS n
    FROM (SELECT time_bucket(INTERVAL 1 DAY, ts) AS w FROM events)
    WHERE w + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY w""")
def st_watermark_append(t):
    """Closed windows only: a window is final once the watermark has passed its end."""
    late = event_stream(t).withWatermark("ts", "1 hour")
    return appended(windowed(late, "ts", "1 day", None, [], n=F.count(F.lit(1))))


STATE_SQL = """
    SELECT k AS key, CAST(sum(n) AS BIGINT) AS n FROM (
      SELECT c_mktsegment AS k, 100 AS n FROM customer GROUP BY c_mktsegment
      UNION ALL SELECT event_type, 1 FROM events) GROUP BY k"""


@query("st_update_state", STATE_SQL)
def st_update_state(t):
    """Running sum per key by a user-given update that starts from saved totals; keys without input stay."""
    saved = t.customer.groupBy(F.col("c_mktsegment").alias("key")).agg(F.lit(100).cast("long").alias("n"))
    counted = event_stream(t, batches=2).select(F.col("event_type").alias("key"), F.lit(1).cast("long").alias("n"))
    return fold_stream(
        counted, "key", "n long", lambda old, rows: ((old.n if old else 0) + sum(r.n for r in rows),),
        combine=summed("key", "n"), saved=saved,
    )


@query("st_state_restart", "SELECT event_type, CAST(2 * count(*) AS BIGINT) AS n FROM events GROUP BY event_type")
def st_state_restart(t):
    """Stop after the first drop of files, restart from the checkpoint for the second."""
    path, log = t.folder("drops"), t.folder("stream-log")

    def run_once() -> DataFrame:
        stage(t.events.select("event_type"), path, "json", 2)
        stream = t.spark.readStream.schema("event_type string").json(path)
        return completed(stream.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), checkpoint=log)

    run_once()
    return run_once()


@query("st_output_modes", """
    SELECT 'append' AS mode, event_type, count(*) AS n FROM events GROUP BY event_type
    UNION ALL SELECT 'complete', event_type, count(*) FROM events GROUP BY event_type
    UNION ALL SELECT 'update', event_type, count(*) FROM events GROUP BY event_type""")
def st_output_modes(t):
    """Rows as they come, the whole result, and changed groups only: the same totals."""
    stream = event_stream(t, batches=2).select("event_type")
    counted = stream.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    by_append = appended(stream).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    changes = updates(counted)
    by_update = changes.groupBy("event_type").agg(F.max_by("n", "batch_id").alias("n"))
    tagged = {"append": by_append, "complete": completed(counted), "update": by_update}
    result = None
    for mode, df in tagged.items():
        rows = df.select(F.lit(mode).alias("mode"), "event_type", "n")
        result = rows if result is None else result.unionByName(rows)
    return result


@query("st_triggers", """
    SELECT event_type, count(*) AS one_batch, count(*) AS many_batches, count(*) AS fixed_interval FROM events GROUP BY event_type""")
def st_triggers(t):
    """One batch, many batches and a fixed interval end with the same totals."""
    def totals(name: str, batches: int | None) -> DataFrame:
        return completed(event_stream(t, batches).groupBy("event_type").agg(F.count(F.lit(1)).alias(name)))

    every = appended_every(event_stream(t).select("event_type"), t.folder("interval"), t.folder("stream-log"))
    return (
        totals("one_batch", None).join(totals("many_batches", 4), "event_type")
        .join(every.groupBy("event_type").agg(F.count(F.lit(1)).alias("fixed_interval")), "event_type")
    )


@query("st_file_rate_limit", "SELECT true AS files_per_batch_kept, count(*) AS n_rows FROM events")
def st_file_rate_limit(t):
    """No micro-batch takes more files than the limit, and none is smaller than it must be."""
    staged = stage(t.timed_events, t.folder("events"), "json", 6, **EXACT)
    stream = read_staged(t, staged, "json", EVENT_DDL, batches=3, **EXACT)
    path = t.folder("batches")
    for_each_batch(
        stream.select("event_id", F.input_file_name().alias("file")),
        lambda batch, batch_id: batch.write.mode("overwrite").parquet(batch_folder(path, batch_id)),
    )
    limit = staged.per_trigger(3)
    per_batch = t.spark.read.parquet(path).groupBy("batch_id").agg(
        F.countDistinct("file").alias("files"), F.count(F.lit(1)).alias("n")
    )
    kept = (F.max("files") <= limit) & (F.count(F.lit(1)) == F.ceil(F.sum("files") / limit))
    return per_batch.agg(kept.alias("files_per_batch_kept"), F.sum("n").alias("n_rows"))


@query("st_ignore_partial_files", "SELECT count(*) AS n FROM events")
def st_ignore_partial_files(t):
    """Copies still being written, under a temporary name or suffix, are not read."""
    path = stage(t.events.select("event_id"), t.folder("copies"), "json", 3).path
    events = t.events.select(F.to_json(F.struct("event_id")).alias("value"))
    for name in ("_COPYING_", ".half.json", "0.json.tmp"):  # whole copies of the table under names that are not read
        events.write.text(f"{path}/{name}")
    stream = t.spark.readStream.schema("event_id bigint").option("pathGlobFilter", "*.json").json(path)
    return appended(stream).agg(F.count(F.lit(1)).alias("n"))


@query("sink_stream_files", """
    SELECT f.fmt, event_id, event_type, value FROM events, (VALUES ('csv'), ('json'), ('orc')) f(fmt)""")
def sink_stream_files(t):
    stream = event_stream(t, batches=2).select("event_id", "event_type", "value")
    result = None
    for fmt in ("csv", "json", "orc"):
        path = append_to_files(stream, fmt)
        rows = t.spark.read.schema(stream.schema).format(fmt).load(path).withColumn("fmt", F.lit(fmt))
        result = rows if result is None else result.unionByName(rows)
    return result


@query("sink_stream_messages", """
    SELECT 'counts' AS topic, time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS n FROM events
    WHERE time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY ALL""")
def sink_stream_messages(t):
    """Closed windows as JSON messages; reading them parses the value again."""
    late = event_stream(t).withWatermark("ts", "1 hour")
    totals = windowed(late, "ts", "1 day", None, [], n=F.count(F.lit(1))).drop("window_end")
    sent = appended(messages.as_message(totals, "counts"))
    body = F.from_json("value", "window_start timestamp_ntz, n bigint").alias("body")
    return sent.select("topic", body).select("topic", "body.window_start", "body.n")


@query("sink_stream_foreach", "SELECT event_id, event_type, value FROM events")
def sink_stream_foreach(t):
    path = t.folder("lines")
    stream = event_stream(t, batches=2).select("event_id", "event_type", "value")
    finish(stream.writeStream.foreach(LineWriter.into(t.spark, path)), t.folder("stream-log"))
    return t.spark.read.schema(stream.schema).json(path)


def _in_database(t, stream: DataFrame, **options) -> DataFrame:
    """Each micro-batch to a table, tagged with its number; a repeated batch replaces its rows. Read back by ``event_id``."""
    url, table = database_url(t.spark), unique("BATCHES").upper()

    def write(batch: DataFrame, batch_id: int) -> None:
        delete_batch(t.spark, url, table, "batch_id", batch_id)
        write_table(batch.withColumn("batch_id", F.lit(batch_id).cast("long")), url, table, mode="append", **options)

    for_each_batch(stream, write)
    return read_parallel(t.spark, url, table, "event_id").drop("batch_id")


@query("sink_stream_batch", "SELECT event_id, user_id, value FROM events")
def sink_stream_batch(t):
    return _in_database(t, event_stream(t, batches=2).select("event_id", "user_id", "value"))


@query("sink_stream_partition_batch", "SELECT event_id, value FROM events")
def sink_stream_partition_batch(t):
    """One connection and one commit per partition, rows inserted in batches."""
    return _in_database(t, event_stream(t).select("event_id", "value"), batchsize=1000)


@query("sink_stream_registered", "SELECT event_id, event_type, value FROM events")
def sink_stream_registered(t):
    """A sink chosen by its registered name, and its committed batches read back as a stream."""
    folder_log.register(t.spark)
    path = folder_log.qualified(t.spark, t.folder("log-out"))
    stream = event_stream(t, batches=2).select("event_id", "event_type", "value")
    finish(stream.writeStream.format("folder_log").option("path", path), t.folder("stream-log"))
    return appended(folder_log.read_stream(
        t.spark, path, "event_id bigint, event_type string, value double", t.folder("source-log")
    ))


#: Rows that a console shows unless told otherwise.
PREVIEW_ROWS = 20


@query("sink_console", f"""
    SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, event_type LIMIT {PREVIEW_ROWS}""")
def sink_console(t):
    """Preview of a running result: its first rows in a queryable in-memory table."""
    counts = event_stream(t).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return preview(counts, [F.desc("n"), F.asc("event_type")], PREVIEW_ROWS, unique("preview"))
