"""Run a stream over everything available now and give back its result as a DataFrame.

Results go to files in the shared folder, never through the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from larkspar.session import new_folder


def finish(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process all available input in as many micro-batches as the source limits ask for."""
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def append_to_files(stream: DataFrame, fmt: str = "parquet", checkpoint: str | None = None, path: str | None = None) -> str:
    """Exactly-once file sink; returns its folder."""
    spark = stream.sparkSession
    path = path or new_folder(spark, "stream-out")
    finish(
        stream.writeStream.format(fmt).option("path", path).outputMode("append"),
        checkpoint or new_folder(spark, "stream-log"),
    )
    return path


def appended(stream: DataFrame) -> DataFrame:
    return stream.sparkSession.read.schema(stream.schema).parquet(append_to_files(stream))


def appended_every(stream: DataFrame, path: str, log: str, interval: str = "1 second") -> DataFrame:
    """Run on a fixed interval until all input is processed, then stop.

    A source that limits its batches by itself is drained this way: a single
    "available now" run takes one of its batches.
    """
    running = (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", log)
        .trigger(processingTime=interval).start()
    )
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def for_each_batch(
    stream: DataFrame, write: Callable[[DataFrame, int], None], mode: str = "append", checkpoint: str | None = None
) -> None:
    """Hand every micro-batch with its number to ``write``; a repeated batch has the same number."""
    finish(
        stream.writeStream.foreachBatch(write).outputMode(mode),
        checkpoint or new_folder(stream.sparkSession, "stream-log"),
    )


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def completed(stream: DataFrame, checkpoint: str | None = None) -> DataFrame:
    """The last full result of a stream in complete mode; a repeated batch replaces its own folder.

    Results lie beside a named checkpoint, so a restart without new input gives the last
    one there. A stream that never had input gives no rows.
    """
    spark = stream.sparkSession
    path = f"{checkpoint.rstrip('/')}-result" if checkpoint else new_folder(spark, "stream-result")
    last: list[int] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(path, batch_id))
        last[:] = [batch_id]

    for_each_batch(stream, write, "complete", checkpoint)
    if not last:
        last = _earlier_batch(spark, path)
    if not last:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(batch_folder(path, last[0]))


def _earlier_batch(spark: SparkSession, path: str) -> list[int]:
    """The number of the newest batch below ``path``, if there is one."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/batch_id=*")
        number = F.regexp_extract("path", r"batch_id=(\d+)/", 1).cast("int")
        newest = files.agg(F.max(number)).head()[0]
    except AnalysisException:  # no such folder
        return []
    return [] if newest is None else [newest]


def preview(stream: DataFrame, order: list[Column], rows: int, name: str) -> DataFrame:
    """The first ``rows`` of a running result, by ``order``, as an in-memory table called ``name``."""
    first = stream.orderBy(*order).limit(rows)
    finish(
        first.writeStream.format("memory").queryName(name).outputMode("complete"),
        new_folder(stream.sparkSession, "stream-log"),
    )
    return stream.sparkSession.table(name)


def updates(stream: DataFrame, checkpoint: str | None = None, path: str | None = None) -> DataFrame:
    """All changed rows of a stream in update mode, with the batch that changed them."""
    spark = stream.sparkSession
    path = path or new_folder(spark, "stream-changes")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(path, batch_id))

    for_each_batch(stream, write, "update", checkpoint)
    return spark.read.schema(stream.schema.add("batch_id", "long")).parquet(path)
