"""File formats: typed JSON records, staged folders and small report files."""

from __future__ import annotations

from math import ceil
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



def text_records(lines: DataFrame, text: str, fields: dict[str, str], bad: str = "malformed") -> DataFrame:
    """Parse JSON text into an all-string record; numbers pass through their given type.

    ``fields`` maps names to the type a value is read as before it becomes text, so
    an integer read as ``double`` shows as ``"40000.0"``. A text that is no JSON
    object goes to the ``bad`` column instead of failing the job.
    """
    ddl = ", ".join([f"`{n}` {kind}" for n, kind in fields.items()] + [f"`{bad}` string"])
    parsed = F.from_json(F.col(text), ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    others = [c for c in lines.columns if c != text]
    rows = lines.select(*others, parsed.alias("_r"))
    return rows.select(*others, *[F.col(f"_r.{n}").cast("string").alias(n) for n in fields], F.col(f"_r.{bad}").alias(bad))


class Staged(NamedTuple):
    path: str
    files: int

    def per_trigger(self, batches: int) -> int:
        """Files per micro-batch so that all files take ``batches`` batches."""
        return ceil(self.files / batches)


def stage(df: DataFrame, path: str, fmt: str, at_least: int, **options) -> Staged:
    """Write a scan of a table as files: one per input partition, but ``at_least`` so many.

    The number of files follows the size of the input, so no task writes a fixed share of it.
    """
    parts = df.rdd.getNumPartitions()
    spread = df if parts >= at_least else df.repartition(at_least)
    spread.write.format(fmt).options(**options).mode("append").save(path)
    return Staged(path, max(parts, at_least))


def write_report(df: DataFrame, path: str, fmt: str = "json", files: int = 1) -> None:
    """Write the result as ``files`` files, whatever its size; the tasks before keep their number."""
    df.repartition(files).write.format(fmt).option("encoding", "UTF-8").save(path)


def read_libsvm(spark: SparkSession, path: str, features: int) -> DataFrame:
    """Sparse rows; naming the vector size saves a pass over the data."""
    return spark.read.format("libsvm").option("numFeatures", features).load(path)
