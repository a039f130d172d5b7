"""Row transforms that need more than one DataFrame call."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larkspar.functions.text import words


def map_partitions(df: DataFrame, per_batch: Callable[[pa.RecordBatch], pa.RecordBatch], schema) -> DataFrame:
    """Run ``per_batch`` over the Arrow batches of every partition; memory is bounded by one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield per_batch(batch)

    return df.mapInArrow(run, schema)


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per partition index."""
    return df.groupBy(F.spark_partition_id().alias("partition_index")).agg(F.count(F.lit(1)).alias("n_rows"))


def explode_words(df: DataFrame, text: str, word: str = "word") -> DataFrame:
    """One row per word; the other columns are repeated."""
    others = [c for c in df.columns if c != text]
    return df.select(*others, F.explode(words(F.col(text))).alias(word))


def word_count(df: DataFrame, text: str) -> DataFrame:
    return explode_words(df.select(text), text).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def parse_lines_by_split(lines: DataFrame, schema: StructType, sep: str = ",") -> DataFrame:
    """Split each line and cast the parts."""
    parts = F.split(F.col("value"), sep)
    return lines.select(*[parts[i].cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])


def parse_lines_by_schema(lines: DataFrame, schema: StructType, sep: str = ",") -> DataFrame:
    """Parse each line as one typed record."""
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    row = F.from_csv(F.col("value"), ddl, {"sep": sep})
    return lines.select(row.alias("r")).select("r.*")
