"""Size checks that decide whether a side may be broadcast or written as one file."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 10 * 1024 * 1024


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows and text bytes of a DataFrame, from one aggregate job."""
    width = F.octet_length(F.to_json(F.struct("*")))
    row = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return int(row[0]), int(row[1])


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only for a side measured below ``max_bytes``.

    A larger side comes back without a hint, so the join is planned as a shuffle
    join and adaptive execution splits its skewed partitions.
    """
    _, size = measured(df)
    return F.broadcast(df) if size <= max_bytes else df


def use_all_cores(df: DataFrame) -> DataFrame:
    """Deal out a batch scan of fewer partitions than there are cores, before costly row work.

    A scan that already has enough partitions is left as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def file_count(rows: int, rows_per_file: int) -> int:
    return max(1, ceil(rows / rows_per_file))
