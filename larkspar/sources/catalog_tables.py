"""Catalog tables: partitioned definitions, bucketed writes and partition overwrite."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the length of one action."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def has_hive(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.catalogImplementation", "in-memory") == "hive"


def create_partitioned_text(spark: SparkSession, table: str, columns: str, partition: str, location: str) -> None:
    """External tab-separated table partitioned by one text column, unless it exists.

    With a Hive catalog it is a Hive text table, otherwise the same layout as a CSV table.
    """
    if has_hive(spark):
        layout = (
            f"CREATE EXTERNAL TABLE IF NOT EXISTS {table} ({columns}) COMMENT 'partitioned text' "
            f"PARTITIONED BY ({partition} STRING) ROW FORMAT DELIMITED FIELDS TERMINATED BY '\\t' "
            "LINES TERMINATED BY '\\n' STORED AS TEXTFILE"
        )
    else:
        layout = (
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {partition} STRING) USING csv "
            f"OPTIONS (sep '\\t') PARTITIONED BY ({partition}) COMMENT 'partitioned text'"
        )
    spark.sql(f"{layout} LOCATION '{location}' TBLPROPERTIES ('format' = 'yyyy-MM')")


def insert_into(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """Positional insert; an overwrite replaces only the partitions present in ``df``."""
    spark = df.sparkSession
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        if has_hive(spark):
            with setting(spark, "hive.exec.dynamic.partition.mode", "nonstrict"):
                df.write.mode("overwrite" if overwrite else "append").insertInto(table)
        else:
            df.write.mode("overwrite" if overwrite else "append").insertInto(table)


def save_bucketed(df: DataFrame, table: str, path: str, partition: str, bucket: str, buckets: int) -> None:
    """Partitioned, bucketed and sorted table; later joins on ``bucket`` need no shuffle.

    Rows are brought together by bucket first, so an ordinary bucket of a partition is one file;
    a bucket that is too large for a task is split over several, and has as many files.
    """
    number = "bucket_number"
    while number in df.columns:
        number = f"_{number}"
    placed = df.withColumn(number, F.pmod(F.hash(bucket), F.lit(buckets))).hint("rebalance", number).drop(number)
    (
        placed.write.mode("overwrite").option("path", path)
        .partitionBy(partition).bucketBy(buckets, bucket).sortBy(bucket)
        .saveAsTable(table)
    )
