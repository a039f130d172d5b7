"""The driver tables of one scale folder, read lazily and only when used."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspar.plans.sizing import use_all_cores
from larkspar.session import new_folder

NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """``t.orders`` reads ``<folder>/orders.parquet``; ``t.folder(label)`` gives a scratch path."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def folder(self, label: str) -> str:
        return new_folder(self.spark, label)

    @property
    def texts(self) -> DataFrame:
        """Document ids and texts, spread over all cores for work on words."""
        return use_all_cores(self.documents.select("doc_id", "text"))

    @property
    def timed_events(self) -> DataFrame:
        """Events with ``ts`` as an instant: watermarks reject zone-less timestamps."""
        return self.events.withColumn("ts", F.col("ts").cast("timestamp"))
