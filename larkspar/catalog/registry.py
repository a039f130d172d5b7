"""Registered queries: a key, the Spark job, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larkspar.session import ship_package
from larkspar.tables import Tables

JOBS: dict[str, Callable[[Tables], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register the decorated ``Tables -> DataFrame`` function under ``key``."""

    def keep(job: Callable[[Tables], DataFrame]):
        if key in JOBS:
            raise ValueError(f"query {key} registered twice")
        JOBS[key] = job
        if sql is not None:
            SQL[key] = " ".join(sql.split())
        return job

    return keep


def runnable(job: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return job(Tables(spark, sf_dir))

    run.__name__ = job.__name__
    run.__doc__ = job.__doc__
    return run
