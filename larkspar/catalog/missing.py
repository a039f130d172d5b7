"""Missing values: null and NaN holes, and sentinel strings.

The driver tables have no holes, so the queries first punch them by value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspar.catalog.registry import query

HOLES_SQL = """
    (SELECT event_id, CASE WHEN user_id < 3 THEN NULL ELSE user_id END AS user_id,
            nullif(event_type, 'error') AS event_type,
            CASE WHEN value < 5 THEN 'NaN'::DOUBLE WHEN value > 20 THEN NULL ELSE value END AS value
     FROM events) h"""


def holes(t) -> DataFrame:
    value = F.col("value")
    return t.events.select(
        "event_id",
        F.when(F.col("user_id") >= 3, F.col("user_id")).alias("user_id"),
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(value < 5, F.lit(float("nan"))).when(value <= 20, value).alias("value"),
    )


@query("na_drop_any", f"""
    SELECT * FROM {HOLES_SQL}
    WHERE user_id IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)""")
def na_drop_any(t):
    return holes(t).na.drop("any", subset=["user_id", "value"])


@query("na_drop_all", f"""
    SELECT user_id, event_type, value FROM {HOLES_SQL}
    WHERE user_id IS NOT NULL OR event_type IS NOT NULL OR NOT (value IS NULL OR isnan(value))""")
def na_drop_all(t):
    return holes(t).drop("event_id").na.drop("all")


@query("na_fill", f"""
    SELECT event_id, coalesce(user_id, 0) AS user_id, event_type,
           CASE WHEN value IS NULL OR isnan(value) THEN 0 ELSE value END AS value FROM {HOLES_SQL}""")
def na_fill(t):
    return holes(t).na.fill(0, subset=["user_id", "event_type", "value"])


@query("na_replace", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'pending' ELSE o_orderstatus END AS status,
           CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'unnamed' ELSE o_orderpriority END AS priority
    FROM orders""")
def na_replace(t):
    texts = t.orders.select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")
    )
    one_column = texts.na.replace({"P": "pending"}, subset=["status"])
    return one_column.na.replace({"4-NOT SPECIFIED": "unnamed"})
