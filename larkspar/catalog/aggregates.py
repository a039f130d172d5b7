"""Grouping, multi-level totals, per-key aggregates and deduplication."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspar.catalog.registry import query
from larkspar.operators.aggregates import (
    combine_by_key,
    keep_one,
    last_per_key,
    multi_level,
    values_per_key,
)


@query("agg_group_multi", """
    SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_quantity,
           round(sum(l_extendedprice), 2) / count(l_extendedprice) AS avg_price
    FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def agg_group_multi(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_quantity"),
        (F.round(F.sum("l_extendedprice"), 2) / F.count("l_extendedprice")).alias("avg_price"),
    )


@query("agg_group_single", """
    SELECT o_orderpriority, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderpriority""")
def agg_group_single(t):
    summed = t.orders.groupBy("o_orderpriority").sum("o_totalprice").toDF("o_orderpriority", "total")
    return summed.withColumn("total", F.round("total", 2))


@query("agg_group_count", "SELECT p_name, count(*) AS count FROM part GROUP BY p_name")
def agg_group_count(t):
    return t.part.groupBy("p_name").count()


@query("agg_group_by_key_count", """
    SELECT year(l_shipdate) AS ship_year, count(*) AS n FROM lineitem GROUP BY year(l_shipdate)""")
def agg_group_by_key_count(t):
    key = F.year("l_shipdate").cast("long").alias("ship_year")
    return t.lineitem.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


@query("agg_global", "SELECT count(o_custkey) AS n_keys, count(*) AS n_rows FROM orders")
def agg_global(t):
    return t.orders.agg(F.count("o_custkey").alias("n_keys"), F.count(F.lit(1)).alias("n_rows"))


def sales(t) -> DataFrame:
    """Sales per nation and order year, combined by key before the nation names are added."""
    customers = t.customer.select("c_custkey", "c_nationkey")
    per_key = (
        t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", F.year("o_orderdate").cast("long").alias("year"))
        .agg(F.sum("o_totalprice").alias("amount"), F.count("o_totalprice").alias("n"))
    )
    return per_key.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("nation"), "year", "amount", "n"
    )


def sales_sql(grouping: str) -> str:
    return f"""
        SELECT n_name AS nation, year(o_orderdate) AS year, round(sum(o_totalprice), 2) AS sum_amount,
               round(sum(o_totalprice), 2) / count(o_totalprice) AS avg_amount
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        GROUP BY {grouping}"""


@query("agg_grouping_sets", sales_sql("GROUPING SETS ((n_name, year(o_orderdate)), ())"))
def agg_grouping_sets(t):
    return multi_level(sales(t), ["nation", "year"], [["nation", "year"], []]).orderBy(F.desc("nation"), F.desc("year"))


@query("agg_rollup", sales_sql("ROLLUP (n_name, year(o_orderdate))"))
def agg_rollup(t):
    return multi_level(sales(t), ["nation", "year"], "rollup").sort(F.asc_nulls_last("nation"), F.desc_nulls_last("year"))


@query("agg_cube", sales_sql("CUBE (n_name, year(o_orderdate))"))
def agg_cube(t):
    return multi_level(sales(t), ["nation", "year"], "cube").sort(F.asc_nulls_last("nation"), F.desc_nulls_last("year"))


@query("agg_reduce_by_key", "SELECT l_suppkey AS k, round(sum(l_extendedprice), 2) AS v FROM lineitem GROUP BY l_suppkey")
def agg_reduce_by_key(t):
    return t.lineitem.groupBy(F.col("l_suppkey").alias("k")).agg(F.round(F.sum("l_extendedprice"), 2).alias("v"))


@query("agg_group_by_key", """
    SELECT o_custkey, o_orderpriority, count(*) AS copies FROM orders GROUP BY o_custkey, o_orderpriority""")
def agg_group_by_key(t):
    return values_per_key(t.orders, "o_custkey", "o_orderpriority")


@query("agg_combine_by_key_avg", """
    SELECT o_custkey, round(sum(o_totalprice), 2) / count(o_totalprice) AS mean_price FROM orders GROUP BY o_custkey""")
def agg_combine_by_key_avg(t):
    combined = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("s"), F.count("o_totalprice").alias("n"))
    return combined.select("o_custkey", (F.round("s", 2) / F.col("n")).alias("mean_price"))


@query("agg_aggregate_by_key", """
    SELECT p_brand, round(sum(p_retailprice * 0.5), 3) AS half_price FROM part GROUP BY p_brand""")
def agg_aggregate_by_key(t):
    return t.part.groupBy("p_brand").agg(F.round(F.sum(F.col("p_retailprice") * 0.5), 3).alias("half_price"))


@query("agg_fold_by_key", "SELECT user_id, round(10 + sum(value), 2) AS folded FROM events GROUP BY user_id")
def agg_fold_by_key(t):
    return t.events.groupBy("user_id").agg(F.round(F.lit(10) + F.sum("value"), 2).alias("folded"))


@query("agg_reduce", "SELECT 'total price' AS label, round(sum(l_extendedprice), 2) AS price FROM lineitem")
def agg_reduce(t):
    return t.lineitem.agg(F.round(F.sum("l_extendedprice"), 2).alias("price")).select(
        F.lit("total price").alias("label"), "price"
    )


@query("agg_count_by_key", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey")
def agg_count_by_key(t):
    return t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l_partkey")


@query("agg_collect_as_map", """
    SELECT o_custkey AS k, arg_max(o_totalprice, o_orderkey) AS v FROM orders GROUP BY o_custkey""")
def agg_collect_as_map(t):
    pairs = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("v"), "o_orderkey")
    return last_per_key(pairs, "k", "v", "o_orderkey")


@query("agg_accumulator_sum", "SELECT CAST(sum(l_linenumber) AS BIGINT) AS counter FROM lineitem")
def agg_accumulator_sum(t):
    return t.lineitem.agg(F.sum("l_linenumber").alias("counter"))


@query("agg_accumulator_set", "SELECT DISTINCT p_name AS info FROM part")
def agg_accumulator_set(t):
    return t.part.select(F.col("p_name").alias("info")).distinct()


@query("distinct", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct(t):
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query("drop_duplicates", """
    SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1""")
def drop_duplicates(t):
    return keep_one(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def _log_state(batch: pd.DataFrame) -> pd.DataFrame:
    logs = batch.assign(log_sum=np.log(batch["l_quantity"]))
    return logs.groupby("l_suppkey", as_index=False, dropna=False).agg(
        log_sum=("log_sum", "sum"), n=("log_sum", "count")
    )


@query("udaf_custom", """
    SELECT l_suppkey, round(exp(sum(ln(l_quantity)) / count(l_quantity)), 6) AS geo_mean FROM lineitem GROUP BY l_suppkey""")
def udaf_custom(t):
    """Geometric mean as a user-defined aggregate with partial states."""
    return combine_by_key(
        t.lineitem.select("l_suppkey", "l_quantity"), "l_suppkey", _log_state,
        "l_suppkey bigint, log_sum double, n bigint",
        merge={"log_sum": F.sum("log_sum"), "n": F.sum("n")},
        finish={"geo_mean": F.round(F.exp(F.col("log_sum") / F.col("n")), 6)},
    )
