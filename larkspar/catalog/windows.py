"""Ranking, first/last, lag/lead and window aggregates on large groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspar.catalog.registry import query
from larkspar.operators.windows import end_values, numbered, ranks, running, running_over_peers, shifted


def priced(t):
    return t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")


def dated(t):
    return t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice")


@query("win_row_number", """
    SELECT o_orderkey, o_orderstatus, o_totalprice, row_number() OVER (
      PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS num FROM orders""")
def win_row_number(t):
    return numbered(priced(t), ["o_orderstatus"], [F.desc("o_totalprice"), F.asc("o_orderkey")], "num")


@query("win_rank", """
    SELECT l_orderkey, l_returnflag, l_quantity, rank() OVER (
      PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS rank FROM lineitem""")
def win_rank(t):
    lines = t.lineitem.select("l_orderkey", "l_returnflag", "l_quantity")
    return ranks(lines, ["l_returnflag"], ["l_quantity"], [F.desc("l_quantity")]).drop("dense_rank")


@query("win_dense_rank", """
    SELECT l_orderkey, l_returnflag, l_quantity, dense_rank() OVER (
      PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS dense_rank FROM lineitem""")
def win_dense_rank(t):
    lines = t.lineitem.select("l_orderkey", "l_returnflag", "l_quantity")
    return ranks(lines, ["l_returnflag"], ["l_quantity"], [F.desc("l_quantity")]).drop("rank")


@query("win_first", """
    SELECT o_orderkey, o_custkey, first(o_totalprice) OVER (
      PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS first_value FROM orders""")
def win_first(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return end_values(orders, ["o_custkey"], "o_totalprice", ["o_orderdate", "o_orderkey"]).select(
        "o_orderkey", "o_custkey", "first_value"
    )


@query("win_last", """
    SELECT o_orderkey, o_custkey, last(o_totalprice) OVER (
      PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_value FROM orders""")
def win_last(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return end_values(orders, ["o_custkey"], "o_totalprice", ["o_orderdate", "o_orderkey"]).select(
        "o_orderkey", "o_custkey", "last_value"
    )


@query("win_lag", """
    SELECT o_orderkey, o_orderstatus, lag(o_totalprice, 2) OVER (
      PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS before FROM orders""")
def win_lag(t):
    order = [F.asc("o_orderdate"), F.asc("o_orderkey")]
    return shifted(dated(t), ["o_orderstatus"], order, "o_totalprice", 2, "before").select(
        "o_orderkey", "o_orderstatus", "before"
    )


@query("win_lead", """
    SELECT o_orderkey, o_orderstatus, lead(o_totalprice, 1) OVER (
      PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS after FROM orders""")
def win_lead(t):
    order = [F.asc("o_orderdate"), F.asc("o_orderkey")]
    return shifted(dated(t), ["o_orderstatus"], order, "o_totalprice", -1, "after").select(
        "o_orderkey", "o_orderstatus", "after"
    )


@query("win_agg", """
    SELECT o_orderkey, o_orderstatus,
           round(sum(o_totalprice) OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate), 2) AS range_sum,
           round(sum(o_totalprice) OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS rows_sum,
           round(sum(o_totalprice) OVER (PARTITION BY o_orderstatus), 2) AS whole_sum
    FROM orders""")
def win_agg(t):
    """The same sum under the default range frame, a row frame and the whole group."""
    keys = ["o_orderstatus"]
    by_peers = running_over_peers(dated(t), keys, ["o_orderdate"], [F.asc("o_orderdate")], F.col("o_totalprice"))
    by_rows = running(
        by_peers, keys, [F.asc("o_orderdate"), F.asc("o_orderkey")], {"rows_sum": F.col("o_totalprice")}
    )
    whole = t.orders.groupBy(*keys).agg(F.sum("o_totalprice").alias("whole_sum"))
    return by_rows.join(whole, keys).select(
        "o_orderkey", "o_orderstatus", F.round("running_sum", 2).alias("range_sum"),
        F.round("rows_sum", 2).alias("rows_sum"), F.round("whole_sum", 2).alias("whole_sum"),
    )
