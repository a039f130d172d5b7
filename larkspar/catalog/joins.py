"""Every join kind of the inventory on orders, customers, nations and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspar.catalog.registry import query
from larkspar.operators.joins import bag_subtract, band_join, cogroup_bags, lookup, outer_join
from larkspar.plans.sizing import broadcast_if_small

RICH_SQL = "(SELECT * FROM customer WHERE c_acctbal > 5000)"
BIG_SQL = "(SELECT * FROM orders WHERE o_totalprice > 400000)"


def rich(t):
    return t.customer.where("c_acctbal > 5000")


def big(t):
    return t.orders.where("o_totalprice > 400000")


@query("join_inner", """
    SELECT o_orderkey, o_totalprice, c_name FROM orders JOIN customer ON o_custkey = c_custkey""")
def join_inner(t):
    customers = t.customer.select("c_custkey", "c_name")
    return t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "inner").select(
        "o_orderkey", "o_totalprice", "c_name"
    )


@query("join_left", f"""
    SELECT o_orderkey, o_custkey, c_name FROM orders LEFT JOIN {RICH_SQL} c ON o_custkey = c_custkey""")
def join_left(t):
    orders = t.orders.select("o_orderkey", "o_custkey")
    customers = rich(t).select("c_custkey", "c_name")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left_outer").drop("c_custkey")


@query("join_right", f"""
    SELECT c_custkey, c_name, o_orderkey FROM {BIG_SQL} o RIGHT JOIN customer ON o_custkey = c_custkey""")
def join_right(t):
    orders = big(t).select("o_orderkey", "o_custkey")
    customers = t.customer.select("c_custkey", "c_name")
    return outer_join(orders, customers, "o_custkey", "c_custkey", "right").drop("o_custkey")


@query("join_full", f"""
    SELECT o_orderkey, o_custkey, c_custkey, c_name
    FROM {BIG_SQL} o FULL JOIN {RICH_SQL} c ON o_custkey = c_custkey""")
def join_full(t):
    orders = big(t).select("o_orderkey", "o_custkey")
    customers = rich(t).select("c_custkey", "c_name")
    return outer_join(orders, customers, "o_custkey", "c_custkey", "full")


@query("join_left_semi", f"""
    SELECT c_custkey, c_name FROM customer
    WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""")
def join_left_semi(t):
    buyers = big(t).select("o_custkey").distinct()
    return t.customer.join(buyers, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


ANTI_SQL = """
    SELECT c_custkey, c_name FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)"""


@query("join_left_anti", ANTI_SQL)
def join_left_anti(t):
    buyers = big(t).select("o_custkey").distinct()
    return t.customer.join(buyers, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("join_anti_via_left", ANTI_SQL)
def join_anti_via_left(t):
    buyers = big(t).select("o_custkey").distinct()
    joined = t.customer.join(buyers, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.where(F.col("o_custkey").isNull()).select("c_custkey", "c_name")


@query("join_cross_filtered", """
    SELECT c_custkey, n_name FROM customer, nation WHERE c_nationkey = n_nationkey""")
def join_cross_filtered(t):
    """Product plus equality, as written by the user; Catalyst plans it as an equi join."""
    return t.spark.sql(
        "SELECT c_custkey, n_name FROM {customer}, {nation} WHERE c_nationkey = n_nationkey",
        customer=t.customer, nation=t.nation,
    )


@query("join_broadcast", """
    SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey""")
def join_broadcast(t):
    nations = broadcast_if_small(t.nation)
    regions = broadcast_if_small(t.region)
    return (
        t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "n_name", "r_name")
    )


LINES_SQL = """
    SELECT l_returnflag, o_orderstatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL"""


def _lines_by_status(t, strategy: str):
    orders = t.orders.select("o_orderkey", "o_orderstatus").hint(strategy)
    lines = t.lineitem.select("l_orderkey", "l_returnflag", "l_quantity")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("l_returnflag", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


@query("join_shuffle_hash", LINES_SQL)
def join_shuffle_hash(t):
    return _lines_by_status(t, "shuffle_hash")


@query("join_sort_merge", LINES_SQL)
def join_sort_merge(t):
    return _lines_by_status(t, "merge")


@query("join_nested_loop", """
    SELECT p_size, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM orders JOIN (SELECT DISTINCT p_size FROM part) p
      ON o_totalprice >= p_size * 10000 AND o_totalprice < p_size * 10000 + 10000
    GROUP BY p_size""")
def join_nested_loop(t):
    """Theta join: orders in the price band that each part size stands for."""
    bands = t.part.select("p_size").distinct().select(
        "p_size", (F.col("p_size") * 10000.0).alias("low"), (F.col("p_size") * 10000.0 + 10000).alias("high")
    )
    hits = band_join(t.orders.select("o_totalprice"), bands, "o_totalprice", "low", "high", 10000.0)
    return hits.groupBy("p_size").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("join_map_side_lookup", """
    SELECT s_suppkey, s_name, part_name FROM supplier JOIN (
      SELECT p_size, arg_max(p_name, p_partkey) AS part_name FROM part GROUP BY p_size
    ) ON s_nationkey = p_size""")
def join_map_side_lookup(t):
    entries = t.part.select("p_size", "p_partkey", F.col("p_name").alias("part_name"))
    return lookup(t.supplier, entries, "s_nationkey", "p_size", "part_name", "p_partkey").select(
        "s_suppkey", "s_name", "part_name"
    )


@query("join_pairs", """
    SELECT o_custkey AS k, o_totalprice AS v, c_acctbal AS w FROM orders JOIN customer ON o_custkey = c_custkey""")
def join_pairs(t):
    left = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("v"))
    right = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("w"))
    return left.join(right, on="k")


@query("cogroup", """
    SELECT k, v, count(*) FILTER (src = 'orders') AS n_orders, count(*) FILTER (src = 'events') AS n_events,
           count(*) FILTER (src = 'labels') AS n_labels
    FROM (SELECT o_custkey AS k, o_orderstatus AS v, 'orders' AS src FROM orders
          UNION ALL SELECT user_id, event_type, 'events' FROM events
          UNION ALL SELECT doc_id, CASE WHEN quality = 1 THEN 'F' ELSE 'click' END, 'labels' FROM labels)
    GROUP BY k, v""")
def cogroup(t):
    return cogroup_bags(
        "k", "v",
        orders=t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("v")),
        events=t.events.select(F.col("user_id").alias("k"), F.col("event_type").alias("v")),
        labels=t.labels.select(
            F.col("doc_id").alias("k"), F.when(F.col("quality") == 1, "F").otherwise("click").alias("v")
        ),
    )


@query("subtract_bag", """
    SELECT o_custkey, o_orderstatus FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM orders d WHERE d.o_totalprice > 400000
      AND d.o_custkey = orders.o_custkey AND d.o_orderstatus = orders.o_orderstatus)""")
def subtract_bag(t):
    pairs = t.orders.select("o_custkey", "o_orderstatus")
    return bag_subtract(pairs, big(t).select("o_custkey", "o_orderstatus"))
