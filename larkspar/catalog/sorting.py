"""Sorts, limits, samples, splits, set operations, partitioning and persistence."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from larkspar.catalog.registry import query
from larkspar.operators.projections import partition_sizes
from larkspar.operators.sampling import take_sample as draw
from larkspar.plans.ordered import numbered
from larkspar.plans.sizing import broadcast_if_small
from larkspar.session import cut_lineage


@query("sort_by", "SELECT o_orderkey, o_totalprice FROM orders")
def sort_by(t):
    """The unique key ends the sort, so equal prices can still be split over ranges."""
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), F.desc("o_orderkey"))


@query("order_by", """
    SELECT s_suppkey, s_nationkey, s_acctbal,
           row_number() OVER (ORDER BY s_nationkey ASC, s_acctbal DESC, s_suppkey) AS position FROM supplier""")
def order_by(t):
    """Sorted by range slices in partition order; the position proves the order."""
    order = [F.asc("s_nationkey"), F.desc("s_acctbal"), F.asc("s_suppkey")]
    return numbered(t.supplier.drop("s_name"), [], order, "position")


@query("sort_nulls_last", """
    SELECT event_id, kind, row_number() OVER (ORDER BY kind DESC NULLS LAST, event_id) AS position
    FROM (SELECT event_id, nullif(event_type, 'error') AS kind FROM events)""")
def sort_nulls_last(t):
    kinds = t.events.select("event_id", F.nullif("event_type", F.lit("error")).alias("kind"))
    return numbered(kinds, [], [F.desc_nulls_last("kind"), F.asc_nulls_last("event_id")], "position")


@query("limit", "SELECT least(count(*), 100) AS n_rows, least(count(*), 100) AS n_known FROM orders")
def limit(t):
    """Any 100 rows: so many, and all of them from the table."""
    some = cut_lineage(t.orders.select(F.col("o_orderkey").alias("some_key")).limit(100))
    known = t.orders.join(broadcast_if_small(some), F.col("o_orderkey") == F.col("some_key"), "left_semi")
    return known.agg(F.lit(some.count()).cast("long").alias("n_rows"), F.count("o_orderkey").alias("n_known"))


@query("top_k", """
    SELECT l_orderkey, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey LIMIT 25""")
def top_k(t):
    return t.lineitem.select("l_orderkey", "l_extendedprice").orderBy(F.desc("l_extendedprice"), "l_orderkey").limit(25)


@query("sample", "SELECT true AS from_source, true AS no_repeats, true AS share_fits, true AS repeats_allowed FROM region LIMIT 1")
def sample(t):
    """Properties of both kinds of sample over the whole table."""
    keys = t.orders.select("o_orderkey")
    once = keys.sample(False, 0.5, 11).withColumn("kind", F.lit("once"))
    again = keys.sample(True, 0.4, 11).withColumn("kind", F.lit("again"))
    source = keys.withColumn("kind", F.lit("source"))
    per_key = once.unionByName(again).unionByName(source).groupBy("o_orderkey").agg(
        *[F.count_if(F.col("kind") == k).alias(k) for k in ("once", "again", "source")]
    )
    share = F.sum("once") / F.sum("source")
    return per_key.agg(
        (F.min("source") == 1).alias("from_source"),
        (F.max("once") <= 1).alias("no_repeats"),
        ((share > 0.4) & (share < 0.6)).alias("share_fits"),
        (F.max("again") > 1).alias("repeats_allowed"),
    )


@query("take_sample", """
    SELECT 40 AS n_once, 40 AS n_different, 40 AS n_again, 80 AS n_known FROM region LIMIT 1""")
def take_sample(t):
    keys = t.orders.select("o_orderkey")
    once = draw(keys, 40, 5).withColumn("kind", F.lit("once"))
    again = draw(keys, 40, 5, again=True).withColumn("kind", F.lit("again"))
    drawn = cut_lineage(once.unionByName(again)).withColumnRenamed("o_orderkey", "drawn_key")
    once_key = F.when(F.col("kind") == "once", F.col("drawn_key"))
    return keys.join(broadcast_if_small(drawn), F.col("o_orderkey") == F.col("drawn_key")).agg(
        F.count(once_key).cast("int").alias("n_once"), F.countDistinct(once_key).cast("int").alias("n_different"),
        F.count_if(F.col("kind") == "again").cast("int").alias("n_again"), F.count("o_orderkey").cast("int").alias("n_known"),
    )


@query("random_split", "SELECT count(*) AS n_keys, 1 AS parts_per_key, true AS share_fits FROM orders")
def random_split(t):
    small, large = t.orders.select("o_orderkey").randomSplit([2.0, 3.0], 17)
    tagged = small.withColumn("part", F.lit(0)).unionByName(large.withColumn("part", F.lit(1)))
    per_key = tagged.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"), F.max("part").alias("part"))
    share = F.avg("part")
    return per_key.agg(
        F.count(F.lit(1)).alias("n_keys"), F.max("n").cast("int").alias("parts_per_key"),
        ((share > 0.5) & (share < 0.7)).alias("share_fits"),
    )


BUYERS_SQL = "SELECT o_custkey AS id FROM orders"
USERS_SQL = "SELECT user_id AS id FROM events"


def _buyers(t):
    return t.orders.select(F.col("o_custkey").alias("id"))


def _users(t):
    return t.events.select(F.col("user_id").alias("id"))


@query("union_all", f"{BUYERS_SQL} UNION ALL {USERS_SQL}")
def union_all(t):
    return _buyers(t).union(_users(t))


@query("intersect", f"{BUYERS_SQL} INTERSECT {USERS_SQL}")
def intersect(t):
    return _buyers(t).intersect(_users(t))


@query("except_distinct", f"{BUYERS_SQL} EXCEPT {USERS_SQL}")
def except_distinct(t):
    return _buyers(t).subtract(_users(t))


@query("coalesce", "SELECT count(*) AS n_rows, true AS halved, true AS cannot_grow FROM orders")
def coalesce(t):
    """Halve the partitions without a shuffle; asking for more than there are changes nothing."""
    n = 2 * t.orders.rdd.getNumPartitions() + 4
    spread = t.orders.select("o_orderkey").repartition(n)
    halved, grown = (spread.coalesce(m).rdd.getNumPartitions() for m in (n // 2, 2 * n))
    sizes = partition_sizes(spread.coalesce(n // 2))
    return sizes.agg(
        F.sum("n_rows").alias("n_rows"),
        ((F.count(F.lit(1)) <= n // 2) & F.lit(halved == n // 2)).alias("halved"),
        F.lit(grown == n).alias("cannot_grow"),
    )


@query("repartition", "SELECT count(*) AS n_rows, true AS as_asked, 1 AS partitions_per_key FROM orders")
def repartition(t):
    """By number the rows are dealt out evenly; by a column every key is in one partition."""
    n = 2 * t.orders.rdd.getNumPartitions() + 4
    dealt = t.orders.repartition(n)
    placed = t.orders.repartition(n, "o_orderkey").select("o_orderkey", F.spark_partition_id().alias("p"))
    per_key = placed.groupBy("o_orderkey").agg(F.countDistinct("p").alias("n_parts"), F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").alias("n_rows"), F.lit(dealt.rdd.getNumPartitions() == n).alias("as_asked"),
        F.max("n_parts").cast("int").alias("partitions_per_key"),
    )


SPENT_SQL = "SELECT o_custkey, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY o_custkey"


def _spent(t):
    return t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("spent"))


@query("persist", f"SELECT *, (SELECT count(*) FROM ({SPENT_SQL})) AS n_customers FROM ({SPENT_SQL})")
def persist(t):
    """Compute once, use twice, release; only the combined table is kept."""
    spent = _spent(t).persist(StorageLevel.MEMORY_AND_DISK)
    n_customers = spent.count()
    result = cut_lineage(spent.withColumn("n_customers", F.lit(n_customers).cast("long")))
    spent.unpersist()
    return result


@query("checkpoint", SPENT_SQL)
def checkpoint(t):
    return cut_lineage(_spent(t))
