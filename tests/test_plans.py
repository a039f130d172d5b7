"""The plans the queries must get."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from larkspar.operators.joins import lookup, outer_join
from larkspar.plans.sizing import broadcast_if_small, file_count, measured

FOLDER = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def query_plan(spark, key) -> str:
    return plan(queries()[key](spark, FOLDER))


@pytest.mark.parametrize("key, operator", [
    ("join_broadcast", "BroadcastHashJoin"), ("join_cross_filtered", "BroadcastHashJoin"),
    ("join_shuffle_hash", "ShuffledHashJoin"), ("join_sort_merge", "SortMergeJoin"),
])
def test_join_strategies(spark, key, operator):
    assert operator in query_plan(spark, key)


@pytest.mark.parametrize("key", ["join_nested_loop", "join_cross_filtered", "subtract_bag", "join_full", "cogroup"])
def test_no_products(spark, key):
    text = query_plan(spark, key)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_no_query_is_a_product_without_broadcasts(spark):
    """With automatic broadcasts off the joins become shuffle joins and never products."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for key in ("join_inner", "join_left_anti", "join_nested_loop", "join_cross_filtered", "subtract_bag", "join_full"):
            text = query_plan(spark, key)
            assert "SortMergeJoin" in text, key
            assert "CartesianProduct" not in text and "NestedLoop" not in text, key
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_filters_and_columns_reach_the_scan(spark):
    text = query_plan(spark, "filter_isin")
    assert "PushedFilters: [In(c_mktsegment" in text
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in text
    assert "ReadSchema: struct<l_returnflag:string,l_linestatus:string,l_quantity" not in query_plan(spark, "distinct")


def test_cube_expands_groups_not_rows(spark):
    """The level expansion sits above two aggregations, so it sees one row per group."""
    text = query_plan(spark, "agg_cube")
    assert text.index("Expand") < text.index("HashAggregate", text.index("Expand")) < text.index("FileScan")


def test_map_side_combine(spark):
    for key in ("agg_reduce_by_key", "agg_group_by_key", "word_count", "agg_collect_as_map"):
        assert "partial_" in query_plan(spark, key), key


def test_top_k_keeps_k_rows_per_partition(spark):
    assert "TakeOrderedAndProject" in query_plan(spark, "top_k")


def test_broadcast_only_below_the_measured_size(spark):
    small = spark.range(10).withColumnRenamed("id", "small_id")
    rows, size = measured(small)
    assert rows == 10 and size > 0
    big = spark.range(1000).withColumnRenamed("id", "big_id")
    hinted = plan(big.join(broadcast_if_small(small), F.col("big_id") == F.col("small_id")))
    assert "BroadcastHashJoin" in hinted
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = plan(big.join(broadcast_if_small(small, size - 1), F.col("big_id") == F.col("small_id")))
        assert "SortMergeJoin" in plain
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_tables_join_without_a_shuffle(spark):
    from larkspar.session import new_folder
    from larkspar.sources.catalog_tables import save_bucketed

    for name in ("bucketed_a", "bucketed_b"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        rows = spark.range(1000).withColumn("part", F.col("id") % 2)
        save_bucketed(rows, name, new_folder(spark, name), "part", "id", buckets=4)
    joined = spark.table("bucketed_a").hint("merge").join(spark.table("bucketed_b"), "id")
    assert "Exchange" not in plan(joined)
    assert joined.count() == 1000


def test_file_count_grows_with_rows():
    assert [file_count(n, 100) for n in (0, 1, 100, 101, 1000)] == [1, 1, 1, 2, 10]


def test_outer_join_reads_each_side_twice_at_most(spark, tmp_path):
    for name, rows in (("a", spark.range(200).selectExpr("id % 2 AS x", "id")), ("b", spark.range(9).selectExpr("id AS y", "id"))):
        rows.write.parquet(str(tmp_path / name))
    a, b = (spark.read.parquet(str(tmp_path / n)) for n in "ab")
    for hot_rows in (20, 1000):  # the counts are a job of their own, with one scan per side
        text = plan(outer_join(a, b, "x", "y", "full", hot_rows))
        assert text.count("FileScan parquet") == 2 and "NestedLoop" not in text


def test_global_order_moves_the_rows_once(spark):
    """One exchange of whole rows; the other one has a row per slice, and nothing is checkpointed."""
    for key in ("order_by", "sort_nulls_last"):
        text = query_plan(spark, key)
        moved = [line for line in text.splitlines() if " Exchange " in line]
        assert sum("shufflepartitionidpassthrough" in line for line in moved) == 1
        assert "rangepartitioning" not in text and "ExistingRDD" not in text
        others = [line for line in moved if "shufflepartitionidpassthrough" not in line]
        assert all("hashpartitioning" in line or "SinglePartition" in line for line in others) and len(others) <= 2
        positions = [r["position"] for r in queries()[key](spark, FOLDER).collect()]
        assert positions == list(range(1, len(positions) + 1))


def test_lookup_combines_the_table_once(spark):
    fact = spark.range(5).toDF("x")
    dim = spark.range(5).select(F.col("id").alias("y"), F.lit("a").alias("name"), F.lit(1).alias("at"))
    assert "Aggregate" not in plan(lookup(fact, dim, "x", "y", "name", "at"))  # the combined table is stored


def test_all_cores_only_for_narrow_scans(spark):
    from larkspar.plans.sizing import use_all_cores

    assert use_all_cores(spark.range(0, 10, 1, 1)).rdd.getNumPartitions() == 4
    assert "Exchange" not in plan(use_all_cores(spark.range(0, 10, 1, 6)))


@pytest.fixture
def tiny_skew_limits(spark):
    """Skew limits small enough that test data counts as skewed, and no automatic broadcasts."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def hot_orders(tiny_skew_limits):
    key = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 500 + 2)
    return tiny_skew_limits.range(0, 60_000, 1, 8).select(F.col("id").alias("order"), key.alias("cust"))


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    assert rows
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_a_hot_key_is_split_in_joins(spark, hot_orders, how):
    customers = spark.range(0, 400).select(F.col("id").alias("c"), F.uuid().alias("name"))
    joined = hot_orders.join(customers, F.col("cust") == F.col("c"), how)
    assert "skew=true" in executed(joined)


def test_outer_join_splits_a_hot_key_on_the_other_side(spark, hot_orders):
    """The built-in join has all rows of the key in one task; the salted one deals them out."""
    customers = spark.range(0, 600).select(F.col("id").alias("c"))
    plain = hot_orders.join(customers, F.col("cust") == F.col("c"), "right")
    salted = outer_join(hot_orders, customers, "cust", "c", "right", hot_rows=1000)
    largest = lambda df: df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    even = 60_000 / 4  # four partitions in tests
    assert largest(salted) < 1.4 * even < largest(plain)
    assert salted.count() == plain.count()
