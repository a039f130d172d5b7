"""Projections, row transforms and predicates on the driver tables."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from larkspar.catalog.registry import query
from larkspar.operators.projections import (
    explode_words,
    map_partitions,
    parse_lines_by_schema,
    parse_lines_by_split,
    partition_sizes,
    word_count,
)


@query("proj_select", "SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer")
def proj_select(t):
    customer = t.customer
    return customer.select("c_custkey", F.col("c_name"), F.column("c_mktsegment"), customer["c_acctbal"])


@query("proj_expr", "SELECT count(o_totalprice) AS n_price, count(DISTINCT o_orderstatus) AS n_status FROM orders")
def proj_expr(t):
    by_function = t.orders.select(F.expr("o_totalprice"), "o_orderstatus")
    return by_function.selectExpr("count(o_totalprice) AS n_price", "count(DISTINCT o_orderstatus) AS n_status")


@query("proj_with_column", """
    SELECT p_partkey, p_size * 2 AS p_size, 'part' AS kind, p_retailprice + 1 AS next_price FROM part""")
def proj_with_column(t):
    return (
        t.part.withColumn("p_size", F.col("p_size") * 2)
        .withColumn("kind", F.lit("part"))
        .withColumn("next_price", F.expr("p_retailprice + 1"))
        .select("p_partkey", "p_size", "kind", "next_price")
    )


@query("proj_rand_column", "SELECT count(*) AS n_rows, count(*) AS n_in_range FROM lineitem")
def proj_rand_column(t):
    drawn = t.lineitem.select("l_orderkey").withColumn("random", F.rand(7))
    inside = (F.col("random") >= 0) & (F.col("random") < 1)
    return drawn.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(inside).alias("n_in_range"))


@query("proj_rename", "SELECT s_suppkey AS id, s_name AS new_name, s_nationkey AS nation FROM supplier")
def proj_rename(t):
    return t.supplier.drop("s_acctbal").withColumnRenamed("s_name", "new_name").toDF("id", "new_name", "nation")


@query("proj_drop", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def proj_drop(t):
    return t.supplier.drop("s_acctbal")


@query("proj_alias", "SELECT s_suppkey, s_name AS other_name FROM supplier")
def proj_alias(t):
    return t.supplier.select("s_suppkey", F.col("s_name").alias("other_name"))


@query("proj_cast", """
    SELECT o_orderkey, CAST(o_totalprice AS VARCHAR) AS price_text,
           CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority,
           TRY_CAST(o_orderpriority AS DOUBLE) AS dirty FROM orders""")
def proj_cast(t):
    return t.orders.select(
        "o_orderkey",
        F.col("o_totalprice").cast("string").alias("price_text"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("priority"),
        F.col("o_orderpriority").try_cast("double").alias("dirty"),
    )


@query("proj_nested_field", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type AS kind FROM events""")
def proj_nested_field(t):
    body = F.struct(F.from_json("props", "k bigint").alias("props"), F.col("event_type").alias("kind"))
    return t.events.select("event_id", F.struct(body.alias("body")).alias("message")).select(
        "event_id", "message.body.props.k", F.col("message.body.kind").alias("kind")
    )


@query("map_rows", "SELECT l_orderkey, l_quantity * 10 AS tenfold, l_shipdate, 1 AS one FROM lineitem")
def map_rows(t):
    return t.lineitem.select(
        "l_orderkey", (F.col("l_quantity") * 10).alias("tenfold"), "l_shipdate", F.lit(1).alias("one")
    )


def _tenfold(batch: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [batch.column("l_orderkey"), pc.multiply(batch.column("l_quantity"), 10.0)], names=["l_orderkey", "tenfold"]
    )


@query("map_partitions", "SELECT l_orderkey, l_quantity * 10 AS tenfold FROM lineitem")
def map_partitions_query(t):
    return map_partitions(t.lineitem.select("l_orderkey", "l_quantity"), _tenfold, "l_orderkey bigint, tenfold double")


@query("map_values", "SELECT o_custkey AS k, o_totalprice * 10 AS v FROM orders")
def map_values(t):
    pairs = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("v"))
    return pairs.withColumn("v", F.col("v") * 10)


@query("map_partitions_index", "SELECT count(*) AS n_rows, true AS indexes_fit FROM lineitem")
def map_partitions_index(t):
    lines = t.lineitem.select("l_orderkey")
    index = F.col("partition_index")
    fits = (F.min(index) >= 0) & (F.max(index) < lines.rdd.getNumPartitions())
    return partition_sizes(lines).agg(F.sum("n_rows").alias("n_rows"), fits.alias("indexes_fit"))


SPLIT_SQL = """
    CASE WHEN length(text) > 0 AND rtrim(text, ' ') = '' THEN [] ELSE string_split(rtrim(text, ' '), ' ') END"""


@query("flat_map_split", f"SELECT doc_id, unnest({SPLIT_SQL}) AS word FROM documents")
def flat_map_split(t):
    return explode_words(t.texts, "text")


def _doubled(df: DataFrame) -> DataFrame:
    return df.withColumn("doubled", F.col("p_size") * 2)


@query("ds_transform", "SELECT p_partkey, p_size, p_size * 2 AS doubled FROM part")
def ds_transform(t):
    return t.part.select("p_partkey", "p_size").transform(_doubled)


@query("ds_as_type", """
    SELECT c_custkey AS id, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation FROM customer""")
def ds_as_type(t):
    person = StructType([
        StructField("id", LongType()), StructField("name", StringType()), StructField("nation", LongType()),
    ])
    renamed = t.customer.select(
        F.col("c_name").alias("name"), F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation")
    )
    return renamed.to(person)


CUSTOMER = StructType([
    StructField("c_custkey", LongType()), StructField("c_name", StringType()),
    StructField("c_nationkey", IntegerType()), StructField("c_acctbal", DoubleType()),
    StructField("c_mktsegment", StringType()),
])


@query("rdd_to_df_3ways", """
    SELECT way, customer.* FROM customer, (VALUES ('cast'), ('record'), ('reader')) w(way)""")
def rdd_to_df_3ways(t):
    path = t.folder("customer-lines")
    t.customer.select(F.concat_ws(",", *[F.col(f.name) for f in CUSTOMER.fields]).alias("value")).write.text(path)
    lines = t.spark.read.text(path)
    return (
        parse_lines_by_split(lines, CUSTOMER).withColumn("way", F.lit("cast"))
        .unionByName(parse_lines_by_schema(lines, CUSTOMER).withColumn("way", F.lit("record")))
        .unionByName(t.spark.read.schema(CUSTOMER).csv(path).withColumn("way", F.lit("reader")))
    )


@query("word_count", f"""
    SELECT word, count(*) AS n FROM (SELECT unnest({SPLIT_SQL}) AS word FROM documents) GROUP BY word""")
def word_count_query(t):
    return word_count(t.texts, "text")


@query("filter_lambda", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 30")
def filter_lambda(t):
    return t.lineitem.filter(F.col("l_quantity") > 30).select("l_orderkey", "l_quantity")


@query("filter_expr", """
    SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
    WHERE o_totalprice > 20000 AND o_orderdate >= TIMESTAMP '1997-01-01'""")
def filter_expr(t):
    return (
        t.orders.where("o_totalprice > 20000")
        .where(F.col("o_orderdate") >= F.expr("TIMESTAMP_NTZ '1997-01-01 00:00:00'"))
        .select("o_orderkey", "o_totalprice", "o_orderdate")
    )


@query("filter_not_equal", """
    SELECT o_orderkey, status FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders)
    WHERE status <> 'F'""")
def filter_not_equal(t):
    marked = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return marked.where(F.col("status") != "F")


@query("filter_bool", "SELECT event_id, event_type FROM events WHERE (value > 10) = true")
def filter_bool(t):
    flagged = t.events.select("event_id", "event_type", (F.col("value") > 10).alias("is_large"))
    return flagged.filter(F.col("is_large") == True).drop("is_large")  # noqa: E712


@query("filter_like", """
    SELECT p_partkey, p_name, CASE WHEN p_name LIKE 'blue bolt' THEN 'whole' ELSE 'pattern' END AS hit
    FROM part WHERE p_name LIKE 'blue bolt' OR p_name LIKE '%ring'""")
def filter_like(t):
    name = F.col("p_name")
    return t.part.where(name.like("blue bolt") | name.like("%ring")).select(
        "p_partkey", "p_name", F.when(name.like("blue bolt"), "whole").otherwise("pattern").alias("hit")
    )


@query("filter_isin", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def filter_isin(t):
    return t.customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", "c_mktsegment")


@query("filter_is_null", """
    SELECT l.doc_id, l.quality FROM labels l LEFT JOIN
      (SELECT doc_id, text FROM documents WHERE n_chars > 500) d ON l.doc_id = d.doc_id WHERE d.doc_id IS NULL""")
def filter_is_null(t):
    long_texts = t.documents.where("n_chars > 500").select(F.col("doc_id").alias("d_id"))
    joined = t.labels.join(long_texts, F.col("doc_id") == F.col("d_id"), "left")
    return joined.where(F.col("d_id").isNull()).select("doc_id", "quality")
