"""Batch sources: every key writes driver tables in the source's format and reads them back."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from larkspar.catalog.registry import query
from larkspar.plans.ordered import numbered
from larkspar.plans.sizing import broadcast_if_small
from larkspar.sources import cells, keyvalue
from larkspar.sources.databases import database_url, read_parallel, read_partitioned, write_table
from larkspar.sources.files import read_libsvm, text_records


def unique(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


SEGMENTS = [("AUTOMOBILE", 1), ("BUILDING", 2), ("FURNITURE", 3), ("HOUSEHOLD", 4), ("MACHINERY", 5)]


@query("src_collection", """
    SELECT c_custkey, weight, c_acctbal * weight AS weighted FROM customer
    JOIN (VALUES ('AUTOMOBILE', 1), ('BUILDING', 2), ('FURNITURE', 3), ('HOUSEHOLD', 4), ('MACHINERY', 5)) w(segment, weight)
      ON c_mktsegment = segment""")
def src_collection(t):
    """In-memory rows as a DataFrame, used as weights for all customers."""
    weights = t.spark.createDataFrame(SEGMENTS, "segment string, weight int")
    return t.customer.join(broadcast_if_small(weights), F.col("c_mktsegment") == F.col("segment")).select(
        "c_custkey", "weight", (F.col("c_acctbal") * F.col("weight")).alias("weighted")
    )


@query("src_range", """
    SELECT id, o_orderkey IS NOT NULL AS used
    FROM (SELECT unnest(range(0, (SELECT max(o_orderkey) + 10 FROM orders))) AS id) LEFT JOIN orders ON id = o_orderkey""")
def src_range(t):
    """All ids up to past the largest order, with whether an order has it."""
    end = t.orders.agg(F.max("o_orderkey")).first()[0] + 10
    used = t.orders.select("o_orderkey")
    return t.spark.range(0, end).join(used, F.col("id") == F.col("o_orderkey"), "left").select(
        "id", F.col("o_orderkey").isNotNull().alias("used")
    )


@query("src_text", "SELECT c_name AS value FROM customer")
def src_text(t):
    path = t.folder("text")
    t.customer.select("c_name").write.text(path)
    return t.spark.read.text(path)


@query("src_csv_header", """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
           CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""")
def src_csv_header(t):
    path = t.folder("csv")
    t.customer.write.option("header", True).csv(path)
    return t.spark.read.option("header", True).csv(path)


@query("src_csv_schema", "SELECT * FROM supplier")
def src_csv_schema(t):
    path = t.folder("tsv")
    t.supplier.write.option("sep", "\t").csv(path)
    return t.spark.read.schema(t.supplier.schema).option("delimiter", "\t").csv(path)


@query("src_json_lines", "SELECT * FROM orders")
def src_json_lines(t):
    """Schema found by reading the data; dates come back as text and are cast."""
    path = t.folder("json")
    t.orders.write.json(path)
    return t.spark.read.json(path).withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")).select(
        *t.orders.columns
    )


@query("src_json_strings", """
    SELECT event_id AS id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def src_json_strings(t):
    """JSON texts with nested objects become structs without a given schema."""
    path = t.folder("json-strings")
    text = F.concat(F.lit('{"id":'), F.col("event_id"), F.lit(',"body":'), F.col("props"), F.lit("}"))
    t.events.select(text.alias("value")).write.text(path)
    return t.spark.read.json(path).select("id", "body.k")


@query("src_json_typed", """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(CAST(json_extract(props, '$.k') AS DOUBLE) AS VARCHAR) END AS k,
           CASE WHEN event_type = 'error' THEN '{' || props END AS malformed FROM events""")
def src_json_typed(t):
    """Typed text records; the messages of error events are broken on purpose."""
    broken = F.when(F.col("event_type") == "error", F.concat(F.lit("{"), "props")).otherwise(F.col("props"))
    return text_records(t.events.select("event_id", broken.alias("line")), "line", {"k": "double"})


@query("src_libsvm", """
    SELECT label, dim, count(*) AS n, round(sum(x), 6) AS total FROM (
      SELECT CAST(label AS DOUBLE) AS label, unnest(range(0, len(embedding))) AS dim,
             CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
    GROUP BY label, dim""")
def src_libsvm(t):
    path = t.folder("libsvm")
    vector = array_to_vector(F.col("embedding").cast("array<double>"))
    t.embeddings.select(F.col("label").cast("double").alias("label"), vector.alias("features")).write.format(
        "libsvm"
    ).save(path)
    width = t.embeddings.agg(F.max(F.size("embedding"))).first()[0]
    rows = read_libsvm(t.spark, path, width).select("label", F.posexplode(vector_to_array("features")).alias("dim", "x"))
    return rows.groupBy("label", F.col("dim").cast("long").alias("dim")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("x"), 6).alias("total")
    )


def customers_in_database(t) -> tuple[str, str]:
    url, table = database_url(t.spark), unique("CUSTOMERS").upper()
    columns = t.customer.select("c_custkey", "c_name", "c_acctbal")
    write_table(columns, url, table, createTableColumnTypes="c_name VARCHAR(64)")
    return url, table


@query("src_jdbc_table", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def src_jdbc_table(t):
    url, table = customers_in_database(t)
    return read_parallel(t.spark, url, table, "c_custkey")


@query("src_jdbc_subquery", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 5000")
def src_jdbc_subquery(t):
    url, table = customers_in_database(t)
    rich = f'(SELECT "c_custkey", "c_name" FROM {table} WHERE "c_acctbal" > 5000) rich'
    return read_parallel(t.spark, url, rich, "c_custkey")


@query("src_jdbc_partitioned", "SELECT c_custkey, c_name, c_acctbal, 10 AS n_partitions FROM customer")
def src_jdbc_partitioned(t):
    """Bounds a tenth narrower than the keys on both sides: no row is lost."""
    url, table = customers_in_database(t)
    last = t.customer.agg(F.max("c_custkey")).first()[0]
    rows = read_partitioned(t.spark, url, table, "c_custkey", last // 10, last - last // 10, 10)
    return rows.withColumn("n_partitions", F.lit(rows.rdd.getNumPartitions()))


@query("src_hive_table", "SELECT s_suppkey, s_name, CASE WHEN s_acctbal > 0 THEN 'sql' ELSE 'table' END AS way FROM supplier")
def src_hive_table(t):
    """A catalog table read by name and by SQL."""
    name = unique("suppliers")
    t.supplier.write.option("path", t.folder("table")).saveAsTable(name)
    by_sql = t.spark.sql(f"SELECT s_suppkey, s_name, 'sql' AS way FROM {name} WHERE s_acctbal > 0")
    by_name = t.spark.table(name).where("s_acctbal <= 0").select("s_suppkey", "s_name", F.lit("table").alias("way"))
    return by_sql.unionByName(by_name)


@query("src_temp_view", """
    SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def src_temp_view(t):
    t.customer.createOrReplaceTempView("larkspar_customer")
    t.nation.createOrReplaceTempView("larkspar_nation")
    return t.spark.sql("""
        SELECT n_name, count(*) AS n FROM larkspar_customer JOIN larkspar_nation ON c_nationkey = n_nationkey
        GROUP BY n_name""")


def customer_store(t):
    """Customers as hashes, their orders as lists, segments per nation as sets, totals as strings."""
    hashes = keyvalue.to_hashes(t.customer.select("c_custkey", "c_name", "c_mktsegment"), "customer", "c_custkey")
    placed = numbered(t.orders.select("o_custkey", "o_orderkey"), ["o_custkey"], [F.asc("o_orderkey")], "at")
    lists = placed.select(*keyvalue.entry(
        F.concat(F.lit("customer:"), F.col("o_custkey"), F.lit(":orders")), "list", F.col("at"), F.col("o_orderkey")
    ))
    sets = t.customer.select(*keyvalue.entry(
        F.concat(F.lit("nation:"), F.col("c_nationkey"), F.lit(":segments")), "set", F.lit(None), F.col("c_mktsegment")
    )).distinct()
    strings = t.customer.groupBy("c_mktsegment").count().select(*keyvalue.entry(
        F.concat(F.lit("segment:"), F.col("c_mktsegment")), "string", F.lit(None), F.col("count")
    ))
    return hashes.unionByName(lists).unionByName(sets).unionByName(strings)


@query("src_kv_scan", """
    SELECT * FROM (
      SELECT 'customer:' || c_custkey AS key, 'hash' AS kind, 'c_mktsegment' AS field, c_mktsegment AS value FROM customer
      UNION ALL SELECT 'customer:' || c_custkey, 'hash', 'c_name', c_name FROM customer
      UNION ALL SELECT 'customer:' || o_custkey || ':orders', 'list', CAST(row_number() OVER (
        PARTITION BY o_custkey ORDER BY o_orderkey) AS VARCHAR), CAST(o_orderkey AS VARCHAR) FROM orders
      UNION ALL SELECT DISTINCT 'nation:' || c_nationkey || ':segments', 'set', NULL, c_mktsegment FROM customer
      UNION ALL SELECT 'segment:' || c_mktsegment, 'string', NULL, CAST(count(*) AS VARCHAR) FROM customer GROUP BY ALL)
    WHERE key GLOB 'customer:*' OR key GLOB 'nation:[0-9]:segments' OR key IN ('segment:BUILDING', 'segment:MACHINERY')""")
def src_kv_scan(t):
    path = t.folder("kv")
    customer_store(t).write.partitionBy("kind").parquet(path)
    store = t.spark.read.parquet(path).select(*keyvalue.COLUMNS)
    by_glob = keyvalue.keys_like(store, "customer:*").unionByName(
        keyvalue.keys_like(keyvalue.of_kind(store, "set"), "nation:[0-9]:segments")
    )
    return by_glob.unionByName(keyvalue.keys_in(store, ["segment:BUILDING", "segment:MACHINERY"]))


@query("src_kv_hash_table", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def src_kv_hash_table(t):
    wanted = t.customer.select("c_custkey", "c_name", "c_acctbal")
    path = t.folder("kv-hash")
    keyvalue.to_hashes(wanted, "customer", "c_custkey").write.parquet(path)
    return keyvalue.from_hashes(t.spark.read.parquet(path), "customer", "c_custkey", wanted.schema)


SUPPLIER_CATALOG = """{
    "table": {"namespace": "default", "name": "supplier"},
    "rowkey": "s_suppkey",
    "columns": {
        "s_suppkey": {"cf": "rowkey", "col": "id", "type": "long"},
        "s_name": {"cf": "info", "col": "name", "type": "string"},
        "s_nationkey": {"cf": "info", "col": "nation", "type": "int"},
        "s_acctbal": {"cf": "money", "col": "balance", "type": "double"}}}"""


def supplier_cells(t):
    path = t.folder("cells")
    cells.create_if_absent(cells.to_cells(t.supplier, SUPPLIER_CATALOG), path)
    return t.spark.read.parquet(path)


@query("src_cells_scan", "SELECT CAST(s_suppkey AS VARCHAR) AS row_key, s_name AS value FROM supplier")
def src_cells_scan(t):
    return cells.scan_column(supplier_cells(t), "info", "name")


@query("src_cells_catalog", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def src_cells_catalog(t):
    return cells.from_cells(supplier_cells(t), SUPPLIER_CATALOG)
