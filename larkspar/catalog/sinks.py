"""Batch sinks: write, read back, return what is there."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from larkspar.catalog.registry import query
from larkspar.catalog.sources import SUPPLIER_CATALOG, unique
from larkspar.plans.ordered import numbered
from larkspar.sources import cells, keyvalue
from larkspar.sources.catalog_tables import create_partitioned_text, insert_into, save_bucketed
from larkspar.sources.databases import database_url, read_parallel, write_table
from larkspar.sources.files import write_report


@query("sink_json", "SELECT * FROM part")
def sink_json(t):
    path = t.folder("json")
    t.part.write.mode("overwrite").option("encoding", "UTF-8").format("json").save(path)
    return t.spark.read.schema(t.part.schema).json(path)


@query("sink_single_file", """
    SELECT l_returnflag, l_linestatus, count(*) AS n, 1 AS n_files FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def sink_single_file(t):
    """A combined report goes to one file; the rows behind it never pass through one task."""
    path = t.folder("report")
    write_report(t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n")), path)
    rows = t.spark.read.schema("l_returnflag string, l_linestatus string, n bigint").json(path)
    files = rows.select(F.input_file_name().alias("f")).distinct().count()
    return rows.withColumn("n_files", F.lit(files))


@query("sink_csv_partitioned", """
    SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus FROM orders""")
def sink_csv_partitioned(t):
    """Partition columns become folders; a rebalance splits large and merges small partitions."""
    path = t.folder("csv-by-year")
    rows = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), "o_orderstatus")
    rows.hint("rebalance", "year", "o_orderstatus").write.mode("overwrite").partitionBy("year", "o_orderstatus").csv(path)
    stored = "o_orderkey bigint, o_totalprice double, year int, o_orderstatus string"
    return t.spark.read.schema(stored).csv(path)


@query("sink_text", "SELECT o_orderkey || ',' || o_orderstatus AS value FROM orders")
def sink_text(t):
    path = t.folder("text")
    t.orders.select(F.concat_ws(",", "o_orderkey", "o_orderstatus").alias("value")).write.text(path)
    return t.spark.read.text(path)


MODES_SQL = """
    SELECT 'overwrite' AS mode, count(*) AS n FROM customer WHERE c_acctbal > 5000
    UNION ALL SELECT 'append', (SELECT count(*) FROM customer) + (SELECT count(*) FROM customer WHERE c_acctbal > 5000)
    UNION ALL SELECT 'ignore', count(*) FROM customer
    UNION ALL SELECT 'error', count(*) FROM customer"""


def _counts(t, frames):
    result = None
    for mode, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(mode).alias("mode"), "n")
        result = one if result is None else result.unionByName(one)
    return result


def _second_write(write, mode) -> None:
    """Run a write on an existing target; only ``error`` may refuse it."""
    try:
        write()
    except AnalysisException:
        if mode != "error":
            raise
    else:
        if mode == "error":
            raise AssertionError("an existing target was written to")


@query("sink_modes", MODES_SQL)
def sink_modes(t):
    rich = t.customer.where("c_acctbal > 5000")
    frames = {}
    for mode in ("overwrite", "append", "ignore", "error"):
        path = t.folder(f"mode-{mode}")
        t.customer.write.parquet(path)
        _second_write(lambda: rich.write.mode(mode).parquet(path), mode)
        frames[mode] = t.spark.read.parquet(path)
    return _counts(t, frames)


@query("sink_table_modes", MODES_SQL)
def sink_table_modes(t):
    """As for paths, on tables; an append matches columns by name."""
    rich = t.customer.where("c_acctbal > 5000").select(*reversed(t.customer.columns))
    frames = {}
    for mode in ("overwrite", "append", "ignore", "error"):
        table, path = unique(f"mode_{mode}"), t.folder(f"table-{mode}")
        t.customer.write.option("path", path).saveAsTable(table)
        _second_write(lambda: rich.write.mode(mode).option("path", path).saveAsTable(table), mode)
        frames[mode] = t.spark.table(table)
    return _counts(t, frames)


@query("sink_table_bucketed", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def sink_table_bucketed(t):
    table = unique("orders_bucketed")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    save_bucketed(orders, table, t.folder("bucketed"), "o_orderstatus", "o_orderkey", buckets=12)
    return t.spark.table(table)


@query("ddl_partitioned_table", """
    SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS price, strftime(o_orderdate, '%Y-%m') AS dt
    FROM orders""")
def ddl_partitioned_table(t):
    table = unique("orders_text")
    create_partitioned_text(t.spark, table, "o_orderkey BIGINT, price DECIMAL(12,2)", "dt", t.folder("ddl"))
    rows = t.orders.select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        F.date_format("o_orderdate", "yyyy-MM").alias("dt"),
    )
    insert_into(rows.hint("rebalance", "dt"), table)
    return t.spark.table(table).withColumn("price", F.col("price").cast("double"))


@query("sink_insert_into", """
    SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000
    UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000""")
def sink_insert_into(t):
    """Load all statuses, replace one partition, append to another."""
    table = unique("orders_by_status")
    t.spark.sql(
        f"CREATE TABLE {table} (o_orderkey BIGINT, o_totalprice DOUBLE, o_orderstatus STRING) USING parquet "
        f"PARTITIONED BY (o_orderstatus) LOCATION '{t.folder('insert')}'"
    )
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus").hint("rebalance", "o_orderstatus")
    insert_into(rows, table)
    insert_into(rows.where("o_orderstatus = 'F' AND o_totalprice > 250000"), table, overwrite=True)
    insert_into(rows.where("o_orderstatus = 'P' AND o_totalprice > 400000"), table)
    return t.spark.table(table)


@query("sink_jdbc", "SELECT s_suppkey, s_acctbal FROM supplier WHERE s_acctbal > 0")
def sink_jdbc(t):
    url, table = database_url(t.spark), unique("SUPPLIERS").upper()
    rows = t.supplier.select("s_suppkey", "s_acctbal")
    write_table(rows, url, table)
    write_table(rows.where("s_acctbal > 0"), url, table, mode="overwrite", batchsize=1000)
    return read_parallel(t.spark, url, table, "s_suppkey")


@query("sink_kv_list", """
    SELECT 'priorities' AS key, CAST(pos AS VARCHAR) AS field, o_orderpriority AS value FROM (
      SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) AS pos
      FROM (SELECT DISTINCT o_orderpriority FROM orders))""")
def sink_kv_list(t):
    names = numbered(t.orders.select("o_orderpriority").distinct(), [], [F.asc("o_orderpriority")], "pos")
    path = t.folder("kv-list")
    names.select(*keyvalue.entry(F.lit("priorities"), "list", F.col("pos"), F.col("o_orderpriority"))).write.parquet(path)
    return t.spark.read.parquet(path).drop("kind")


@query("sink_kv_hash", "SELECT 'names' AS key, CAST(c_custkey AS VARCHAR) AS field, c_name AS value FROM customer")
def sink_kv_hash(t):
    path = t.folder("kv-pairs")
    t.customer.select(*keyvalue.entry(F.lit("names"), "hash", F.col("c_custkey"), F.col("c_name"))).write.parquet(path)
    return t.spark.read.parquet(path).drop("kind")


@query("sink_kv_table", """
    SELECT 'customer:' || c_custkey AS key, 'c_acctbal' AS field, CAST(c_acctbal AS VARCHAR) AS value, true AS random_keys
    FROM customer
    UNION ALL SELECT 'customer:' || c_custkey, 'c_name', c_name, true FROM customer""")
def sink_kv_table(t):
    """Hashes under a key column, and under random keys when there is none."""
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    keyed, random = t.folder("kv-table"), t.folder("kv-random")
    keyvalue.to_hashes(rows, "customer", "c_custkey").write.mode("overwrite").parquet(keyed)
    keyvalue.to_hashes(rows, "customer").write.mode("overwrite").parquet(random)
    different = t.spark.read.parquet(random).agg(F.countDistinct("key")).first()[0]
    return t.spark.read.parquet(keyed).drop("kind").withColumn("random_keys", F.lit(different == rows.count()))


@query("sink_kv_insert", """
    SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN c_acctbal + 100 ELSE c_acctbal END AS balance,
           CASE WHEN c_acctbal > 5000 THEN 2 ELSE 1 END AS written FROM customer""")
def sink_kv_insert(t):
    """Insert over existing keys: the last write of a key stays."""
    first = t.customer.select("c_custkey", F.col("c_acctbal").alias("balance"), F.lit(1).alias("written"))
    second = first.where("balance > 5000").select(
        "c_custkey", (F.col("balance") + 100).alias("balance"), F.lit(2).alias("written")
    )
    path = t.folder("kv-upsert")
    keyvalue.upsert(first, second, ["c_custkey"], "written").write.parquet(path)
    return t.spark.read.parquet(path)


@query("sink_cells", """
    SELECT CAST(s_suppkey AS VARCHAR) AS row_key, 'info' AS family, 'name' AS qualifier, s_name AS value FROM supplier
    UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'info', 'nation', CAST(s_nationkey AS VARCHAR) FROM supplier
    UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'money', 'balance', CAST(s_acctbal AS VARCHAR) FROM supplier""")
def sink_cells(t):
    """Comma-separated rows split and written as cells; a second create is ignored."""
    lines = t.supplier.select(F.concat_ws(",", "s_suppkey", "s_name", "s_nationkey", "s_acctbal").alias("line"))
    parts = F.split("line", ",")
    names = ("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    table = cells.to_cells(lines.select(*[parts[i].alias(n) for i, n in enumerate(names)]), SUPPLIER_CATALOG)
    path = t.folder("cells")
    cells.create_if_absent(table, path)
    cells.create_if_absent(table, path)
    return t.spark.read.parquet(path).select("row_key", "family", "qualifier", "value")
