"""Scalar functions and user-defined functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspar.catalog.projections import SPLIT_SQL
from larkspar.catalog.registry import query
from larkspar.functions.text import numbers
from larkspar.functions.udfs import SpacedWords, dollars


@query("fn_split", """
    SELECT o_orderkey, string_split(o_orderpriority, '-')[1] AS code, string_split(o_orderpriority, '-')[2] AS name
    FROM orders""")
def fn_split(t):
    parts = F.split("o_orderpriority", "-")
    return t.orders.select("o_orderkey", parts[0].alias("code"), parts[1].alias("name"))


@query("fn_arith", "SELECT p_partkey, p_size * 2 AS double_size, p_retailprice * 10 AS tenfold FROM part")
def fn_arith(t):
    return t.part.select(
        "p_partkey", (F.col("p_size") * 2).alias("double_size"), (F.col("p_retailprice") * 10).alias("tenfold")
    )


@query("fn_date_prefix", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS dt FROM orders")
def fn_date_prefix(t):
    return t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("dt"))


@query("fn_from_json", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, ts AS at FROM events""")
def fn_from_json(t):
    """Nested message text parsed with an explicit schema and timestamp format."""
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    message = F.to_json(F.struct(F.struct(stamp.alias("at"), F.from_json("props", "k bigint").alias("props")).alias("body")))
    parsed = F.from_json(
        message, "body struct<at timestamp, props struct<k bigint>>", {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    )
    return t.events.select("event_id", parsed.alias("m")).select(
        "event_id", "m.body.props.k", F.col("m.body.at").cast("timestamp_ntz").alias("at")
    )


@query("fn_parse_numbers", """
    SELECT l_orderkey, l_quantity AS a, l_extendedprice AS b, l_discount AS c FROM lineitem""")
def fn_parse_numbers(t):
    line = F.concat_ws(" ", "l_quantity", "l_extendedprice", "l_discount")
    parsed = t.lineitem.select("l_orderkey", numbers(line).alias("x"))
    return parsed.select("l_orderkey", *[F.col("x")[i].alias(n) for i, n in enumerate("abc")])


DOLLAR_SQL = "SELECT l_orderkey, '$' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS amount FROM lineitem"


@query("udf_column", DOLLAR_SQL)
def udf_column(t):
    return t.lineitem.select("l_orderkey", dollars(F.col("l_quantity").cast("long")).alias("amount"))


@query("udf_sql", DOLLAR_SQL)
def udf_sql(t):
    t.spark.udf.register("to_dollars", dollars)
    return t.spark.sql(
        "SELECT l_orderkey, to_dollars(CAST(l_quantity AS BIGINT)) AS amount FROM {lines}", lines=t.lineitem
    )


@query("udtf_flat_map", f"""
    SELECT doc_id, count(*) AS n_words, CAST(sum(length(word)) AS BIGINT) AS n_letters
    FROM (SELECT doc_id, unnest({SPLIT_SQL}) AS word FROM documents) GROUP BY doc_id""")
def udtf_flat_map(t):
    t.spark.udtf.register("spaced_words", SpacedWords)
    words = t.spark.sql(
        "SELECT d.doc_id, w.word FROM {docs} d, LATERAL spaced_words(d.text) w", docs=t.texts
    )
    return words.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_words"), F.sum(F.length("word")).alias("n_letters")
    )
