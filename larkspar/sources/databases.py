"""Database tables over JDBC, read and written in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

URL_SETTING = "spark.larkspar.jdbc.url"
IN_PROCESS = "jdbc:derby:memory:larkspar;create=true"


def database_url(spark: SparkSession) -> str:
    """The database named by ``spark.larkspar.jdbc.url``.

    In local mode, where executors live in the driver process, an in-process
    database stands in; on a cluster, ``local-cluster`` too, other processes could not see it.
    """
    url = spark.conf.get(URL_SETTING, None)
    if url:
        return url
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise RuntimeError(f"set {URL_SETTING} to a database all executors reach")
    return IN_PROCESS


def read_table(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """Read a table, or a subquery given as ``(select ...) name``, which the database filters."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def read_partitioned(
    spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, partitions: int
) -> DataFrame:
    """Parallel read by ranges of a numeric column.

    The bounds only set the range width: rows outside them belong to the first and
    the last partition.
    """
    return read_table(
        spark, url, table, partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=partitions
    )


def read_parallel(
    spark: SparkSession, url: str, table: str, column: str, partitions: int | None = None, fetchsize: int = 10_000, **options
) -> DataFrame:
    """A table or a subquery ``(select ...) name`` in ``partitions`` ranges of a numeric column between its ends.

    The ends are asked from the database. Rows without a value of ``column`` are in the first range.
    """
    partitions = partitions or spark.sparkContext.defaultParallelism
    ends = read_table(
        spark, url, f'(SELECT MIN("{column}") AS first_value, MAX("{column}") AS last_value FROM {table}) ends', **options
    ).first()
    if ends is None or ends[0] is None:
        return read_table(spark, url, table, fetchsize=fetchsize, **options)
    return read_table(
        spark, url, table, partitionColumn=column, lowerBound=int(ends[0]), upperBound=int(ends[1]) + 1,
        numPartitions=partitions, fetchsize=fetchsize, **options,
    )


def write_table(df: DataFrame, url: str, table: str, mode: str = "overwrite", **options) -> None:
    """Write with one connection, batched inserts and one transaction per partition."""
    settings = {"batchsize": 5000, **options}
    df.write.format("jdbc").options(url=url, dbtable=table, **settings).mode(mode).save()


def delete_batch(spark: SparkSession, url: str, table: str, column: str, batch_id: int, **options) -> None:
    """Remove what an earlier attempt of a micro-batch left in the table; ``options`` are those of the connection."""
    jvm = spark.sparkContext._jvm
    properties = jvm.java.util.Properties()
    for name, value in options.items():
        properties.setProperty(name, str(value))
    connection = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        names = connection.getMetaData().getTables(None, None, table, None)
        if names.next():
            statement = connection.prepareStatement(f'DELETE FROM {table} WHERE "{column}" = ?')
            statement.setLong(1, batch_id)
            statement.executeUpdate()
            statement.close()
    finally:
        connection.close()
