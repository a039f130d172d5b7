"""Wide-column cells as a long table ``(row_key, family, qualifier, value, at)``; each write adds rows, reads take the newest."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TYPES = {"int": "int", "long": "bigint", "double": "double", "string": "string", "boolean": "boolean"}


def parse_catalog(text: str) -> tuple[str, dict[str, tuple[str, str, str]]]:
    """Row-key column and ``{column: (family, qualifier, type)}`` of a JSON catalog."""
    catalog = json.loads(text)
    columns = {n: (c["cf"], c["col"], TYPES[c["type"]]) for n, c in catalog["columns"].items()}
    row_key = next(n for n, (family, _, _) in columns.items() if family == "rowkey")
    return row_key, columns


def to_cells(df: DataFrame, catalog: str, at: Column | int = 0) -> DataFrame:
    """One row per non-null cell, values as text, written at ``at`` (any number that grows with the writes)."""
    row_key, columns = parse_catalog(catalog)
    names = [n for n in columns if n != row_key]
    when = F.lit(at) if isinstance(at, int) else at
    texts = df.select(
        F.col(row_key).cast("string").alias("row_key"), *[F.col(n).cast("string") for n in names], when.cast("long").alias("at")
    )
    long = texts.unpivot(["row_key", "at"], names, "_name", "value").where(F.col("value").isNotNull())
    family = F.coalesce(*[F.when(F.col("_name") == n, columns[n][0]) for n in names])
    qualifier = F.coalesce(*[F.when(F.col("_name") == n, columns[n][1]) for n in names])
    return long.select("row_key", family.alias("family"), qualifier.alias("qualifier"), "value", "at")


def delete_markers(keys: DataFrame, row_key: str, at: int, family: str | None = None, qualifier: str | None = None) -> DataFrame:
    """Cells without a value, which delete what is as old as they are or older: a cell, a family, or the whole row."""
    if family is None and qualifier is not None:
        raise ValueError("a qualifier belongs to a family")
    return keys.select(
        F.col(row_key).cast("string").alias("row_key"), F.lit(family).cast("string").alias("family"),
        F.lit(qualifier).cast("string").alias("qualifier"), F.lit(None).cast("string").alias("value"),
        F.lit(at).cast("long").alias("at"),
    )


def _newest(family: str, qualifier: str) -> Column:
    """The value of a cell in a group of all cells of its row: the last written one, unless a marker is as new.

    Of values written at the same time the greatest counts.
    """
    here = (F.col("family") == family) & (F.col("qualifier") == qualifier)
    covers = (
        F.col("family").isNull() | ((F.col("family") == family) & F.col("qualifier").isNull()) | here
    ) & F.col("value").isNull()
    written = F.max(F.when(here & F.col("value").isNotNull(), F.struct("at", "value")))
    deleted = F.max(F.when(covers, F.col("at")))
    return F.when(deleted.isNull() | (written["at"] > deleted), written["value"])


def from_cells(cells: DataFrame, catalog: str) -> DataFrame:
    """Typed wide rows described by the catalog, of the newest cells; a row without living cells is gone."""
    row_key, columns = parse_catalog(catalog)
    named = {n: c for n, c in columns.items() if n != row_key}
    wide = cells.groupBy("row_key").agg(*[_newest(f, q).alias(n) for n, (f, q, _) in named.items()])
    return wide.where(F.coalesce(*[F.col(f"`{n}`") for n in named]).isNotNull()).select(
        F.col("row_key").cast(columns[row_key][2]).alias(row_key),
        *[F.col(n).cast(kind).alias(n) for n, (_, _, kind) in named.items()],
    )


def scan_column(cells: DataFrame, family: str, qualifier: str) -> DataFrame:
    """Row keys with the newest value of one column."""
    near = F.col("family").isNull() | (
        (F.col("family") == family) & (F.col("qualifier").isNull() | (F.col("qualifier") == qualifier))
    )
    newest = cells.where(near).groupBy("row_key").agg(_newest(family, qualifier).alias("value"))
    return newest.where(F.col("value").isNotNull())


def create_if_absent(cells: DataFrame, path: str) -> None:
    cells.write.mode("ignore").partitionBy("family").parquet(path)
