"""Window functions that keep working when one group holds a large share of the rows.

Groups of ordinary size use Spark's window functions; a group of more than
``hot_rows`` rows is cut into slices, see ``larkspar.plans.ordered``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspar.plans.ordered import (
    HOT_ROWS,
    by_group_size,
    join_same,
    numbered,
    peer_totals,
    running,
    sliced_running,
)

__all__ = ["numbered", "running", "ranks", "running_over_peers", "end_values", "shifted"]


def ranks(df: DataFrame, keys: list[str], by: list[str], order: list[Column], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``rank`` (gaps after ties) and ``dense_rank`` (no gaps)."""
    w = Window.partitionBy(*keys).orderBy(*order)

    def whole(part: DataFrame) -> DataFrame:
        return part.select(
            "*", F.rank().over(w).cast("long").alias("rank"), F.dense_rank().over(w).cast("long").alias("dense_rank")
        )

    def sliced(part: DataFrame) -> DataFrame:
        peers = peer_totals(part, keys, by, order).drop("running_sum")
        return join_same(part, peers, [*keys, *by], "inner")

    return by_group_size(df, keys, hot_rows, whole, sliced)


def running_over_peers(
    df: DataFrame, keys: list[str], by: list[str], order: list[Column], value: Column, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add ``running_sum`` under the default frame: tied rows share the total up to their last peer."""
    w = Window.partitionBy(*keys).orderBy(*order)

    def sliced(part: DataFrame) -> DataFrame:
        peers = peer_totals(part, keys, by, order, value).drop("rank", "dense_rank")
        return join_same(part, peers, [*keys, *by], "inner")

    return by_group_size(
        df, keys, hot_rows, lambda part: part.select("*", F.sum(value).over(w).alias("running_sum")), sliced
    )


def end_values(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """Add ``first_value`` and ``last_value`` of the whole group in ascending ``order``.

    The ends are aggregates, combined before the shuffle, so the size of a group does not matter.
    """
    at = F.struct(*order)
    ends = df.groupBy(*keys).agg(
        F.min_by(value, at).alias("first_value"), F.max_by(value, at).alias("last_value")
    )
    return join_same(df, ends, keys, "inner")


def shifted(
    df: DataFrame, keys: list[str], order: list[Column], value: str, steps: int, name: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add the ``value`` of the row ``steps`` earlier in the group (later if negative), else null."""
    w = Window.partitionBy(*keys).orderBy(*order)

    def sliced(part: DataFrame) -> DataFrame:
        rows = sliced_running(part, keys, order, {"_rn": F.lit(1).cast("long")})
        source = rows.select(*keys, (F.col("_rn") + steps).alias("_rn"), F.col(value).alias(name))
        return join_same(rows, source, [*keys, "_rn"], "left").drop("_rn")

    return by_group_size(
        df, keys, hot_rows, lambda part: part.select("*", F.lag(value, steps).over(w).alias(name)), sliced
    )
