"""Running totals and row numbers inside groups of any size.

A window function sorts each group in one task, which is fine until a group holds a
large share of all rows. Such groups are found by counting, and only they take the
longer way: their rows are cut into slices of (keys, order). The borders between slices come
from one bounded sample and are literals of the plan, so each row's slice is an
expression that never changes: totals per slice are a combined aggregate, and the rows move
once, each slice to a partition of its own, in order. Totals run inside each slice, and what
earlier slices of the same group add up to is carried over. At most one group per slice continues
from an earlier slice, so the carried table never has more rows than there are slices and
may be broadcast.

Inputs are evaluated more than once and must be deterministic.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from larkspar.plans.sizing import broadcast_if_small
from larkspar.session import cut_lineage

HOT_ROWS = 2_000_000
#: Sampled rows per slice from which the borders are taken.
SAMPLED = 40
_ORDERED = re.compile(r"Column<'(.+?)(?: (ASC|DESC) NULLS (FIRST|LAST))?'>", re.DOTALL)


def join_same(left: DataFrame, right: DataFrame, names: list[str], how: str) -> DataFrame:
    """Join on null-safe equality of ``names``; the result has them once, from the left."""
    renamed = right.withColumnsRenamed({n: f"_right_{n}" for n in names})
    equal = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_right_{n}")) for n in names])
    joined = left.join(renamed, equal, how)
    return joined.drop(*[f"_right_{n}" for n in names])


def by_group_size(
    df: DataFrame,
    keys: list[str],
    hot_rows: int,
    whole: Callable[[DataFrame], DataFrame],
    sliced: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """``sliced`` for groups of more than ``hot_rows`` rows, ``whole`` for all others.

    Without keys everything is one group and is sliced.
    """
    if not keys:
        return sliced(df)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    hot = cut_lineage(sizes.where(F.col("_rows") > hot_rows).select(*keys))
    if hot.isEmpty():
        return whole(df)
    hot = broadcast_if_small(hot)
    return whole(join_same(df, hot, keys, "left_anti")).unionByName(sliced(join_same(df, hot, keys, "left_semi")))


class By(NamedTuple):
    """A named column of an order."""

    name: str
    down: bool = False
    nulls_last: bool = False

    @classmethod
    def of(cls, column: Column) -> By:
        """From ``F.col(name)``, ``F.asc(name)``, ``F.desc_nulls_first(name)`` and so on."""
        name, way, nulls = _ORDERED.fullmatch(str(column)).groups()
        return cls(name, way == "DESC", nulls == "LAST")

    def beside(self, value: Any, kind: DataType) -> tuple[Column, Column]:
        """Whether a row comes before ``value``, and whether it is equal to it."""
        held = F.col(f"`{self.name}`")
        if value is None:
            return (held.isNotNull() if self.nulls_last else F.lit(False)), held.isNull()
        border = F.lit(value).cast(kind)
        before = held > border if self.down else held < border
        return F.coalesce(before, F.lit(not self.nulls_last)), held.eqNullSafe(border)


def _borders(df: DataFrame, order: list[By], columns: list[Column], slices: int) -> list[Row]:
    """At most ``slices - 1`` different rows of the order columns that cut a sample into equal parts."""
    narrow = df.select(*[F.col(f"`{b.name}`") for b in order])
    total, wanted = narrow.count(), slices * SAMPLED
    if total > wanted:
        narrow = narrow.sample(False, wanted / total, 17)
    rows = [tuple(r) for r in narrow.orderBy(*columns).collect()]
    cuts = [rows[i * len(rows) // slices] for i in range(1, slices)] if rows else []
    return list(dict.fromkeys(cuts))


def slice_number(df: DataFrame, keys: list[str], order: list[Column], slices: int) -> Column:
    """The slice of a row, from 0, as an expression over its keys and order columns: a search among literal borders."""
    by = [By(k) for k in keys] + [By.of(c) for c in order]
    unknown = [b.name for b in by if b.name not in df.columns]
    if unknown:
        raise ValueError(f"rows are ordered by named columns, not {unknown}")
    borders = _borders(df, by, [F.asc(F.col(f"`{k}`")) for k in keys] + order, slices)
    kinds = [df.schema[b.name].dataType for b in by]

    def comes_before(border: tuple) -> Column:
        result = F.lit(False)
        for b, value, kind in reversed(list(zip(by, border, kinds))):
            before, equal = b.beside(value, kind)
            result = before | (equal & result)
        return result

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(comes_before(borders[middle]), search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(borders))


def _spare(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name = f"_{name}"
    return name


def slices(df: DataFrame, keys: list[str], order: list[Column], name: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with the slice of each row as column ``name``, where it is and laid out by it, one partition per slice in order."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered_ = df.withColumn(name, slice_number(df, keys, order, parts))
    return numbered_, numbered_.repartitionById(parts, F.col(name))


def sliced_running(df: DataFrame, keys: list[str], order: list[Column], totals: dict[str, Column]) -> DataFrame:
    """Add, per name in ``totals``, the sum of its expression up to the current row, slice by slice.

    Without keys the result is in ``order`` from the first partition to the last.
    """
    at, rows_ = _spare(df, "_slice"), _spare(df, "_rows")
    place = [at, *keys]
    unmoved, laid = slices(df, keys, order, at)
    inside = Window.partitionBy(*place).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = laid.select("*", *[F.sum(e).over(inside).alias(n) for n, e in totals.items()])

    earlier = Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    per_slice = unmoved.groupBy(*place).agg(
        F.count(F.lit(1)).alias(rows_), *[F.sum(e).alias(n) for n, e in totals.items()]
    )
    carry = (
        per_slice.select(
            *place,
            F.sum(rows_).over(earlier).alias(rows_),
            *[F.sum(n).over(earlier).alias(f"_carry_{n}") for n in totals],
        )
        .where(F.col(rows_).isNotNull())
        .drop(rows_)
    )
    joined = join_same(local, F.broadcast(carry), place, "left")
    summed = {n: F.coalesce(F.col(n) + F.col(f"_carry_{n}"), F.col(n), F.col(f"_carry_{n}")) for n in totals}
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *[e.alias(n) for n, e in summed.items()])


def running(
    df: DataFrame, keys: list[str], order: list[Column], totals: dict[str, Column], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add, per name in ``totals``, the sum of its expression up to the current row.

    ``order`` must not leave ties, or the order of tied rows is arbitrary.
    """
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return by_group_size(
        df, keys, hot_rows,
        lambda part: part.select("*", *[F.sum(e).over(upto).alias(n) for n, e in totals.items()]),
        lambda part: sliced_running(part, keys, order, totals),
    )


def numbered(
    df: DataFrame, keys: list[str], order: list[Column], name: str = "rn", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Consecutive numbers from 1 inside each group; with no keys, over the whole input, which is then in order."""
    return running(df, keys, order, {name: F.lit(1).cast("long")}, hot_rows)


def peer_totals(
    df: DataFrame, keys: list[str], by: list[str], order: list[Column], value: Column | None = None
) -> DataFrame:
    """One row per (keys, by) with its rank, dense rank and running sum over peers, slice by slice.

    Tied rows are combined before anything is sorted, so no tie is too large.
    ``order`` sorts the ``by`` columns.
    """
    peers = df.groupBy(*keys, *by).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.lit(0) if value is None else value).alias("_s")
    )
    totals = sliced_running(
        peers, keys, order, {"_upto": F.col("_n"), "_groups": F.lit(1).cast("long"), "_sum": F.col("_s")}
    )
    return totals.select(
        *keys,
        *by,
        (F.col("_upto") - F.col("_n") + 1).alias("rank"),
        F.col("_groups").alias("dense_rank"),
        F.col("_sum").alias("running_sum"),
    )
