"""Grouped aggregation that combines before it shuffles."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def multi_level(finest: DataFrame, dims: list[str], levels: str | list[list[str]]) -> DataFrame:
    """Sum and average over ``"cube"``, ``"rollup"`` or listed grouping sets of ``dims``.

    ``finest`` holds one row per combination of ``dims`` with its ``amount`` and row
    count ``n``, so the expansion into levels multiplies groups and not input rows.
    """
    if levels == "cube":
        grouped = finest.cube(*dims)
    elif levels == "rollup":
        grouped = finest.rollup(*dims)
    else:
        grouped = finest.groupingSets([[F.col(c) for c in s] for s in levels], *dims)
    total = F.round(F.sum("amount"), 2)
    return grouped.agg(total.alias("sum_amount"), (total / F.sum("n")).alias("avg_amount"))


def values_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """The bag of values of every key as rows (key, value, copies).

    The same content as a list per key, but no list is ever built, so a key with a
    large share of the rows is spread like any other data.
    """
    return df.groupBy(key, value).agg(F.count(F.lit(1)).alias("copies"))


def last_per_key(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Pairs as a map: of several values of a key the last one in ``order`` stays."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def keep_one(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the smallest by ``order``; the remaining columns break ties."""
    rest = [*order, *[c for c in df.columns if c not in keys and c not in order]]
    kept = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return kept.select(*keys, "_row.*").select(*df.columns)


def combine_by_key(
    df: DataFrame,
    key: str,
    partial: Callable[[pd.DataFrame], pd.DataFrame],
    state: str,
    merge: dict[str, Column],
    finish: dict[str, Column],
) -> DataFrame:
    """User-defined aggregate in three steps.

    ``partial`` turns one Arrow batch into one state row per key (schema ``state``),
    ``merge`` combines states with built-in aggregates, ``finish`` computes the
    results. No task ever needs a whole group in memory.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield partial(batch)

    merged = df.mapInPandas(run, state).groupBy(key).agg(*[e.alias(n) for n, e in merge.items()])
    return merged.select(key, *[e.alias(n) for n, e in finish.items()])
