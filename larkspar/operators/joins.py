"""Joins that stay whole and balanced when one key holds a large share of the rows.

Plain equi joins are left to Catalyst: adaptive execution splits a skewed partition
of an inner join on either side, and of a left join on the left side. The helpers
here cover what it does not split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspar.plans.ordered import HOT_ROWS, join_same
from larkspar.plans.sizing import BROADCAST_BYTES, broadcast_if_small
from larkspar.session import cut_lineage


def _hot_keys(left: DataFrame, left_key: str, right: DataFrame, right_key: str, hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows on a side: rows of both sides, whether both have the key, and its salts."""
    count = lambda df, key, name: df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias(name))
    counts = count(left, left_key, "n_left").join(count(right, right_key, "n_right"), "key", "full")
    known = counts.where((F.col("n_left") > hot_rows) | (F.col("n_right") > hot_rows)).groupBy("key").agg(
        F.max("n_left").alias("n_left"), F.max("n_right").alias("n_right")
    )
    most = F.greatest("n_left", "n_right")
    return cut_lineage(known.select(
        "key",
        (F.col("key").isNotNull() & F.col("n_left").isNotNull() & F.col("n_right").isNotNull()).alias("both"),
        (F.coalesce("n_left", F.lit(0)) >= F.coalesce("n_right", F.lit(0))).alias("left_larger"),
        F.ceil(most / F.lit(max(1, hot_rows))).cast("int").alias("salts"),
    ))


def _salted(side: DataFrame, key: str, hot: DataFrame, larger: Column, name: str) -> DataFrame:
    """Rows of hot keys dealt to salts, or repeated for all salts where the other side is the larger one."""
    tagged = side.join(hot, side[key].eqNullSafe(hot["key"]), "left")
    dealt = F.array(F.pmod(F.monotonically_increasing_id(), F.col("salts")).cast("int"))
    copied = F.sequence(F.lit(0), F.col("salts") - 1)
    salts = F.when(F.col("salts").isNull(), F.array(F.lit(0))).when(F.col("both") & ~larger, copied).otherwise(dealt)
    return tagged.withColumn("dealt_to", salts).select(
        *side.columns, F.explode("dealt_to").alias(f"{name}_salt"), F.coalesce("both", F.lit(False)).alias(f"{name}_both")
    )


def outer_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Left, right or full outer join that stays balanced when a key holds many rows of either side.

    Keys are counted once per side. Without a hot key this is Spark's own outer join. Rows of a hot
    key are dealt to salts on the side that has more of them, and repeated for each salt on the other;
    rows of other keys have one salt, and one outer join on key and salt gives everything. A hot key that
    both sides have leaves no row without a match, so copies that found none in their salt
    are dropped; one that a single side has (null keys too, they match nothing) only needs dealing out.
    Columns are matched by position, so both sides may have columns of the same name.
    """
    names = left.columns, right.columns
    at_left, at_right = f"l{left.columns.index(left_key)}", f"r{right.columns.index(right_key)}"
    left = left.toDF(*[f"l{i}" for i in range(len(left.columns))])
    right = right.toDF(*[f"r{i}" for i in range(len(right.columns))])
    hot = _hot_keys(left, at_left, right, at_right, hot_rows)
    same = F.col(at_left) == F.col(at_right)
    if hot.isEmpty():
        return left.join(right, same, how).toDF(*names[0], *names[1])
    hot = broadcast_if_small(hot)
    larger = F.col("left_larger")
    x, y = _salted(left, at_left, hot, larger, "l"), _salted(right, at_right, hot, ~larger, "r")
    joined = x.join(y, same & (F.col("l_salt") == F.col("r_salt")), how)
    alone = (F.col("l_salt").isNull() & F.col("r_both")) | (F.col("r_salt").isNull() & F.col("l_both"))
    kept = joined.where(~F.coalesce(alone, F.lit(False)))
    return kept.select(*left.columns, *right.columns).toDF(*names[0], *names[1])


def lookup(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, value: str, latest: str,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Keep the fact rows whose key is known and add ``value``.

    Of several entries for a key the one with the greatest ``latest`` counts. The
    table is combined once, and broadcast only while it is measured to be small.
    """
    entries = cut_lineage(dim.groupBy(F.col(dim_key).alias("_key")).agg(F.max_by(value, latest).alias(value)))
    small = broadcast_if_small(entries, max_bytes)
    return fact.join(small, fact[fact_key] == small["_key"], "inner").drop("_key")


def band_join(points: DataFrame, bands: DataFrame, at: str, low: str, high: str, width: float) -> DataFrame:
    """Pairs with ``low <= at < high`` without a nested loop.

    Every band is listed under the bins of ``width`` it touches; a point is in one
    bin, so the join is an equi join on the bin with a residual check.
    """
    last = F.ceil(F.col(high) / width) - 1
    first = F.floor(F.col(low) / width)
    listed = bands.where(F.col(low) < F.col(high)).withColumn("_bin", F.explode(F.sequence(first, last)))
    binned = points.withColumn("_bin", F.floor(F.col(at) / width))
    inside = (F.col(at) >= F.col(low)) & (F.col(at) < F.col(high))
    return binned.join(listed, "_bin").where(inside).drop("_bin")


def bag_subtract(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` that do not occur in ``right``, keeping their copies; nulls compare equal."""
    seen = right.distinct()
    return join_same(left, seen, left.columns, "left_anti")


def cogroup_bags(key: str, value: str, **inputs: DataFrame) -> DataFrame:
    """For every key the bag of values of each input, as rows (key, value, copies per input).

    A key without values in an input has 0 copies there. Copies are combined before
    the shuffle, so no group of values is held in one task.
    """
    names = list(inputs)
    tagged = None
    for name, df in inputs.items():
        part = df.select(F.col(key), F.col(value), F.lit(name).alias("_from"))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy(key, value).agg(
        *[F.count_if(F.col("_from") == name).alias(f"n_{name}") for name in names]
    )


