"""Samples of a fixed number of rows."""

from __future__ import annotations

import random
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Drawn positions up to this number are broadcast; more are joined as Spark sees fit.
BROADCAST_DRAWS = 100_000
_PARTITION_BITS = 33


def _positions(total: int, n: int, seed: int, again: bool) -> Counter:
    """How often each position of the table is drawn."""
    rng = random.Random(seed)
    if again:
        return Counter(rng.randrange(total) for _ in range(n if total else 0))
    return Counter(rng.sample(range(total), min(n, total)))


def take_sample(df: DataFrame, n: int, seed: int, again: bool = False) -> DataFrame:
    """``n`` rows drawn at random, each once or (``again``) with replacement; the same rows for the same seed.

    Rows are counted per partition, the ``n`` drawn positions are dealt to the partitions, and one
    pass picks the rows at these places. The table is read twice and must come in the same
    partitions and order both times, as a scan of files does. Nothing is sorted.
    """
    spark = df.sparkSession
    counted = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = dict(sorted((r["p"], r["n"]) for r in counted))  # a number per partition
    ends = list(accumulate(sizes.values()))
    parts = list(sizes)
    draws = []
    for position, times in _positions(ends[-1] if ends else 0, n, seed, again).items():
        at = bisect_right(ends, position)
        inside = position - (ends[at - 1] if at else 0)
        draws.append(((parts[at] << _PARTITION_BITS) + inside, times))
    drawn = spark.createDataFrame(draws, "_drawn long, _times int")
    if len(draws) <= BROADCAST_DRAWS:
        drawn = F.broadcast(drawn)
    names = [f"c{i}" for i in range(len(df.columns))]
    placed = df.toDF(*names).withColumn("_place", F.monotonically_increasing_id())
    picked = placed.join(drawn, F.col("_place") == F.col("_drawn"))
    if again:
        picked = picked.withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return picked.select(*names).toDF(*df.columns)
