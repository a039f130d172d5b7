"""Groups that hold most of the rows, cut into several slices, against brute force."""

from __future__ import annotations

import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from larkspar.operators.aggregates import keep_one, values_per_key
from larkspar.operators.joins import bag_subtract, band_join, cogroup_bags, lookup, outer_join
from larkspar.operators.sampling import take_sample
from larkspar.operators.windows import end_values, ranks, running, running_over_peers, shifted
from larkspar.plans.ordered import By, numbered, slice_number, slices
from larkspar.sources.keyvalue import upsert


@pytest.fixture(scope="module")
def rows():
    """2000 rows; the key "hot" has 60 % of them, its value 7 a third of all; some keys are null."""
    rng = random.Random(4)
    keys = ["hot"] * 1200 + [f"k{i % 40}" for i in range(700)] + [None] * 100
    return [
        (i, k, 7 if i < 650 else rng.randrange(50), rng.choice([None, 1.0, 2.5, 4.0]))
        for i, k in enumerate(keys)
    ]


@pytest.fixture
def table(many_slices, rows):
    shuffled = random.Random(1).sample(rows, len(rows))
    return many_slices.createDataFrame(shuffled, "id long, k string, v long, w double").repartition(5)


@pytest.fixture(params=[0, 300, 1_000_000], ids=["all sliced", "hot sliced", "all whole"])
def hot(request):
    return request.param


def frame(rows):
    df = pd.DataFrame(rows, columns=["id", "k", "v", "w"])
    df["k"] = df["k"].fillna("<null>")
    return df


def by_id(df, *names):
    return {r["id"]: tuple(r[n] for n in names) for r in df.collect()}


def test_hot_group_is_cut(table):
    _, cut = slices(table, ["k"], [F.asc("v"), F.asc("id")], "at")
    per_slice = {r["at"]: r["count"] for r in cut.where("k = 'hot'").groupBy("at").count().collect()}
    assert len(per_slice) >= 2
    assert cut.where(F.spark_partition_id() != F.col("at")).isEmpty()
    assert max(per_slice.values()) < 800


def test_row_numbers(table, rows, hot):
    got = by_id(numbered(table, ["k"], [F.desc("v"), F.asc("id")], "n", hot), "n")
    want = frame(rows).sort_values(["v", "id"], ascending=[False, True])
    want["n"] = want.groupby("k").cumcount() + 1
    assert got == {i: (n,) for i, n in zip(want["id"], want["n"])}


def test_numbers_over_everything(table, rows):
    got = by_id(numbered(table, [], [F.asc("v"), F.desc("id")], "n"), "n")
    want = sorted(rows, key=lambda r: (r[2], -r[0]))
    assert got == {r[0]: (n + 1,) for n, r in enumerate(want)}


def test_ranks_with_a_huge_tie(table, rows, hot):
    got = by_id(ranks(table, ["k"], ["v"], [F.desc("v")], hot), "rank", "dense_rank")
    df = frame(rows)
    by = df.groupby("k")["v"]
    df["r"] = by.rank("min", ascending=False).astype(int)
    df["d"] = by.rank("dense", ascending=False).astype(int)
    assert got == {i: (r, d) for i, r, d in zip(df["id"], df["r"], df["d"])}


def test_running_sums_skip_nulls(table, rows, hot):
    order = [F.asc("v"), F.asc("id")]
    got = by_id(running(table, ["k"], order, {"s": F.col("w")}, hot), "s")
    want, total = {}, {}
    for i, k, _, w in sorted(rows, key=lambda r: (r[2], r[0])):
        if w is not None:
            total[k] = total.get(k, 0.0) + w
        want[i] = (total.get(k),)
    assert got == want


def test_running_over_peers(table, rows, hot):
    got = by_id(running_over_peers(table, ["k"], ["v"], [F.asc("v")], F.col("id"), hot), "running_sum")
    want = {i: (sum(r[0] for r in rows if r[1] == k and r[2] <= v),) for i, k, v, _ in rows}
    assert got == want


@pytest.mark.parametrize("steps", [1, 3, -2])
def test_shifted(table, rows, steps, hot):
    got = by_id(shifted(table, ["k"], [F.asc("v"), F.asc("id")], "w", steps, "other", hot), "other")
    groups: dict = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        groups.setdefault(r[1], []).append(r)
    want = {}
    for members in groups.values():
        for at, r in enumerate(members):
            source = at - steps
            want[r[0]] = (members[source][3] if 0 <= source < len(members) else None,)
    assert got == want


def test_end_values(table, rows):
    got = by_id(end_values(table, ["k"], "id", ["v", "id"]), "first_value", "last_value")
    ends = {k: sorted((r[2], r[0]) for r in rows if r[1] == k) for k in {r[1] for r in rows}}
    assert got == {r[0]: (ends[r[1]][0][1], ends[r[1]][-1][1]) for r in rows}


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_outer_join(spark, table, how):
    names = spark.createDataFrame([("hot", 1), ("hot", 2), ("k3", 3), ("none", 4), (None, 5)], "name string, at int")
    left = table.select("id", "k")
    got = Counter(tuple(r) for r in outer_join(left, names, "k", "name", how).collect())
    want = Counter(tuple(r) for r in left.join(names, F.col("k") == F.col("name"), how).collect())
    assert got == want


def test_values_per_key_is_the_whole_bag(table, rows):
    got = {(r["k"], r["v"]): r["copies"] for r in values_per_key(table, "k", "v").collect()}
    assert got == Counter((r[1], r[2]) for r in rows)


def test_cogroup_bags(spark):
    a = spark.createDataFrame([("x", 1), ("x", 1), ("y", 2)], "k string, v int")
    b = spark.createDataFrame([("x", 3), ("z", 9)], "k string, v int")
    c = spark.createDataFrame([("x", 1)], "k string, v int")
    got = {tuple(r) for r in cogroup_bags("k", "v", a=a, b=b, c=c).collect()}
    assert got == {("x", 1, 2, 0, 1), ("x", 3, 0, 1, 0), ("y", 2, 1, 0, 0), ("z", 9, 0, 1, 0)}


def test_bag_subtract_keeps_copies_and_matches_nulls(spark):
    left = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3), (None, 4), (None, 4)], "k string, v int")
    right = spark.createDataFrame([("b", 2), (None, 3), ("c", 9)], "k string, v int")
    got = Counter(tuple(r) for r in bag_subtract(left, right).collect())
    assert got == Counter({("a", 1): 2, (None, 4): 2})


def test_band_join_of_any_band_width(spark):
    rng = random.Random(8)
    points = [(i, rng.uniform(-50, 50)) for i in range(300)]
    bands = [(j, lo, lo + rng.choice([0.0, 0.4, 5.0, 37.5])) for j, lo in enumerate(rng.uniform(-60, 60) for _ in range(40))]
    bands += [(90, 10.0, 20.0), (91, 5.0, -5.0)]
    points += [(900, 10.0), (901, 20.0)]
    joined = band_join(
        spark.createDataFrame(points, "p int, x double"), spark.createDataFrame(bands, "b int, lo double, hi double"),
        "x", "lo", "hi", 10.0,
    )
    got = Counter((r["p"], r["b"]) for r in joined.collect())
    assert got == Counter((p, b) for p, x in points for b, lo, hi in bands if lo <= x < hi)


def test_lookup_keeps_the_last_entry_with_and_without_broadcast(spark):
    fact = spark.createDataFrame([(1, 5), (2, 6), (3, 7)], "id int, city int")
    dim = spark.createDataFrame([(5, "old", 1), (5, "new", 2), (6, "six", 1)], "city_id int, name string, at int")
    for limit in (10_000, 0):
        got = {tuple(r) for r in lookup(fact, dim, "city", "city_id", "name", "at", limit).collect()}
        assert got == {(1, 5, "new"), (2, 6, "six")}


def test_keep_one(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 3), (2, "c", 1), (1, "a", 1)], "id int, s string, n int")
    assert {tuple(r) for r in keep_one(df, ["id"], ["s"]).collect()} == {(1, "a", 1), (2, "c", 1)}


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1, 1), ("b", 2, 1)], "k string, v int, at int")
    new = spark.createDataFrame([("b", 5, 2), ("c", 6, 2), ("b", 7, 3)], "k string, v int, at int")
    assert {tuple(r) for r in upsert(old, new, ["k"], "at").collect()} == {("a", 1, 1), ("b", 7, 3), ("c", 6, 2)}


def test_samples_of_fixed_size(spark, table, rows, tmp_path):
    ids = {r[0] for r in rows}
    once = [r["id"] for r in take_sample(table, 50, 1).collect()]
    assert len(once) == len(set(once)) == 50 and set(once) <= ids
    assert once == [r["id"] for r in take_sample(table, 50, 1).collect()] != [r["id"] for r in take_sample(table, 50, 2).collect()]
    again = [r["id"] for r in take_sample(table, 3000, 1, again=True).collect()]
    assert len(again) == 3000 and set(again) <= ids and len(set(again)) < 2000
    assert take_sample(table, 5000, 1).count() == 2000
    for empty in (table.limit(0), spark.range(0)):
        assert take_sample(empty, 5, 1).count() == take_sample(empty, 5, 1, again=True).count() == 0
    table.write.parquet(str(tmp_path / "rows"))
    scan = spark.read.parquet(str(tmp_path / "rows"))
    drawn = Counter(r["id"] for i in range(40) for r in take_sample(scan, 500, i).collect())
    assert set(drawn) == ids and max(drawn.values()) < 30  # 10 of 40 on average
    plan = take_sample(scan, 20, 3, again=True)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan.replace("BroadcastExchange", "")


@pytest.mark.parametrize("how", ["left", "right", "full"])
@pytest.mark.parametrize("hot_rows", [1, 40, 1_000_000])
def test_outer_join_with_hot_keys(spark, table, how, hot_rows):
    """Keys hot on the left, on the right, on both, on one side alone, and null."""
    left = table.select("id", "k", F.lit("left").alias("same"))
    right = spark.createDataFrame(
        [(i, k, "right") for i, k in enumerate(["hot"] * 3 + ["k3"] * 120 + ["k4"] * 50 + ["alone"] * 90 + [None] * 70 + ["k5", "z"])],
        "id int, k string, same string",
    )
    for x, y in ((left, right), (right, left)):
        want = Counter(tuple(r) for r in x.join(y, x["k"] == y["k"], how).collect())
        got = outer_join(x, y, "k", "k", how, hot_rows)
        assert got.columns == ["id", "k", "same"] * 2 and Counter(tuple(r) for r in got.collect()) == want


ORDERS = {
    "numbers": lambda: [F.asc("w"), F.desc("id")],
    "nulls first": lambda: [F.desc_nulls_first("w"), F.asc("v"), F.asc("id")],
    "nulls last": lambda: [F.desc("k"), F.asc_nulls_last("w"), F.asc("id")],
    "plain": lambda: [F.col("id")],
    "times, decimals and bytes": lambda: [F.desc("s"), F.asc("d"), F.asc("b"), F.asc("id")],
}


@pytest.mark.parametrize("kind", ORDERS)
def test_slices_are_ranges_of_any_order(spark, table, kind):
    """Nulls, ties, strings, times and bytes: the slice never falls along the order, and numbers are right."""
    order = ORDERS[kind]()
    wide = table.withColumns({
        "s": F.expr("CASE WHEN id % 7 > 0 THEN timestamp_seconds(id % 11) END"), "d": F.expr("CAST(v AS DECIMAL(9, 2))"),
        "b": F.expr("CAST(k AS BINARY)"), "_slice": F.lit(-1), "_rows": F.lit("own"),
    })
    rows = wide.withColumn("at", slice_number(wide, [], order, 7)).orderBy(*order).select("id", "at").collect()
    at = [r["at"] for r in rows]
    assert at == sorted(at) and len(set(at)) > 3
    got = numbered(wide, [], order, "n").collect()
    assert [r["n"] for r in got] == list(range(1, len(rows) + 1))
    assert [r["id"] for r in got] == [r["id"] for r in rows]
    assert {(r["_slice"], r["_rows"]) for r in got} == {(-1, "own")}


def test_orders_are_read_from_columns(table):
    assert By.of(F.desc_nulls_first("a b")) == By("a b", True, False)
    assert By.of(F.col("a").asc_nulls_last()) == By("a", False, True) and By.of(F.col("a")) == By("a")
    assert By.of(F.desc("a")) == By("a", True, True)
    with pytest.raises(ValueError):
        numbered(table, [], [F.desc(F.col("v") + 1)])


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_outer_join_with_equal_column_names(spark, how):
    left = spark.createDataFrame([(1, "L1"), (2, "L2"), (None, "L3"), (2, "L4")], "id int, name string")
    right = spark.createDataFrame([(2, "R2"), (3, "R3"), (None, "R4")], "id int, name string")
    want = Counter(tuple(r) for r in left.join(right, left["id"] == right["id"], how).collect())
    assert Counter(tuple(r) for r in outer_join(left, right, "id", "id", how).collect()) == want
