"""Mix sources to target weights by weighted fair queueing. DataFrame functions only.

Each source is shuffled and read up to ``MOST_COPIES`` times over. A copy of a document
gets a virtual finish time: the words its source has sent up to its end, divided by
the target of the source. In the order of these times all sources advance at the
pace of their targets, and the mix is the beginning of that order that fills the
budget, the number of words of all documents.

No group is sorted in one task. Sums inside a source run over hash ranges; the end of
the mix is found by sums over ranges of virtual time, then over ranges of that
range, and only the copies of the last range are put in order.

Rows: a null text has size 0. Documents of size 0 are never taken. A null source is a
source of its own and sorts last. Repeated rows are documents of their own; which of
several equal rows is taken is the same in each run up to their exchange. An empty
table gives an empty result. Other columns are kept; ``size``, ``source_size``,
``target`` and ``taken`` are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspar.llm.columns import restored, sheltered
from larkspar.plans.ordered import numbered
from larkspar.session import cut_lineage

MOST_COPIES = 3
WORD = r"[^\x20\x09-\x0D]+"
#: Hash ranges of one source; ranges of virtual time per unit, and per range of that.
SHARDS = 1024
TIMES = 1024
#: Targets are broadcast up to this many sources, a row of some 50 bytes each.
BROADCAST_SOURCES = 50_000
ADDED = ("size", "source_size", "target", "taken")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_COPIES) -> DataFrame:
    """Targets of the sources in ``sizes`` (source, source_size).

    By code point, null last, the sources get the weights in turn. Targets share the sum of
    all sizes by weight; none exceeds ``most`` times its source's size. Each round fixes
    the sources above their limit and shares the rest anew, until none is above.
    """
    ordered = numbered(sizes, [], [F.col("source").asc_nulls_last()], "_place")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = cut_lineage(ordered.select(
        "source", "source_size",
        F.element_at(cycle, (F.pmod(F.col("_place") - 1, F.lit(len(weights))) + 1).cast("int")).alias("_weight"),
    ))
    limit = F.col("source_size") * float(most)
    pace = 0.0
    while True:
        full = limit <= F.col("_weight") * F.lit(pace)
        total, fixed, weight = weighed.agg(
            F.sum("source_size"), F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("_weight")))
        ).first()
        if not total or not weight:
            break
        share = (total - (fixed or 0.0)) / weight
        if share <= pace:
            break
        pace = share
    return weighed.select("source", "source_size", F.least(limit, F.col("_weight") * F.lit(pace)).alias("target"))


def _earlier(df: DataFrame, keys: list[str], by: str, value: str) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("_before", F.coalesce(F.sum(value).over(window), F.lit(0)))


def _time_range() -> Column:
    """Range of a virtual time: ``TIMES`` in each unit up to 2, then as many in each doubling."""
    t = F.col("_time")
    late = 2 * TIMES + F.floor(F.log2(F.greatest(t, F.lit(2.0)) / 2.0) * TIMES)
    return F.when(t < 2.0, F.floor(t * TIMES)).otherwise(late).cast("long")


def _cut(ranges: DataFrame, by: str, budget: int) -> tuple[int, int] | None:
    """The range in which the running sum reaches the budget, and the sum before it."""
    sums = _earlier(ranges.withColumn("_all", F.lit(1)), ["_all"], by, "_words")
    row = (
        sums.where((F.col("_before") < budget) & (F.col("_before") + F.col("_words") >= budget))
        .agg(F.min_by(F.struct(by, "_before"), by).alias("cut")).first()
    )
    return (row["cut"][by], row["cut"]["_before"]) if row["cut"] is not None else None


def _same(a: DataFrame, b: DataFrame, names: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[n].eqNullSafe(b[n]) for n in names])


def _sent(narrow: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows of some size with the words their shuffled source has sent up to their end."""
    laid = narrow.where("size > 0").withColumn("_shard", F.shiftrightunsigned("_hash", 64 - SHARDS.bit_length() + 1))
    shards = laid.groupBy("source", "_shard").agg(F.sum("size").alias("_words"))
    shards = _earlier(shards, ["source"], "_shard", "_words").drop("_words")
    shards = shards.join(targets, _same(shards, targets, ["source"])).select(shards["*"], "source_size", "target")
    upto = Window.partitionBy("source", "_shard").orderBy("_hash", "_key").rowsBetween(Window.unboundedPreceding, 0)
    summed = laid.withColumn("_upto", F.sum("size").over(upto))
    return summed.join(shards, _same(summed, shards, ["source", "_shard"])).select(
        *[summed[n] for n in narrow.columns], (F.col("_upto") + F.col("_before")).alias("_sent"), "source_size", "target"
    )


def _taken(timed: DataFrame, budget: int) -> DataFrame:
    """The copies at the beginning of the virtual time that fill the budget; the last one may cross it."""
    sums = lambda df, by: df.groupBy(by).agg(F.sum("size").alias("_words"))
    cut = _cut(sums(timed, "_range"), "_range", budget)
    if cut is None:
        return timed
    t = F.col("_time") * TIMES
    fine = F.floor((t - F.floor(t)) * TIMES).cast("long") if cut[0] < 2 * TIMES else F.lit(0).cast("long")
    last = timed.where(F.col("_range") == cut[0]).withColumn("_fine", fine)
    finer = _cut(sums(last, "_fine"), "_fine", budget - cut[1])
    order = Window.partitionBy("_fine").orderBy("_time", F.col("source").asc_nulls_last(), "_hash", "_key")
    edge = (
        last.where(F.col("_fine") == finer[0])
        .withColumn("_upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .where(F.col("_upto") - F.col("size") < budget - cut[1] - finer[1])
    )
    return (
        timed.where(F.col("_range") < cut[0])
        .unionByName(last.where(F.col("_fine") < finer[0]).select(timed.columns))
        .unionByName(edge.select(timed.columns))
    )


def _mixed(
    docs: DataFrame, names: list[str], key: str, weights: tuple[int, ...], most: int, keep_text: bool
) -> DataFrame:
    """The sheltered columns ``names`` of all rows with size, source_size, target and taken."""
    size = F.coalesce(F.regexp_count(docs["text"], F.lit(WORD)), F.lit(0)).cast("long")
    sized = docs.select(
        *sheltered(docs, names), docs["source"].alias("source"), size.alias("size"),
        F.xxhash64(F.lit(17), docs[key], docs["text"]).alias("_hash"), docs[key].alias("_key"),
        F.xxhash64(*[docs[n] for n in names]).alias("_row"),
    )
    own = [f"own {i}" for i in range(len(names))]
    if not keep_text:
        sized = cut_lineage(sized)
    narrow = sized.select("source", "size", "_hash", "_key")
    narrow = cut_lineage(narrow) if keep_text else narrow

    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = cut_lineage(source_targets(sizes, weights, most))
    sources, budget = targets.agg(F.count(F.lit(1)), F.sum("source_size")).first()
    copies = _sent(narrow, targets).where("target > 0").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("_copy")
    )
    timed = copies.withColumn("_time", (F.col("_copy") * F.col("source_size") + F.col("_sent")) / F.col("target"))
    timed = cut_lineage(timed.select("source", "size", "_hash", "_key", "_time", _time_range().alias("_range")))

    same = ["_key", "_hash", "source"]
    took = _taken(timed, budget or 0).groupBy(*same).agg(F.count(F.lit(1)).alias("_took"))
    equal = Window.partitionBy(*same)
    rows = sized.select(
        "*", F.row_number().over(equal.orderBy("_row")).alias("_nth"), F.count(F.lit(1)).over(equal).alias("_rows")
    )
    given = F.coalesce(F.col("_took"), F.lit(0))
    share = F.floor(given / F.col("_rows")) + (F.col("_nth") <= F.pmod(given, F.col("_rows"))).cast("long")
    out = rows.join(took, _same(rows, took, same), "left").select(
        *[rows[f"`{n}`"] for n in own], rows["source"], "size", (share * F.col("size")).alias("taken")
    )
    if sources <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    return out.join(targets, _same(out, targets, ["source"]), "left").select(
        *[out[f"`{n}`"] for n in own], "size", "source_size", "target", "taken"
    )


def mix_sources(
    docs: DataFrame, key: str = "doc_id", weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_COPIES,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``taken``, the words the mix takes of each row."""
    names = [n for n in docs.columns if n not in ADDED and (keep_text or n != "text")]
    mixed = _mixed(docs, names, key, weights, most, keep_text)
    return mixed.select(*restored(mixed, names), *ADDED)


def mixed_documents(
    docs: DataFrame, key: str = "doc_id", weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_COPIES
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the mix takes it, at most ``most`` times, with its own columns."""
    taken = _mixed(docs, docs.columns, key, weights, most, True).where("taken > 0")
    times = F.sequence(F.lit(1).cast("long"), (F.col("taken") / F.col("size")).cast("long"))
    repeated = taken.withColumn("time", F.explode(times))
    return repeated.select(*restored(repeated, docs.columns))
