"""Links between classes of equal sets that share a block, and their components.

A method prepares rows (key, hash, n, cls, sketches, keys): the size of a row's set, the class of
equal sets, bit sketches of parts of the set (or one of the whole set), and the blocks in which similar
sets meet, each with the slot of the sketch that counts there. Blocks are handled in
slices of their hash space, one after the other, so the shuffled blocks of one
slice lie on disk at a time; only those that several classes share are kept.

The pairs of a block are not emitted. In ``ROUNDS`` rounds each class meets ``HUBS`` members of
each of its blocks, chosen by hash; verified links are closed to components. Then only
classes of different components that still share a block are compared. Every comparison
is a join condition over sizes and sketches, so only pairs that pass are emitted; their
texts are fetched and their whole sets compared. Hubs are met by folded sketches, and the last
comparison, whose pairs grow with the square of a block, takes the whole ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspar.llm.columns import spare_names
from larkspar.llm.components import components
from larkspar.llm.words import chunks
from larkspar.session import cut_lineage, new_folder

#: Rounds of meeting hubs, hubs of a block in each round; rows of a measured broadcast; slices of the blocks;
#: classes whose blocks a task remembers to have emitted.
ROUNDS = 2
HUBS = 6
BROADCAST_ROWS = 100_000
SLICES = 4
REMEMBERED = 1_000_000
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

ArrowStep = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def long_lists(arrays: list[np.ndarray]) -> pa.Array:
    """A list column of 64-bit integers from one array per row."""
    offsets = np.append(0, np.cumsum([len(x) for x in arrays])).astype(np.int32)
    joined = np.concatenate([*arrays, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(joined))


def block_lists(blocks: list[np.ndarray], slots: list[np.ndarray]) -> pa.Array:
    """A list column of blocks and the slots of the sketches that count in them."""
    listed = long_lists(blocks)
    at = pa.array(np.concatenate([*slots, np.zeros(0, np.int32)]).astype(np.int32))
    return pa.ListArray.from_arrays(listed.offsets, pa.StructArray.from_arrays([listed.values, at], ["block", "slot"]))


def sketch_lists(sketches: list[np.ndarray]) -> pa.Array:
    """A list column of sketches, as a matrix per row with a line (number of parts, bits) for each slot."""
    offsets = np.append(0, np.cumsum([len(x) for x in sketches])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), long_lists([line for x in sketches for line in x]))


def parity_sketch(members: np.ndarray, bits: int) -> np.ndarray:
    """One bit per member is flipped, by its highest bits; the distance of two sketches is at most that of their sets.

    ``bits`` is a power of two, so the same share of the bits, in order, belongs to each share of the hash space.
    """
    places = (members >> np.uint64(64 - (bits - 1).bit_length())).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8)).view(np.uint64)


def first_seen(classes: np.ndarray, seen: set[int]) -> np.ndarray:
    """Which rows are the first of their class in a task; a forgotten class is only named again.

    Blocks of later copies say nothing new, so they need not be emitted.
    """
    if len(seen) > REMEMBERED:
        seen.clear()
    new = np.zeros(len(classes), dtype=bool)
    for i, cls in enumerate(classes.tolist()):
        if cls not in seen:
            seen.add(cls)
            new[i] = True
    return new


def set_verifier(sets: Callable[[pa.Array], list[np.ndarray]], num: int, den: int) -> ArrowStep:
    """Keep the pairs (a, b) whose sorted sets of both texts have a similarity of num / den."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(iter([batch]), "text_a", 1 << 20):
                good = []
                for row in chunks(iter([piece]), "text_b", 1 << 20):
                    for x, y in zip(sets(row.column("text_a")), sets(row.column("text_b"))):
                        both = len(np.intersect1d(x, y, assume_unique=True))
                        good.append(den * both >= num * (len(x) + len(y) - both))
                yield piece.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


@contextmanager
def _dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs planned here drop their shuffle files when they end; each leaves its result in a table or a checkpoint."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def _emptied(spark: SparkSession, folder: str) -> None:
    """Leave an empty table in place of one that is not read any more."""
    spark.createDataFrame([], "unused int").write.mode("overwrite").parquet(folder)


def merged(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Labels after more edges: only the components that the edges touch are joined to new ones."""
    if labels is None:
        return cut_lineage(components(edges))
    if edges.isEmpty():
        return labels
    known = lambda node: labels.select(F.col("node").alias(f"node_{node}"), F.col("label").alias(f"label_{node}"))
    between = edges.join(known("a"), F.col("a") == F.col("node_a"), "left").join(known("b"), F.col("b") == F.col("node_b"), "left")
    new = components(between.select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b")))
    moved = new.select(F.col("node").alias("old"), F.col("label").alias("new"))
    before = labels.join(moved, labels["label"] == moved["old"], "left").select("node", F.coalesce("new", "label").alias("label"))
    return cut_lineage(before.unionByName(new.join(labels.select("node"), "node", "left_anti")))


class Links:
    """State of one search: the prepared classes, and where the texts are.

    ``docs`` has key, hash and text; ``apart`` is a bound, in terms of the Hamming distances of the
    64-bit pieces of the sketches, the sum of both sizes and the number of parts a set is cut into, that all
    similar pairs keep in a block they share. Hubs are met with ``fold`` pieces of a sketch as one, by XOR.
    """

    def __init__(
        self, docs: DataFrame, prepare: ArrowStep, verify: ArrowStep, num: int, den: int, sketch_longs: int,
        apart: Callable[[list[Column], Column, Column], Column], slices: int = SLICES, fold: int = 1,
    ):
        self.num, self.den, self.apart, self.slices, self.fold = num, den, apart, slices, fold
        self.sketch = [f"s{i}" for i in range(sketch_longs)]
        self.verify = verify
        self.spark = docs.sparkSession
        self.docs = docs
        kind = docs.schema["key"].dataType.simpleString()
        folder = new_folder(self.spark, "sets")
        docs.mapInArrow(
            prepare,
            f"key {kind}, hash long, n long, cls long, sketches array<array<long>>, keys array<struct<block: long, slot: int>>",
        ).write.option("compression", "zstd").option("parquet.block.size", 16 << 20).parquet(folder)
        self.sets = folder
        stored = self.spark.read.parquet(folder)
        named = new_folder(self.spark, "classes")
        stored.select("key", "hash", "n", "cls").write.parquet(named)
        self.rows = self.spark.read.parquet(named)
        self.classes = cut_lineage(
            stored.where("n > 0").groupBy("cls").agg(
                F.first("n").alias("n"), F.min(F.struct("key", "hash")).alias("row")
            )
        )
        lines = stored.select("cls", "n", F.posexplode("sketches").alias("slot", "line"))
        lines = lines.select("cls", "slot", "n", *[F.col("line")[i].alias(c) for i, c in enumerate(["parts", *self.sketch])])
        self.sketches = cut_lineage(lines.dropDuplicates(["cls", "slot"]))

    def near(self, left: str, right: str, sketch: list[str]) -> Column:
        """Whether columns of two classes pass the size and Hamming bounds and differ in component."""
        col = lambda side, name: F.col(f"{side}.{name}")
        flipped = [F.bit_count(col(left, n).bitwiseXOR(col(right, n))) for n in sketch]
        n, m = col(left, "n"), col(right, "n")
        return (
            (col(left, "label") != col(right, "label")) & (n * self.den >= m * self.num) & (m * self.den >= n * self.num)
            & self.apart(flipped, n + m, col(left, "parts"))
        )

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose sets are similar enough."""
        pairs = cut_lineage(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        wanted = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))).distinct()
        found = cut_lineage(wanted.join(self.classes, wanted["a"] == self.classes["cls"]).select("cls", "row.key", "row.hash"))
        if found.count() <= BROADCAST_ROWS:
            found = F.broadcast(found)
        same = self.docs["key"].eqNullSafe(found["key"]) & (self.docs["hash"] == found["hash"])
        folder = new_folder(self.spark, "texts")
        self.docs.join(found, same).select(found["cls"], self.docs["text"]).dropDuplicates(["cls"]).write.parquet(folder)
        texts = self.spark.read.parquet(folder)
        side = lambda x: texts.select(F.col("cls").alias(x), F.col("text").alias(f"text_{x}"))
        both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b")
        good = cut_lineage(both.mapInArrow(self.verify, "a long, b long"))
        _emptied(self.spark, folder)
        return good

    def members(self) -> DataFrame:
        """Classes of each block that several classes share, with sizes and folded sketches."""
        folder = new_folder(self.spark, "blocks")
        whole, short = self.sketch, self.sketch[: len(self.sketch) // self.fold]
        folded = [reduce(Column.bitwiseXOR, [F.col(c) for c in whole[i :: len(short)]]).alias(c) for i, c in enumerate(short)]
        sketches = self.sketches.select("cls", "slot", "n", "parts", *folded)
        stored = self.spark.read.parquet(self.sets)
        for turn in range(self.slices):
            mine = F.filter("keys", lambda k: F.pmod(k["block"], F.lit(self.slices)) == turn)  # noqa: B023
            emitted = stored.where("n > 0").select("cls", F.explode(mine).alias("key")).select("cls", "key.block", "key.slot")
            shared = emitted.groupBy("block").agg(F.min("cls").alias("least"), F.max("cls").alias("most"))
            shared = shared.where("least <> most").select("block")
            members = emitted.join(shared, "block").distinct()
            members.join(sketches, ["cls", "slot"]).write.mode("append").parquet(folder)
        _emptied(self.spark, self.sets)
        return self.spark.read.parquet(folder)

    @staticmethod
    def named(members: DataFrame, labels: DataFrame | None) -> DataFrame:
        """Members with their component so far, of the blocks that hold more than one."""
        if labels is None:
            return members.withColumn("label", F.col("cls"))
        named = members.join(labels, members["cls"] == labels["node"], "left")
        named = cut_lineage(named.select(*[members[c] for c in members.columns], F.coalesce("label", "cls").alias("label")))
        mixed = named.groupBy("block").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
        return named.join(mixed.select("block"), "block")

    def labels(self) -> DataFrame:
        """``node`` and ``label`` of all classes that link with another."""
        members = self.members()
        labels = None
        for turn in range(ROUNDS + 1):
            named = self.named(members, labels)
            same = F.col("x.block") == F.col("y.block")
            if turn < ROUNDS:
                sketch = self.sketch[: len(self.sketch) // self.fold]
                member = F.struct("cls", "label", "n", *sketch)
                chosen = [F.max_by(member, F.xxhash64("cls", F.lit(HUBS * turn + i))) for i in range(HUBS)]
                hubs = named.groupBy("block").agg(F.array_distinct(F.array(*chosen)).alias("hubs"))
                others = hubs.select("block", F.explode("hubs").alias("o")).select("block", "o.*")
            else:
                sketch = self.sketch
                if self.fold > 1:
                    named = named.select("cls", "block", "slot", "label").join(self.sketches, ["cls", "slot"])
                others = named
                same = same & (F.col("x.cls") < F.col("y.cls"))
            met = named.alias("x").join(others.alias("y"), same & self.near("x", "y", sketch))
            more = self.verified(met.select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")))
            labels = merged(labels, more)
        return labels

    def labelled_rows(self) -> DataFrame:
        """key, hash, n and the class label of each row."""
        with _dropping_shuffles(self.spark):
            labels = self.labels()
        rows = self.rows
        return rows.join(labels, rows["cls"] == labels["node"], "left").select(
            "key", "hash", "n", F.coalesce("label", "cls").alias("label")
        )


def slim(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, text and a hash of the text; other columns are left."""
    return docs.select(docs[key].alias("key"), F.xxhash64(docs[text]).alias("hash"), docs[text].alias("text"))


def component_rows(rows: DataFrame, key: str) -> DataFrame:
    """Per row ``key``, ``n_shingles`` and ``component_id``, the least key of its label; rows without shingles alone."""
    rows = cut_lineage(rows)
    least = rows.where("n > 0").groupBy("label").agg(F.min("key").alias("least"))
    filled = rows.where("n > 0").join(least, "label").select("key", "n", "least")
    empty = rows.where("n = 0").select("key", "n", F.col("key").alias("least"))
    return filled.unionByName(empty).select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.col("least").alias("component_id")
    )


def one_of_each(docs: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs`` without near copies: of each label the one with the least key, and all without shingles."""
    stays = rows.where("n > 0").groupBy("label").agg(F.min(F.struct("key", "hash")).alias("row"))
    stays = stays.select("row.key", "row.hash", F.lit(False).alias("empty")).unionByName(
        rows.where("n = 0").select("key", "hash", F.lit(True).alias("empty")).distinct()
    )
    text_hash, empty, nth, kept_key = spare_names(docs.columns, "_hash", "_empty", "_nth", "_key")
    stays = stays.select(F.col("key").alias(kept_key), F.col("hash").alias(text_hash), F.col("empty").alias(empty))
    hashed = docs.select("*", F.xxhash64(docs["text"]).alias(f"{text_hash}_"))
    kept = hashed.join(stays, hashed[key].eqNullSafe(stays[kept_key]) & (hashed[f"{text_hash}_"] == stays[text_hash]))
    same = Window.partitionBy(kept_key, text_hash).orderBy(F.lit(0))
    return kept.withColumn(nth, F.row_number().over(same)).where(F.col(empty) | (F.col(nth) == 1)).select(*docs.columns)
