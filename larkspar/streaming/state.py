"""Keyed state over a stream with a user-given update, starting from saved values.

The state lives in the stream's own RocksDB store: a batch touches only the keys it brings,
and a restart goes on from the checkpoint. Before rows are dealt out by key, each task
combines the rows of equal keys, so a frequent key sends a few rows per task and not one per event.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

from larkspar.session import new_folder
from larkspar.streaming.run import finish

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_VARIABLE = "state"

#: Old state of a key (None: not seen yet) and its rows of a batch to the new state; None forgets the key.
Update = Callable[[Row | None, Iterator[Row]], tuple | None]
Combine = Callable[[pa.Table], pa.Table]


@contextmanager
def rocksdb(spark: SparkSession):
    """Streams started here keep their state in RocksDB, whatever the session uses otherwise."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


@contextmanager
def _by_value(*names: str):
    """Functions of these modules are sent whole: the process that plans a stream does not see shipped files."""
    modules = [sys.modules[n] for n in {__name__, *names} if n != "__main__"]
    known = cloudpickle.list_registry_pickle_by_value()
    fresh = [m for m in modules if m.__name__ not in known]
    for module in fresh:
        cloudpickle.register_pickle_by_value(module)
    try:
        yield
    finally:
        for module in fresh:
            cloudpickle.unregister_pickle_by_value(module)


class KeyedUpdate(StatefulProcessor):
    """Folds the rows of a key into its state and emits the keys a batch has changed."""

    def __init__(self, update: Update, key: str, state: StructType):
        self.update = update
        self.key = key
        self.fields = state

    def init(self, handle) -> None:
        self.state = handle.getValueState(_VARIABLE, self.fields)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        old = Row(*self.fields.names)(*self.state.get()) if self.state.exists() else None
        new = self.update(old, rows)
        if new is None:
            self.state.clear()
        else:
            self.state.update(tuple(new))
            yield Row(self.key, *self.fields.names)(*key, *new)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.state.update(tuple(initialState[name] for name in self.fields.names))

    def close(self) -> None:
        """Nothing is held open."""


def summed(key: str, *values: str) -> Combine:
    """One row per key, null keys included, with the sums of the other columns; sums over nulls alone are 0."""

    def run(rows: pa.Table) -> pa.Table:
        kept = pc.ScalarAggregateOptions(skip_nulls=True, min_count=0)
        sums = rows.group_by(key).aggregate([(v, "sum", kept) for v in values])
        return sums.select([key, *[f"{v}_sum" for v in values]]).rename_columns([key, *values]).cast(
            pa.schema([rows.schema.field(c) for c in (key, *values)])
        )

    return run


def _combined(stream: DataFrame, combine: Combine) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from combine(pa.Table.from_batches([batch])).to_batches()

    return stream.mapInArrow(run, stream.schema)


def changed_state(
    stream: DataFrame, key: str, state: str, update: Update, combine: Combine | None = None, saved: DataFrame | None = None
) -> DataFrame:
    """The stream of keys whose state a batch has changed, with their new state.

    ``state`` is the DDL of its columns. ``saved`` has the key and these columns, one row per
    key, and counts when the stream starts for the first time. ``combine`` gets a part of the
    rows and returns fewer of the same columns, such as ``summed``; it may be applied to
    any parts, so ``update`` must not depend on how rows were combined. Null is a key like any other.
    """
    fields = StructType.fromDDL(state)
    rows = _combined(stream, combine) if combine else stream
    given = saved.select(key, *fields.names).groupBy(key) if saved is not None else None
    out = StructType([stream.schema[key], *fields.fields])
    with _by_value(getattr(update, "__module__", __name__)):
        return rows.groupBy(key).transformWithState(KeyedUpdate(update, key, fields), out, "Update", "None", given)


def stored_state(spark: SparkSession, checkpoint: str, key: str) -> DataFrame:
    """The state of all keys after the last batch of a checkpoint, those that never had input included."""
    held = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", _VARIABLE).load()
    return held.select(F.col(f"key.{key}").alias(key), "value.*")


def fold_stream(
    stream: DataFrame, key: str, state: str, update: Update, combine: Combine | None = None,
    saved: DataFrame | None = None, checkpoint: str | None = None,
) -> DataFrame:
    """Process all available input and give the state of every key, saved ones without input included.

    With the same ``checkpoint`` a later call goes on from the last state. A stream that has never
    had input has the saved state.
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or new_folder(spark, "state-log")
    names = StructType.fromDDL(state).names
    with rocksdb(spark):
        changes = changed_state(stream, key, state, update, combine, saved)
        finish(changes.writeStream.format("noop").outputMode("update"), checkpoint)
    if _never_ran(spark, checkpoint):
        if saved is not None:
            return saved.select(key, *names)
        return spark.createDataFrame([], changes.schema)
    return stored_state(spark, checkpoint, key)


def _never_ran(spark: SparkSession, checkpoint: str) -> bool:
    """Whether no batch has been committed; batches are files in a folder of the checkpoint."""
    commits = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(checkpoint)
    return commits.where(F.col("path").rlike("/commits/[0-9]+$")).select("path").isEmpty()
