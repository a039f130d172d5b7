"""Keyed values as a long table ``(key, kind, field, value)``.

``kind`` is ``string``, ``hash``, ``list`` or ``set``; ``field`` is the hash field or
the position in a list. Values of a key are rows, so no key is too large.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COLUMNS = ["key", "kind", "field", "value"]


class Glob(NamedTuple):
    """A key pattern as a Java regular expression, and the text that all its keys start with."""

    pattern: str
    prefix: str
    literal: bool


def _exactly(char: str) -> str:
    return char if char.isalnum() and char.isascii() else f"\\x{{{ord(char):X}}}"


def _one_of(glob: str, at: int) -> tuple[str, int]:
    """The class after ``[`` and where it ends; without ``]`` the rest of the glob is in it."""
    negated = glob[at : at + 1] == "^"
    at += negated
    ranges = []
    while at < len(glob) and glob[at] != "]":
        if glob[at] == "\\" and at + 1 < len(glob):
            at += 1
            ranges.append((glob[at], glob[at]))
        elif glob[at + 1 : at + 2] == "-" and at + 2 < len(glob) and glob[at + 2] != "]":
            ranges.append(tuple(sorted((glob[at], glob[at + 2]))))
            at += 2
        else:
            ranges.append((glob[at], glob[at]))
        at += 1
    members = "".join(f"{_exactly(a)}-{_exactly(b)}" for a, b in ranges)
    if not members:
        return ("." if negated else "(?!)"), at + 1
    return f"[{'^' * negated}{members}]", at + 1


def parse_glob(glob: str) -> Glob:
    """``*`` any text, ``?`` one character, ``[a-c]`` and ``[^a-c]`` one in or out of ranges, ``\\`` the next one as it is.

    Line breaks are characters like any other; a range may be given either way round.
    """
    parts, prefix, literal, at = [], "", True, 0
    while at < len(glob):
        char = glob[at]
        at += 1
        if char in "*?[":
            literal = False
            if char == "[":
                found, at = _one_of(glob, at)
            else:
                found = ".*" if char == "*" else "."
        else:
            if char == "\\" and at < len(glob):
                char = glob[at]
                at += 1
            found = _exactly(char)
            prefix += char if literal else ""
        parts.append(found)
    return Glob("(?s)\\A" + "".join(parts) + "\\z", prefix, literal)


def keys_like(store: DataFrame, glob: str) -> DataFrame:
    """Rows whose key matches; the literal beginning of the pattern is a filter that the scan can use."""
    parsed, key = parse_glob(glob), F.col("key")
    if parsed.literal:
        return store.where(key == parsed.prefix)
    matching = store.where(key.startswith(parsed.prefix)) if parsed.prefix else store
    return matching.where(key.rlike(parsed.pattern))


def keys_in(store: DataFrame, names: list[str]) -> DataFrame:
    return store.where(F.col("key").isin(names))


def of_kind(store: DataFrame, kind: str) -> DataFrame:
    return store.where(F.col("kind") == kind)


def entry(key: Column, kind: str, field: Column, value: Column) -> list[Column]:
    return [
        key.alias("key"), F.lit(kind).alias("kind"), field.cast("string").alias("field"),
        value.cast("string").alias("value"),
    ]


def to_hashes(df: DataFrame, table: str, key_column: str | None = None) -> DataFrame:
    """Rows as hashes ``table:key -> {field: value}``; without a key column the key is random."""
    key = F.uuid() if key_column is None else F.col(key_column).cast("string")
    fields = [c for c in df.columns if c != key_column]
    texts = df.select(F.concat(F.lit(f"{table}:"), key).alias("key"), *[F.col(c).cast("string") for c in fields])
    long = texts.unpivot("key", fields, "field", "value").where(F.col("value").isNotNull())
    return long.select(*entry(F.col("key"), "hash", F.col("field"), F.col("value")))


def from_hashes(store: DataFrame, table: str, key_column: str, schema: StructType) -> DataFrame:
    """Wide typed rows of one hash table."""
    prefix = f"{table}:"
    rows = of_kind(store, "hash").where(F.col("key").startswith(prefix))
    fields = [f for f in schema.fields if f.name != key_column]
    wide = rows.groupBy("key").agg(
        *[F.max(F.when(F.col("field") == f.name, F.col("value"))).alias(f.name) for f in fields]
    )
    types = {f.name: f.dataType for f in schema.fields}
    key = F.substr(F.col("key"), F.lit(len(prefix) + 1)).cast(types[key_column]).alias(key_column)
    return wide.select(key, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def upsert(store: DataFrame, written: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Both inputs with one row per key, the one written last by ``order``."""
    both = store.unionByName(written)
    rest = [c for c in both.columns if c not in keys]
    last = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return last.select(*keys, "_row.*").select(*both.columns)
