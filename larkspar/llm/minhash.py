"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

A sketch has ``COORDINATES`` coordinates. Rounds of hashed bin placement fill them: in round i
each shingle of a set falls into one bin with one value, a bin that earlier rounds left empty
keeps the least value of the round, and filled bins stay. Large sets are done after a
round or two. After as many rounds as there are coordinates, round COORDINATES + i puts
all shingles into bin i, so every coordinate fills whatever the size of the set. Two
sets agree in a coordinate with a probability of their similarity, and the number of agreements is
concentrated around that share. ``ROWS`` coordinates at a time are the key of a band; similar sets
share one: at a similarity of 0.8, 32 bands of four miss a pair with a probability below 1e-7,
and a document with several near copies is missed only if all its pairs are.

One bit of each coordinate is the sketch that a candidate pair is first compared by; pairs
whose bits differ in more than ``APART`` places are left (a similar pair differs in 13 of 128 on
average; more than 48 have a probability below 1e-15). Beside them lie ``PARITY_BITS``
parity bits of the set, whose distance never exceeds the number of shingles that only one set has, so
no similar pair is lost there. What passes both is compared by whole shingle sets, as 64-bit hashes. ``links`` says how the pairs of large groups are kept from being emitted.

Words have A-Z lowered. Rows: null and empty texts, and texts without words, have no shingles and link
with nothing; texts shorter than a shingle are one. Equal sets are one class, repeated rows as
well. The component of rows without id is null unless a linked row has one; such a row is kept if
no linked row has an id (``kept`` is then true for all of them). An empty table gives an empty
result. Other columns are not read; ``drop_near_duplicates`` keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspar.llm.jaccard_join import shingle_sets
from larkspar.llm.links import (
    Links, block_lists, component_rows, first_seen, one_of_each, parity_sketch, set_verifier, sketch_lists, slim,
)
from larkspar.llm.words import chunks, mix

COORDINATES = 128
ROWS = 4
APART = 48
PARITY_BITS = 512
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = mix(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * _ODD)
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """The coordinates of each set, one row each; sets must not be empty. Zero is a bin without a value yet."""
    size = COORDINATES
    held = np.zeros((len(sets), size), dtype=np.uint64)
    left = np.arange(len(sets))
    values = np.concatenate([*sets, np.zeros(0, np.uint64)])
    rows = np.repeat(left, [len(s) for s in sets])
    for turn in range(2 * size):
        placed = mix(values + _SEEDS[turn])
        if turn < size:
            bins = (mix(placed ^ _ODD) % np.uint64(size)).astype(np.int64)
        else:
            bins = np.full(len(rows), turn - size)
        least = np.full((len(left), size), _MOST, dtype=np.uint64)
        np.minimum.at(least.reshape(-1), rows * size + bins, placed)
        open_bins = held[left] == 0
        held[left] = np.where(open_bins & (least != _MOST), least, held[left])
        going = (open_bins & (least == _MOST)).any(axis=1)
        if not going.any():
            break
        if not going.all():  # rows of full sketches leave; the others are numbered anew
            stays = going[rows]
            values, rows, left = values[stays], (np.cumsum(going) - 1)[rows[stays]], left[going]
    return held


def band_keys(held: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One key for each band of each sketch."""
    parts = held.reshape(len(held), held.shape[1] // rows, rows)
    keys = np.zeros(parts.shape[:2], dtype=np.uint64)
    for i in range(rows):
        keys = mix(keys * _ODD + parts[:, :, i])
    return mix(keys + np.arange(1, parts.shape[1] + 1, dtype=np.uint64) * _ODD)


def _prepared(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emitted: set[int] = set()
        for piece in chunks(batches, "text"):
            sets = shingle_sets(piece.column("text"), words)
            sizes = np.array([len(s) for s in sets], dtype=np.uint64)
            sums = np.array([np.add.reduce(mix(s + _ODD)) if len(s) else 0 for s in sets], dtype=np.uint64)
            classes = mix(sums + sizes * _ODD).view(np.int64)
            none = np.zeros(0, dtype=np.uint64)
            bits, keys = [none.reshape(0, 1)] * len(sets), [none] * len(sets)
            full = np.flatnonzero(sizes)
            held = sketches([sets[i] for i in full])
            packed = np.packbits((held & np.uint64(1)).astype(np.uint8), axis=1).view(np.uint64)
            new = first_seen(classes, emitted)
            for i, row, key in zip(full.tolist(), packed, band_keys(held)):
                if new[i]:
                    bits[i] = np.concatenate([[np.uint64(1)], row, parity_sketch(sets[i], PARITY_BITS)])[None]
                    keys[i] = key
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("key"), piece.column("hash"), pa.array(sizes.astype(np.int64)), pa.array(classes),
                    sketch_lists(bits), block_lists(keys, [np.zeros(len(k), dtype=np.int32) for k in keys]),
                ],
                ["key", "hash", "n", "cls", "sketches", "keys"],
            )

    return run


def _search(docs: DataFrame, key: str, words: int, num: int, den: int) -> DataFrame:
    if 10 * num < 8 * den:
        raise ValueError("bands and sketches are laid out for a similarity of 0.8 or more")
    whole = COORDINATES // 64

    def apart(flipped: list[Column], sizes: Column, parts: Column) -> Column:
        coordinates = sum(flipped[1:whole], flipped[0])
        parity = sum(flipped[whole + 1 :], flipped[whole])
        return (coordinates <= APART) & (parity * (den + num) <= sizes * (den - num))

    return Links(
        slim(docs, key), _prepared(words), set_verifier(lambda texts: shingle_sets(texts, words), num, den), num, den,
        whole + PARITY_BITS // 64, apart, slices=2,
    ).labelled_rows()


def near_duplicates(docs: DataFrame, key: str = "doc_id", words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Per row ``key``, ``n_shingles``, ``component_id`` (the least key that links reach) and ``kept``."""
    found = component_rows(_search(docs, key, words, num, den), key)
    return found.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


def drop_near_duplicates(
    docs: DataFrame, key: str = "doc_id", words: int = 5, num: int = 80, den: int = 100
) -> DataFrame:
    """The rows of ``docs`` that near-duplicate removal keeps: one of each component, and all without shingles."""
    return one_of_each(docs, _search(docs, key, words, num, den), key)
