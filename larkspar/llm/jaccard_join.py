"""Exact Jaccard similarity join of word shingles by parity sketches, and its components.

Documents with equal shingle sets form a class; classes are joined. A parity sketch flips one
bit per shingle, so the Hamming distance of two sketches is at most the size of the symmetric
difference of their sets. Sizes fall into overlapping bands, such that two sets that may be
similar share a band, and in a band the symmetric difference of a similar pair is at most
d. The hash space is cut into as many parts as leave ``PART`` shingles of a set in each: a pair whose
sets differ in D shingles differs in at most D / parts of them in one part at least. The shingles of a
part are dealt to more than d / parts blocks, each with the fingerprint (XOR of hashes) of a very
long parity sketch: by the pigeonhole principle a similar pair has an equal block in that part.
Parts without enough non-empty blocks also emit their empty ones;
all others leave them out, so no block is shared for being empty.

Equal blocks make candidates (see ``links``); only pairs within the size and Hamming bounds of
the parity sketches of the block's part are emitted, and their texts are fetched and compared. A sketch
covers one part, so it does not fill up with the size of a set, and no row carries more than one.
All links between different components are found, so components are exact.

Shingles are compared by 64-bit hashes of their words. Words have A-Z lowered.

Rows: null and empty texts, and texts without words, have no shingles and link with
nothing; shorter texts than a shingle are one shingle. Repeated rows are one class. The
component of rows without id is null unless a linked row has one. An empty table gives an
empty result. Other columns are not read; ``keep_one`` keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from larkspar.llm.links import (
    Links, block_lists, component_rows, first_seen, one_of_each, parity_sketch, set_verifier, sketch_lists, slim,
)
from larkspar.llm.words import SPACED, chunks, lower_word_hashes, mix

#: Bits of a sketch; pieces of it that are one for hubs; shingles that a part has at most in the smaller set of a pair, on average.
SKETCH_BITS = 1024
FOLD = 4
PART = 256
NO_SKETCH = np.zeros((0, 1 + SKETCH_BITS // 64), dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(column: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashes, _, _, firsts = lower_word_hashes(column, SPACED)
    rolled = np.zeros(len(hashes), dtype=np.uint64)
    for k in range(min(words, max(1, len(hashes)))):
        rolled[: len(hashes) - k] = rolled[: len(hashes) - k] * _ODD + mix(hashes[k:] + np.uint64(k + 1))
    rolled = mix(rolled)
    sets = []
    for a, b in pairwise(firsts.tolist()):
        if b - a >= words:
            found = np.sort(rolled[a : b - words + 1])
            sets.append(found[np.append(True, found[1:] != found[:-1])])
        elif b > a:
            whole = np.full(1, b - a, dtype=np.uint64)
            for k in range(a, b):
                whole = mix(whole * _ODD + hashes[k : k + 1])
            sets.append(whole)
        else:
            sets.append(hashes[:0])
    return sets


class Bands:
    """Size bands of a similarity num / den and their blocks."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.starts = [1]

    def _until(self, size: int) -> None:
        while self.starts[-1] <= size:
            self.starts.append(max(self.starts[-1] + 1, self.starts[-1] * 5 // 4))

    def of(self, size: int) -> Iterator[tuple[int, int, int]]:
        """Bands of a set, the largest symmetric difference of similar pairs there, equal sets aside, and the parts."""
        self._until(size * 2 + 2)
        for band, (low, high) in enumerate(pairwise(self.starts)):
            if low > size:
                break
            if size * self.num <= (high - 1) * self.den:
                d = (high - 1) * (self.den - self.num) // self.num
                if d:
                    yield band, d, 1 << max(0, (high - 2) // PART).bit_length()

    def keys(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Blocks of a sorted set, the slot of each one's sketch, and the sketches with their number of parts, by slot."""
        keys, slots, lines, first = [], [], [], {}
        for band, whole, parts in self.of(len(shingles)):
            if parts not in first:
                first[parts] = sum(first)
                bits = parity_sketch(shingles, parts * SKETCH_BITS).reshape(parts, -1)
                lines.append(np.column_stack([np.full(parts, parts, dtype=np.uint64), bits]))
            d = whole // parts
            count = d + 1 + (d + 7) // 8
            part = shingles >> np.uint64(64 - parts.bit_length() + 1) if parts > 1 else np.uint64(0)
            block = (mix(shingles + np.uint64(band)) >> np.uint64(32)) % np.uint64(count) + part * np.uint64(count)
            order = np.argsort(block, kind="stable")
            cuts = np.flatnonzero(np.diff(block[order], prepend=np.uint64(parts * count)))
            prints = np.bitwise_xor.reduceat(mix(shingles[order] ^ _ODD), cuts)
            blocks = block[order][cuts]
            held = np.bincount((blocks // np.uint64(count)).astype(np.int64), minlength=parts)
            if (held <= d).any():
                short = np.repeat(held <= d, count)
                short[blocks.astype(np.int64)] = False
                empty = np.flatnonzero(short).astype(np.uint64)
                blocks = np.concatenate([blocks, empty])
                prints = np.concatenate([prints, np.zeros(len(empty), dtype=np.uint64)])
            keys.append(mix(prints + mix(blocks * _ODD + np.uint64(band + 1))))
            slots.append(first[parts] + (blocks // np.uint64(count)).astype(np.int32))
        if not keys:
            return shingles[:0], np.zeros(0, dtype=np.int32), NO_SKETCH
        return np.concatenate(keys), np.concatenate(slots), np.concatenate(lines)


def _prepared(words: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(num, den)
        emitted: set[int] = set()
        for piece in chunks(batches, "text"):
            sets = shingle_sets(piece.column("text"), words)
            sizes = np.array([len(s) for s in sets], dtype=np.uint64)
            sums = np.array([np.add.reduce(mix(s + _ODD)) if len(s) else 0 for s in sets], dtype=np.uint64)
            classes = mix(sums + sizes * _ODD).view(np.int64)
            found = [bands.keys(s if new else s[:0]) for s, new in zip(sets, first_seen(classes, emitted))]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("key"), piece.column("hash"), pa.array(sizes.astype(np.int64)), pa.array(classes),
                    sketch_lists([lines for _, _, lines in found]),
                    block_lists([keys for keys, _, _ in found], [slots for _, slots, _ in found]),
                ],
                ["key", "hash", "n", "cls", "sketches", "keys"],
            )

    return run


def _search(docs: DataFrame, key: str, words: int, num: int, den: int) -> DataFrame:
    return Links(
        slim(docs, key), _prepared(words, num, den), set_verifier(lambda texts: shingle_sets(texts, words), num, den),
        num, den, SKETCH_BITS // 64,
        lambda flipped, sizes, parts: sum(flipped[1:], flipped[0]) * parts * (den + num) <= sizes * (den - num), fold=FOLD,
    ).labelled_rows()


def link_documents(docs: DataFrame, key: str = "doc_id", words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Per row ``key``, ``n_shingles`` and ``component_id``, the least key that links reach."""
    return component_rows(_search(docs, key, words, num, den), key)


def keep_one(docs: DataFrame, key: str = "doc_id", words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the one with the least key, and all without shingles."""
    return one_of_each(docs, _search(docs, key, words, num, den), key)
