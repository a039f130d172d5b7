"""Words of whole Arrow text columns as byte spans and 64-bit hashes, in numpy.

Texts stay UTF-8 bytes; no Python object is made per word. A null text counts as
empty. Words never cross rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts handled at once, in bytes; one longer text is handled alone.
CHUNK_BYTES = 2 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _table(separators: list[tuple[int, int]]) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    for first, last in separators:
        table[first : last + 1] = False
    return table


#: Bytes of words that white space separates.
SPACED = _table([(0x20, 0x20), (0x09, 0x0D)])
#: Bytes of words of letters, digits and all non-ASCII characters.
ALPHANUMERIC = _table([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit permutation that spreads every input bit over the result."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)
_LOWER_CODES = _BYTE_CODES[_LOWER]


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 to the 64."""
    inverse = pow(int(_MULTIPLIER), -1, 1 << 64)
    out = []
    for base in (int(_MULTIPLIER), inverse):
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64, out=steps))
    return out[0], out[1]


def _table_size(length: int) -> int:
    """One table serves all texts up to a chunk; longer ones get tables of their own."""
    return max(CHUNK_BYTES, length) + 1


def byte_sums(data: np.ndarray, codes: np.ndarray = _BYTE_CODES) -> np.ndarray:
    """Prefix sums from which ``span_hashes`` takes the hash of any span of ``data``."""
    powers, _ = _powers(_table_size(len(data)))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(codes[data] * powers[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, inverse = _powers(_table_size(len(sums) - 1))
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and the offsets of the rows in them."""
    column = column.cast(pa.large_string() if not pa.types.is_binary(column.type) else pa.large_binary())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of one piece have at most ``limit`` bytes, or it is one row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the number of words before it."""
    inside = table[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside
    before[offsets] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = inside
    after[offsets] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def lower_word_hashes(column: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words with A-Z lowered, then starts, ends and words before each row."""
    data, offsets = utf8(column)
    starts, ends, firsts = spans(data, offsets, table)
    return span_hashes(byte_sums(data, _LOWER_CODES), starts, ends), starts, ends, firsts
