"""Token ids in ORC files, in document order.

Texts are encoded with a public tokenizer, an end id closes each document, and the ids
are written as ORC: stripes of run-length encoded integers with row indexes, and a Bloom
filter on the document id. Files are ranges of document ids in ascending order, so a
reader of some ids skips files, stripes and row groups by their metadata, and stripes
are read in parallel.

Words are encoded once per worker and remembered; the text is cut before each single
space between two other characters, where no token of a byte-level pair encoding
whose words take a leading space can cross. Memory of a worker is bounded by ``REMEMBERED``.

Rows: a null or empty text is the end id alone. Equal ids keep together, ordered by a
hash of their text; null ids come first. Repeated rows are documents of their own. An empty
table writes no rows. Columns other than the id and the text are not written.
"""

from __future__ import annotations

import itertools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspar.llm.words import byte_sums, chunks, mix, span_hashes, utf8

#: Pieces of text a worker remembers the ids of, about 45 bytes each.
REMEMBERED = 400_000
#: Texts encoded at once, in bytes.
ENCODED_BYTES = 1 << 19
#: New pieces that are encoded as one text, in bytes.
TEXT_BYTES = 2048
STRIPE_BYTES = 16 << 20
_LOADED: dict[str, Encoder] = {}
_OTHER_CODES = mix(np.arange(1001, 1257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
#: ASCII white space and separators; of longer characters, the first byte and those that complete white space.
_ASCII_SPACE = np.isin(np.arange(256), [*range(0x09, 0x0E), *range(0x1C, 0x21)])
_WIDE_SPACES = [b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80"] + [
    bytes([0xE2, 0x80, x]) for x in (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)
]


def borders(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Spaces between two characters of the same row that are no white space."""
    at = np.flatnonzero(data == 0x20)
    row = np.searchsorted(offsets, at, side="right") - 1
    at = at[(at > offsets[row]) & (at + 1 < offsets[row + 1])]
    bad = _ASCII_SPACE[data[at - 1]] | _ASCII_SPACE[data[at + 1]]
    wide = np.flatnonzero((data[at - 1] >= 0x80) | (data[at + 1] >= 0x80))
    padded = np.concatenate([np.zeros(3, np.uint8), data, np.zeros(3, np.uint8)])
    for space in _WIDE_SPACES:
        before = np.ones(len(wide), dtype=bool)
        after = np.ones(len(wide), dtype=bool)
        for k, byte in enumerate(space):
            before &= padded[at[wide] + 3 - len(space) + k] == byte
            after &= padded[at[wide] + 4 + k] == byte
        bad[wide] |= before | after
    return at[~bad]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the given ranges, one range after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def byte_level_tokens(tokenizer) -> list[bytes]:
    """The bytes of all ids of a byte-level vocabulary, whose letters stand for one byte each."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    codes = {chr(b): b for b in plain}
    codes |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    tokens = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for entry, number in tokenizer.get_vocab(with_added_tokens=True).items():
        tokens[number] = entry.encode()
    for entry, number in tokenizer.get_vocab(with_added_tokens=False).items():
        tokens[number] = bytes(codes.get(c, 0) for c in entry)
    return tokens


class Encoder:
    """A tokenizer file with a memory of the pieces it has encoded, found by two 64-bit hashes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Bytes of each token; added ones stand for their own text.
        self.tokens = byte_level_tokens(self.tokenizer)
        self.sizes = np.fromiter(map(len, self.tokens), dtype=np.int64, count=len(self.tokens))
        self.forget()

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the texts may be cut besides their starts."""
        return borders(data, offsets)

    def ids_of(self, pieces: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def forget(self) -> None:
        self.hashes = self.checks = np.zeros(0, dtype=np.uint64)
        self.starts = self.lengths = np.zeros(0, dtype=np.uint32)
        self.pool = np.zeros(0, dtype=np.int32)

    def find(self, hashes: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the hashes, which are sorted, and whether they are remembered there."""
        if not len(self.hashes):
            return np.zeros(len(hashes), dtype=np.int64), np.zeros(len(hashes), dtype=bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, (self.hashes[at] == hashes) & (self.checks[at] == checks)

    def learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, checks: np.ndarray) -> None:
        """Encode new pieces, many of them as one text where they may stand side by side, and remember their ids.

        The bytes of the tokens tell which ids belong to which piece; where they do not add up
        to the text, its pieces are encoded one by one.
        """
        sizes = ends - starts
        after = np.cumsum(sizes)
        before = after - sizes
        joined = data[ranges(starts, sizes)]
        whole = joined.tobytes()
        apart = ~np.isin(before, self.cuts(joined, np.array([0, len(joined)])))
        text = np.cumsum(apart | np.append(True, np.diff(before // TEXT_BYTES) > 0)) - 1
        first = np.flatnonzero(np.append(True, np.diff(text) > 0))
        ids, counts = self._flat([whole[a:b].decode() for a, b in zip(before[first], np.append(before[first[1:]], len(joined)))])
        tokens = np.append(0, np.cumsum(counts))
        reached = np.append(0, np.cumsum(self.sizes[ids]))
        spelled = np.diff(reached[tokens]) == np.diff(np.append(before[first], len(joined)))
        shift = (before[first] - reached[tokens[:-1]])[text]  # what earlier texts that do not add up have shifted
        opens = np.append(True, np.diff(text) > 0)
        stop = np.minimum(np.searchsorted(reached, after - shift), len(reached) - 1)
        begin = np.where(opens, tokens[text], np.append(0, stop[:-1]))
        good = spelled[text] & (reached[stop] == after - shift)
        good &= opens | np.append(True, good[:-1])
        lengths = np.where(good, stop - begin, 0)
        kept = ids[ranges(begin[good], lengths[good])]
        self._remember(kept, lengths[good], hashes[good], checks[good])
        rest = np.flatnonzero(~good)
        if len(rest):
            ids, lengths = self._flat([whole[a:b].decode() for a, b in zip(before[rest], after[rest])])
            self._remember(ids, lengths, hashes[rest], checks[rest])

    def _flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found: list[list[int]] = []
        for start in range(0, len(texts), 20_000):
            found += self.ids_of(texts[start : start + 20_000])
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(itertools.chain.from_iterable(found), dtype=np.int32, count=int(lengths.sum())), lengths

    def _remember(self, ids: np.ndarray, lengths: np.ndarray, hashes: np.ndarray, checks: np.ndarray) -> None:
        starts = (len(self.pool) + np.cumsum(lengths) - lengths).astype(np.uint32)
        order = np.argsort(hashes)
        place = np.searchsorted(self.hashes, hashes[order])
        self.hashes = np.insert(self.hashes, place, hashes[order])
        self.checks = np.insert(self.checks, place, checks[order])
        self.starts = np.insert(self.starts, place, starts[order])
        self.lengths = np.insert(self.lengths, place, lengths[order].astype(np.uint32))
        self.pool = np.concatenate([self.pool, ids])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the number of ids of each."""
        data, offsets = utf8(column)
        filled = offsets[:-1][np.diff(offsets) > 0]
        starts = np.sort(np.concatenate([filled, self.cuts(data, offsets)]))
        if not len(starts):
            return np.zeros(0, dtype=np.int32), np.zeros(len(column), dtype=np.int64)
        ends = np.append(starts[1:], len(data))
        hashes = span_hashes(byte_sums(data), starts, ends)
        checks = span_hashes(byte_sums(data, _OTHER_CODES), starts, ends)
        order = np.argsort(hashes)
        sorted_, checks = hashes[order], checks[order]
        distinct = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))  # equal pieces are looked up once
        piece = np.empty(len(order), dtype=np.int64)
        piece[order] = np.repeat(np.arange(len(distinct)), np.diff(np.append(distinct, len(order))))
        hashes, checks, example = sorted_[distinct], checks[distinct], order[distinct]
        at, known = self.find(hashes, checks)
        if not known.all():
            if len(self.hashes) + np.count_nonzero(~known) > REMEMBERED:
                self.forget()
                known[:] = False
            new = np.sort(example[~known])  # in the order of the text
            back = np.flatnonzero(~known)[np.argsort(example[~known])]
            self.learn(data, starts[new], ends[new], hashes[back], checks[back])
            at, _ = self.find(hashes, checks)
        at = at[piece]
        lengths = self.lengths[at].astype(np.int64)
        sums = np.append(0, np.cumsum(lengths))
        ids = self.pool[ranges(self.starts[at].astype(np.int64), lengths)]
        return ids, np.diff(sums[np.searchsorted(starts, offsets)])


def encoder(path: str) -> Encoder:
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def encoding(path: str, end_id: int):
    """Arrow batches (key, text) to (key, part_start, n_tokens, ids); ``part_start`` counts the ids of earlier rows of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path)
        total = 0
        for batch in chunks(batches, "text", ENCODED_BYTES):
            found, lengths = tokens.encode(batch.column("text"))
            offsets = np.append(0, np.cumsum(lengths + 1))
            ids = np.full(offsets[-1], end_id, dtype=np.int32)
            ids[ranges(offsets[:-1], lengths)] = found
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
            starts = pa.array(offsets[:-1] + total)
            total += int(offsets[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), starts, pa.array(lengths + 1), lists], ["key", "part_start", "n_tokens", "ids"]
            )

    return run


def write_token_ids(
    docs: DataFrame, folder: str, tokenizer_path: str, key: str = "doc_id", text: str = "text", end_id: int = 0,
    stripe_bytes: int = STRIPE_BYTES,
) -> None:
    """Write the ids of ``docs`` to ``folder``: columns key, part, part_start, n_tokens, ids."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    laid = rows.repartitionByRange("key").sortWithinPartitions("key", F.xxhash64("text"), "text")
    ids = laid.mapInArrow(encoding(tokenizer_path, end_id), f"key {kind}, part_start long, n_tokens long, ids array<int>")
    (
        ids.withColumn("part", F.spark_partition_id())
        .write.format("orc")
        .option("orc.stripe.size", stripe_bytes).option("orc.row.index.stride", 1000)
        .option("orc.bloom.filter.columns", "key").option("orc.bloom.filter.fpp", 0.01)
        .option("compression", "zstd").save(folder)
    )


def checksum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        offsets = lists.offsets.to_numpy()
        data = memoryview(lists.values.to_numpy().astype("<u4", copy=False)).cast("B")
        sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(offsets, offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("part"), batch.column("part_start"),
             pa.array(np.diff(offsets).astype(np.int64)), pa.array(sums, pa.int64())],
            ["key", "part", "part_start", "n_tokens", "ids_crc32"],
        )


def read_token_ids(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """Per document of the files: its id, ``start`` (ids before it), ``n_tokens`` and ``ids_crc32``.

    The base of each file is the sum over the files before it; there is one row per file.
    """
    stored = spark.read.orc(folder)
    kind = stored.schema["key"].dataType.simpleString()
    rows = stored.select("key", "part", "part_start", "ids").mapInArrow(
        checksum, f"key {kind}, part int, part_start long, n_tokens long, ids_crc32 long"
    )
    ends = spark.read.orc(folder).groupBy("part").agg(F.max(F.col("part_start") + F.col("n_tokens")).alias("_ids"))
    earlier = Window.partitionBy(F.lit(1)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = ends.select("part", F.coalesce(F.sum("_ids").over(earlier), F.lit(0)).alias("_base"))
    return rows.join(F.broadcast(base), "part").select(
        F.col("key").alias(key), (F.col("_base") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32"
    )
