"""Alignment of two tokenizers over the bytes of each text, by products of sparse incidence matrices.

Each text, with a space in front, is encoded by a byte-level tokenizer A and a piece tokenizer B
(which adds that space itself). A token-byte matrix has a row per token and a one for each byte
it covers, in compressed sparse rows. Row by row after Gustavson, A times the transpose of B gives for each token
of A the tokens of B it overlaps, with the bytes they share: the overlap links. Bytes where tokens of both end cut the tokens
into groups; the product of the two token-group matrices gives the links within groups. Its rows
may be long, so ``token_links`` emits them in blocks and ``align_documents`` only counts them
from the lengths of the rows.

Texts are encoded once and the counts of id pairs are kept per document; the sums over the
corpus, their largest per id of B, and their way back to the documents are Spark aggregates and
joins. The table of sums is broadcast only if it has been counted below ``BROADCAST_ROWS``.

Rows: null and empty texts have no tokens, nor have texts whose tokens do not spell them (such as
texts with U+2581, which B takes for a space); all their figures are zero and their hash
is ''. Strings of special tokens in a text are plain text. Repeated rows are documents of their own
and count each time; null ids stay. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspar.llm.token_output import Encoder, ranges
from larkspar.llm.words import chunks, utf8
from larkspar.session import cut_lineage, new_folder

#: Texts aligned at once, in bytes; links emitted at once; pair sums that are broadcast.
ALIGNED_BYTES = 1 << 20
LINK_ROWS = 1 << 18
BROADCAST_ROWS = 1_000_000
_LOADED: dict[tuple[str, str], tuple[BytePairs, Pieces]] = {}


class Csr(NamedTuple):
    """A sparse matrix of ones: columns of row i are ``columns[starts[i]:starts[i + 1]]``."""

    starts: np.ndarray
    columns: np.ndarray
    width: int

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))


def incidence(lengths: np.ndarray, columns: np.ndarray, width: int) -> Csr:
    return Csr(np.append(0, np.cumsum(lengths)), columns, width)


def transposed(m: Csr) -> Csr:
    order = np.argsort(m.columns, kind="stable")
    return incidence(np.bincount(m.columns, minlength=m.width), m.rows[order], len(m.starts) - 1)


def row_lengths(a: Csr, b: Csr) -> np.ndarray:
    """Products that each row of A times B adds up, before equal columns are combined."""
    added = np.append(0, np.cumsum(np.diff(b.starts)[a.columns]))
    return added[a.starts[1:]] - added[a.starts[:-1]]


def product(a: Csr, b: Csr, first: int = 0, last: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and values of A times B for some rows of A: each takes the rows of B that its columns name."""
    last = len(a.starts) - 1 if last is None else last
    inner = a.columns[a.starts[first] : a.starts[last]]
    lengths = np.diff(b.starts)[inner]
    columns = b.columns[ranges(b.starts[inner], lengths)]
    rows = np.repeat(np.repeat(np.arange(first, last), np.diff(a.starts[first : last + 1])), lengths)
    places = rows * b.width + columns
    if (places[1:] < places[:-1]).any():
        places = np.sort(places)
    new = np.flatnonzero(np.append(True, places[1:] != places[:-1])[: len(places)])
    values = np.diff(np.append(new, len(places)))
    return places[new] // b.width, places[new] % b.width, values


def _pool(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All parts one after the other, their starts and lengths."""
    lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    return np.frombuffer(b"".join(parts), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths


class BytePairs(Encoder):
    """Ids and bytes of a byte-level tokenizer file; strings of special tokens are plain text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        self.bytes = _pool(self.tokens)


class Pieces(Encoder):
    """Ids and bytes of a piece model that puts a space in front of each text.

    No piece has a space after another character, so texts are encoded in parts that start
    at a space after another character; texts given here start with the added space.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("texts cannot be cut at spaces: a piece has a space after another character")
        self.space = self.model.piece_to_id("▁")
        self.bytes = _pool([
            bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ])
        self.sizes = self.bytes[2]
        self.forget()

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        at = np.flatnonzero((data[1:] == 0x20) & (data[:-1] != 0x20)) + 1
        return np.setdiff1d(at, offsets, assume_unique=False)

    def ids_of(self, pieces: list[str]) -> list[list[int]]:
        found = self.model.encode([p[1:] for p in pieces], num_threads=1)
        return [ids or [self.space] for ids in found]


def _encoders(path_a: str, path_b: str) -> tuple[BytePairs, Pieces]:
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = BytePairs(path_a), Pieces(path_b)
    return _LOADED[path_a, path_b]


class _Side:
    """Tokens of one tokenizer over a chunk of texts."""

    def __init__(self, encoder: BytePairs | Pieces, column: pa.Array):
        self.letters, self.starts, self.lengths = encoder.bytes
        self.ids, self.counts = encoder.encode(column)

    def spells(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows whose tokens have the bytes of the row."""
        sizes = np.append(0, np.cumsum(self.lengths[self.ids]))
        firsts = np.append(0, np.cumsum(self.counts))
        same = np.diff(sizes[firsts]) == np.diff(offsets)
        ids = self.ids[np.repeat(same, self.counts)]
        spelled = self.letters[ranges(self.starts[ids], self.lengths[ids])]
        rows = np.flatnonzero(same)
        wrong = spelled != data[ranges(offsets[rows], np.diff(offsets)[rows])]
        bad = np.append(0, np.cumsum(wrong))
        ends = np.append(0, np.cumsum(np.diff(offsets)[rows]))
        same[rows] = np.diff(bad[ends]) == 0
        return same

    def keep(self, rows: np.ndarray) -> None:
        self.ids = self.ids[np.repeat(rows, self.counts)]
        self.counts = np.where(rows, self.counts, 0)
        self.ends = np.cumsum(self.lengths[self.ids])


class Alignment:
    """Tokens, groups and incidence matrices of a chunk of texts."""

    def __init__(self, column: pa.Array, path_a: str, path_b: str):
        column = column.cast(pa.large_string())
        spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), column, pa.scalar("", pa.large_string()))
        column = pc.if_else(pc.fill_null(pc.greater(pc.binary_length(column), 0), False), spaced, pa.scalar("", pa.large_string()))
        data, offsets = utf8(column)
        a, b = _encoders(path_a, path_b)
        self.a, self.b = _Side(a, column), _Side(b, column)
        good = self.a.spells(data, offsets) & self.b.spells(data, offsets)
        self.a.keep(good)
        self.b.keep(good)
        self.size = int(self.a.ends[-1]) if len(self.a.ends) else 0
        self.group_ends = np.intersect1d(self.a.ends, self.b.ends, assume_unique=True)
        self.group_a = np.searchsorted(self.group_ends, self.a.ends)
        self.group_b = np.searchsorted(self.group_ends, self.b.ends)
        self.row_a = np.repeat(np.arange(len(column)), self.a.counts)

    def overlaps(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of A and B that share bytes, and how many: token-byte A times the transpose of token-byte B."""
        bytes_ = np.arange(self.size)
        a = incidence(self.a.lengths[self.a.ids], bytes_, self.size)
        b = incidence(self.b.lengths[self.b.ids], bytes_, self.size)
        return product(a, transposed(b))

    def groups(self) -> tuple[Csr, Csr]:
        """The token-group matrix of A, and the transpose of that of B."""
        one = lambda side: np.ones(len(side.ids), dtype=np.int64)
        width = len(self.group_ends)
        return incidence(one(self.a), self.group_a, width), transposed(incidence(one(self.b), self.group_b, width))

    def spelled_groups(self) -> tuple[np.ndarray, np.ndarray]:
        """``a1,a2|b1;a3|b2`` of all rows one after the other, and where each token's part ends."""
        number = np.concatenate([self.a.ids, self.b.ids]).astype(np.int64)
        side = np.repeat([0, 1], [len(self.a.ids), len(self.b.ids)])
        place = np.concatenate([self.group_a, self.group_b]) * 2 + side
        order = np.argsort(place, kind="stable")
        number, place, side = number[order], place[order], side[order]
        digits, starts, lengths = _NUMBERS.of(int(number.max(initial=0)))
        ends = np.cumsum(lengths[number] + 1)
        text = np.full(ends[-1] if len(ends) else 0, ord(","), dtype=np.uint8)
        text[ranges(ends - 1 - lengths[number], lengths[number])] = digits[ranges(starts[number], lengths[number])]
        last = np.append(place[1:] != place[:-1], True)[: len(place)]
        text[ends[last] - 1] = np.where(side[last] == 0, ord("|"), ord(";"))
        return text, ends


class _Numbers:
    """Decimal digits of all integers up to the largest asked for."""

    def __init__(self):
        self.most = -1

    def of(self, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if most > self.most:
            self.most = most
            self.pool = _pool([b"%d" % i for i in range(most + 1)])
        return self.pool


_NUMBERS = _Numbers()
_PAIRS = pa.struct([("pair", pa.int64()), ("times", pa.int32())])


def _per_row(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    sums = np.append(0, np.cumsum(values))
    return sums[firsts[1:]] - sums[firsts[:-1]]


def _aligned(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches, "text", ALIGNED_BYTES):
            found = Alignment(piece.column("text"), path_a, path_b)
            n = piece.num_rows
            first_a, first_b = (np.append(0, np.cumsum(s.counts)) for s in (found.a, found.b))
            link_a, link_b, _ = found.overlaps()
            n_links = np.bincount(found.row_a[link_a], minlength=n)
            n_shared = _per_row(row_lengths(*found.groups()), first_a)
            n_groups = np.bincount(
                np.searchsorted(first_a, np.searchsorted(found.a.ends, found.group_ends), side="right") - 1, minlength=n
            )
            pair = found.b.ids[link_b].astype(np.int64) << 32 | found.a.ids[link_a]
            row = found.row_a[link_a]
            order = np.lexsort((pair, row))
            pair, row = pair[order], row[order]
            new = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (row[1:] != row[:-1]))[: len(pair)])
            times = np.diff(np.append(new, len(pair))).astype(np.int32)
            starts = np.searchsorted(row[new], np.arange(n + 1)).astype(np.int32)
            pairs = pa.ListArray.from_arrays(
                pa.array(starts), pa.StructArray.from_arrays([pa.array(pair[new]), pa.array(times)], fields=list(_PAIRS))
            )
            text, ends = found.spelled_groups()
            cuts = np.append(0, ends)[first_a + first_b]
            spelled = memoryview(text)
            hashes = [hashlib.sha256(spelled[a : b - 1]).hexdigest() if b > a else "" for a, b in zip(cuts, cuts[1:])]
            numbers = [pa.array(x.astype(np.int64)) for x in (found.a.counts, found.b.counts, n_groups, n_links, n_shared)]
            yield pa.RecordBatch.from_arrays(
                [piece.column("key"), *numbers, pa.array(hashes), pairs],
                ["key", "n_a", "n_b", "n_groups", "n_links", "n_shared", "groups_sha256", "pairs"],
            )

    return run


def align_documents(
    docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row ``key``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``, ``n_shared``.

    The count of an id pair is the number of links of the whole table between the two ids. ``n_best`` are
    the links with the highest count of their id of B, ``n_shared`` the pairs of tokens within groups.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    folder = new_folder(spark, "aligned")
    docs.select(docs[key].alias("key"), docs[text].alias("text")).mapInArrow(
        _aligned(path_a, path_b),
        f"key {kind}, n_a long, n_b long, n_groups long, n_links long, n_shared long, groups_sha256 string, "
        "pairs array<struct<pair: long, times: int>>",
    ).withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").option(
        "parquet.block.size", 16 << 20
    ).parquet(folder)
    stored = spark.read.parquet(folder)
    counts = cut_lineage(stored.select(F.inline("pairs")).groupBy("pair").agg(F.sum("times").alias("total")))
    owner = F.shiftright("pair", 32)
    tops = counts.groupBy(owner.alias("b")).agg(F.max("total").alias("top"))  # a row per id of B at most
    known = cut_lineage(
        counts.join(F.broadcast(tops), owner == F.col("b")).select("pair", "total", (F.col("total") == F.col("top")).alias("best"))
    )
    if known.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    scores = stored.select("row", F.inline("pairs")).join(known, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("total")).alias("count_sum"),
    )
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name)
    return stored.drop("pairs").join(scores, "row", "left").select(
        F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"),
        "groups_sha256", "n_shared",
    )


def _linked(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches, "text", ALIGNED_BYTES):
            found = Alignment(piece.column("text"), path_a, path_b)
            link_a, link_b, shared = found.overlaps()
            width = max(1, len(found.b.ids))
            known = link_a * width + link_b
            matrices = found.groups()
            before = np.append(0, np.cumsum(row_lengths(*matrices)))
            first_a, first_b = (np.append(0, np.cumsum(s.counts)) for s in (found.a, found.b))
            start = 0
            while start < len(found.a.ids):
                stop = max(start + 1, int(np.searchsorted(before, before[start] + LINK_ROWS, side="right")) - 1)
                a, b, _ = product(*matrices, start, stop)
                at = np.minimum(np.searchsorted(known, a * width + b), len(known) - 1)
                bytes_ = np.where(known[at] == a * width + b, shared[at], 0)
                row = found.row_a[a]
                group = found.group_a[a] - found.group_a[first_a[row]]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("key").take(pa.array(row)), *[
                            pa.array(x.astype(np.int64)) for x in (
                                a - first_a[row], found.a.ids[a], b - first_b[row], found.b.ids[b], group, bytes_
                            )
                        ],
                    ],
                    ["key", "a", "a_id", "b", "b_id", "group", "n_bytes"],
                )
                start = stop

    return run


def token_links(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each pair of tokens within a group: places and ids of both, the group, and the bytes they share (0: none)."""
    kind = docs.schema[key].dataType.simpleString()
    links = docs.select(docs[key].alias("key"), docs[text].alias("text")).mapInArrow(
        _linked(path_a, path_b), f"key {kind}, a long, a_id long, b long, b_id long, `group` long, n_bytes long"
    )
    return links.withColumnRenamed("key", key)
