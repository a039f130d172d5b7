"""Remove every byte of strings of ``length`` bytes that start anywhere else, by merged BWTs.

Each start of such a string belongs to an anchor: the place in its window whose 32-byte
hash is least. Equal strings have equal anchors at equal offsets, so the starts of an anchor
hash are decided apart from all others. Only anchors whose hash repeats go on; equal
regions around an anchor are combined before they meet, with their number. Up to there
regions are hashes and places; bytes are cut from the texts for one region of each kind only.
A row is named by two hashes (96 bits) of its key and text, the same in each pass.

The regions of an anchor come together in buckets of bounded size, cut into blocks of
``BLOCK`` bytes aligned at the anchor, and dealt to shards. Each shard has the
Burrows-Wheeler transform of its block sequences; the transforms are merged by refining
their interleave, a stable sort by the preceding block per step, which after k steps orders
all suffixes by k blocks without sorting them again. Intervals that are still together
after as many blocks as a string holds at least are the repeats; the bytes at their edges
are then checked exactly by the hashes of the whole strings.

Rows: a null text is empty. Texts shorter than ``length`` are kept whole. Matches stay
inside a text; the same string twice in one text, overlapping or not, is a repeat. Repeated
rows are documents of their own and remove each other. Removed bytes may leave broken UTF-8,
so kept bytes are binary. An empty table gives an empty result. Columns other than the key
are not kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspar.llm.decontamination import expand, suffix_array
from larkspar.llm.words import byte_sums, chunks, mix, span_hashes, utf8
from larkspar.session import new_folder

LENGTH = 400
ANCHOR = 32
BLOCK = 16
SHARDS = 4
BUCKET_BYTES = 1 << 20
ROW = ["id", "id2"]
REGION = {"anchor": pa.int64(), "region": pa.int64(), "start": pa.int32(), "offset": pa.int32(), "size": pa.int32()}


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the first least value in each window of ``width`` values."""
    n = len(values) - width + 1
    order = np.argsort(values, kind="stable")
    rank = np.empty(len(values), dtype=np.int64)
    rank[order] = np.arange(len(values))
    padded = np.append(rank, np.full(-len(rank) % width, len(rank))).reshape(-1, width)
    forward = np.minimum.accumulate(padded, axis=1).ravel()
    backward = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return order[np.minimum(backward[:n], forward[width - 1 : width - 1 + n])]


def _regions(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches, "text", 1 << 20):
            data, offsets = utf8(piece.column("text"))
            sums = byte_sums(data)
            parts = []
            for row, (a, b) in enumerate(pairwise(offsets.tolist())):
                if b - a < length:
                    continue
                at = np.arange(a, b - ANCHOR + 1)
                grams = span_hashes(sums, at, at + ANCHOR)
                anchors = window_minima(grams, length - ANCHOR + 1)
                cuts = np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1]))
                lasts = np.append(cuts[1:], len(anchors)) - 1
                place = anchors[cuts]
                begin, end = a + cuts, a + lasts + length
                same = mix(span_hashes(sums, begin, end) + (place - cuts).astype(np.uint64))
                parts.append(
                    (np.full(len(cuts), row), grams[place].view(np.int64), same.view(np.int64), cuts, place - cuts, end - begin)
                )
            rows, *columns = [np.concatenate(c) for c in zip(*parts)] if parts else [[]] * (1 + len(REGION))
            names = [piece.column(c).take(pa.array(rows, pa.int64())) for c in ROW]
            yield pa.RecordBatch.from_arrays(
                names + [pa.array(c, k) for c, k in zip(columns, REGION.values())], ROW + list(REGION)
            )

    return run


def merge_transforms(transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the shards' suffixes in the order of their first ``depth`` symbols, and intervals of equal ones.

    Symbol 0 ends a sequence and equals nothing.
    """
    shard = np.repeat(np.arange(len(transforms)), [len(t) for t in transforms])
    interval = np.zeros(len(shard), dtype=np.int64)
    before = np.empty(len(shard), dtype=np.int64)
    for _ in range(depth):
        for s, transform in enumerate(transforms):
            before[shard == s] = transform
        order = np.argsort(before, kind="stable")
        symbol, came = before[order], interval[order]
        new = np.append(True, (symbol[1:] != symbol[:-1]) | (came[1:] != came[:-1]) | (symbol[1:] == 0))
        shard, interval = shard[order], np.cumsum(new)
    return shard, interval


def repeated_starts(regions: list[bytes], offsets: np.ndarray, length: int) -> list[np.ndarray]:
    """For each region the starts, from its own, of strings that also start elsewhere in the regions."""
    data = np.frombuffer(b"".join(regions), dtype=np.uint8)
    sizes = np.array([len(r) for r in regions])
    origin = np.cumsum(sizes) - sizes
    sums = byte_sums(data)
    left = offsets // BLOCK
    blocks = left + (sizes - offsets) // BLOCK
    first = origin + offsets - left * BLOCK
    at = np.repeat(first, blocks) + BLOCK * expand(np.zeros(len(blocks), dtype=np.int64), blocks)
    _, symbols = np.unique(span_hashes(sums, at, at + BLOCK), return_inverse=True)
    owner = np.repeat(np.arange(len(regions)), blocks)
    number = expand(np.zeros(len(blocks), dtype=np.int64), blocks)

    transforms, suffixes = [], []
    for s in range(SHARDS):
        mine = np.flatnonzero(owner % SHARDS == s)
        ends = np.flatnonzero(np.append(owner[mine][1:] != owner[mine][:-1], True)) + 1 if len(mine) else mine
        text = np.insert(symbols[mine].astype(np.int64) + 1, ends, 0)
        where = np.insert(mine, ends, -1)
        order = suffix_array(text)
        transforms.append(text[order - 1])
        suffixes.append(where[order])
    depth = (length - BLOCK + 1) // BLOCK
    shard, interval = merge_transforms(transforms, depth)
    together = np.bincount(interval)[interval] > 1
    found = np.empty(len(shard), dtype=np.int64)
    for s, suffix in enumerate(suffixes):
        found[shard == s] = suffix
    found = found[together & (found >= 0)]

    region = owner[found]
    back = left[region] - number[found]  # blocks between the suffix and the anchor
    starts = (offsets[region] - back * BLOCK)[:, None] - np.arange(BLOCK)
    region = np.repeat(region, BLOCK)
    starts = starts.ravel()
    good = (starts >= 0) & (starts + length <= sizes[region])
    region, starts = region[good], starts[good]
    places = np.sort(origin[region] + starts)
    places = places[np.append(True, places[1:] != places[:-1])] if len(places) else places
    region = np.searchsorted(origin, places, side="right") - 1
    starts = places - origin[region]
    strings = span_hashes(sums, origin[region] + starts, origin[region] + starts + length)
    _, same, count = np.unique(strings, return_inverse=True, return_counts=True)
    hit = count[same] > 1
    starts = starts[hit]
    cut = np.searchsorted(region[hit], np.arange(len(regions) + 1))
    return [starts[a:b] for a, b in zip(cut, cut[1:])]


def _deciding(length: int):
    def decide(held: list[tuple]) -> pa.RecordBatch:
        anchors, names, offsets, counts, texts = zip(*held)
        found = repeated_starts(list(texts), np.array(offsets), length)
        spans = []
        for text, count, starts in zip(texts, counts, found):
            if count > 1:
                starts = np.arange(len(text) - length + 1)
            breaks = np.flatnonzero(np.diff(starts) > 1)
            low = starts[np.append(0, breaks + 1)] if len(starts) else starts
            high = starts[np.append(breaks, len(starts) - 1)] if len(starts) else starts
            spans.append([{"low": int(a), "high": int(b) + length} for a, b in zip(low, high)])
        kind = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
        return pa.RecordBatch.from_arrays(
            [pa.array(anchors, pa.int64()), pa.array(names, pa.int64()), pa.array(spans, kind)], ["anchor", "region", "spans"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        anchor, met = None, set()
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "region", "offset", "n", "bytes"))):
                if row[0] != anchor:
                    anchor, met = row[0], set()
                    if size >= BUCKET_BYTES:
                        yield decide(held)
                        held, size = [], 0
                if row[1] in met:  # cut from several equal rows
                    continue
                met.add(row[1])
                held.append(row)
                size += len(row[4])
        if held:
            yield decide(held)

    return run


def _slicer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted regions of each text."""
    for piece in chunks(batches, "text", 1 << 20):
        out = {c: [] for c in ("anchor", "region", "n", "offset", "bytes")}
        for text, wanted in zip(piece.column("text").to_pylist(), piece.column("wanted").to_pylist()):
            data = text.encode()
            for w in wanted:
                for c in ("anchor", "region", "n", "offset"):
                    out[c].append(w[c])
                out["bytes"].append(data[w["start"] : w["start"] + w["size"]])
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out.values(), kinds)], list(out))


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in chunks(batches, "text"):
        out = []
        for text, spans in zip(piece.column("text").to_pylist(), piece.column("spans").to_pylist()):
            data = (text or "").encode()
            merged: list[list[int]] = []
            for low, high in sorted((s["low"], s["high"]) for s in spans or ()):
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], high)
                else:
                    merged.append([low, high])
            kept, at = [], 0
            for low, high in merged:
                kept.append(data[at:low])
                at = high
            rest = b"".join(kept) + data[at:]
            out.append((len(data), len(data) - len(rest), len(merged), hashlib.sha256(rest).hexdigest(), rest))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [piece.column("key"), *[pa.array(c, k) for c, k in zip(zip(*out), kinds)]],
            ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def _stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder, smaller than a checkpoint of them."""
    folder = new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.parquet(folder)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row ``key``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and the ``kept`` bytes."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    rows = rows.withColumns({"id": F.xxhash64("key", "text"), "id2": F.hash("key", "text")})
    regions = _stored(
        rows.select(*ROW, "text").mapInArrow(
            _regions(length), "id long, id2 int, anchor long, region long, start int, offset int, size int"
        ),
        "regions",
    )
    # equal regions have equal offsets and sizes; any of their places will do
    distinct = regions.groupBy("anchor", "region").agg(
        F.count(F.lit(1)).alias("n"), F.min("offset").alias("offset"), F.min("size").alias("size"),
        *[F.first(c).alias(c) for c in (*ROW, "start")],
    )
    seen = F.sum("n").over(Window.partitionBy("anchor"))
    kinds = _stored(distinct.withColumn("seen", seen).where("seen > 1").drop("seen"), "kinds")
    wanted = kinds.groupBy(*ROW).agg(F.collect_list(F.struct("anchor", "region", "n", "start", "offset", "size")).alias("wanted"))
    cut = rows.select(*ROW, "text").join(wanted, ROW).select("text", "wanted").mapInArrow(
        _slicer, "anchor long, region long, n long, offset int, bytes binary"
    )
    decided = cut.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        _deciding(length), "anchor long, region long, spans array<struct<low:int,high:int>>"
    )
    decided = _stored(decided.where(F.size("spans") > 0), "decided")
    hits = regions.select(*ROW, "anchor", "region", "start").join(decided, ["anchor", "region"])
    moved = F.transform("spans", lambda s: F.struct((s["low"] + F.col("start")).alias("low"), (s["high"] + F.col("start")).alias("high")))
    by_row = hits.select(*ROW, moved.alias("spans")).groupBy(*ROW).agg(F.flatten(F.collect_set("spans")).alias("spans"))
    return rows.join(by_row, ROW, "left").select("key", "text", "spans").mapInArrow(
        _cutter, f"key {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    ).withColumnRenamed("key", key)
