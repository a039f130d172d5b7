"""Find and remove benchmark passages with an FM-index over each shard of documents.

Words are A-Z lowered. A phrase is ``window`` consecutive words of an item, or all words of
a shorter one. Documents are collected into shards of bounded size; the words that no
phrase holds, and runs too short for a phrase, become breaks. The Burrows-Wheeler
transform of a shard is kept as a wavelet matrix with ranks; all phrases are searched
backward at once, occurrences are located through sampled suffix positions, and overlapping
ones merge into spans.

Items are read by each task from the shared folder in blocks of at most ``BLOCK_WORDS``
words, so neither their number nor that of the documents meets a limit.

Rows: a null or empty text has no words and is clean. An item without words or id hits
nothing. Items of one id count once; repeated documents are rows of their own. Without items
every document is clean; without documents the result is empty. Columns of the documents
are kept; ``n_words``, ``n_hit``, ``items``, ``spans`` and ``clean_text`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from larkspar.llm.words import ALPHANUMERIC, chunks, lower_word_hashes

WINDOW = 10
#: Words of items searched at once, bytes of text in a shard, distance of sampled suffixes.
BLOCK_WORDS = 200_000
SHARD_BYTES = 16 << 20
SAMPLING = 16
ADDED = ("n_words", "n_hit", "items", "spans", "clean_text")


def expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [start, start + count), one range after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; each 0 is a break of its own, smaller than all symbols."""
    n = len(text)
    breaks = text == 0
    rank = np.where(breaks, np.cumsum(breaks) - 1, np.count_nonzero(breaks) + text.astype(np.int64))
    step = 1
    while True:
        second = np.zeros(n, dtype=np.int64)
        second[: max(0, n - step)] = rank[step:] + 1
        keys = rank * (n + int(text.max(initial=0)) + 2) + second
        order = np.argsort(keys, kind="stable")
        sorted_keys = keys[order]
        new = np.concatenate([[0], np.cumsum(sorted_keys[1:] != sorted_keys[:-1])])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        if n == 0 or new[-1] == n - 1:
            return order
        step *= 2


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit vector with prefix counts per bit of the symbols."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.bits = range(max(1, int(largest).bit_length()) - 1, -1, -1)
        self.ones, self.zeros = [], []
        for bit in self.bits:
            ones = ((symbols >> bit) & 1).astype(bool)
            self.ones.append(np.concatenate([[0], np.cumsum(ones)]).astype(np.int32))
            self.zeros.append(len(symbols) - int(self.ones[-1][-1]))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        self.first = self._place(np.arange(largest + 1), np.zeros(largest + 1, dtype=np.int64))

    def _place(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, ones, zeros in zip(self.bits, self.ones, self.zeros):
            before = ones[at]
            at = np.where((symbols >> bit) & 1, zeros + before, at - before)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its position."""
        return self._place(symbols, at) - self.first[symbols]

    def read(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at the positions and their ranks there."""
        symbols = np.zeros(len(at), dtype=np.int64)
        for ones, zeros in zip(self.ones, self.zeros):
            before = ones[at]
            one = ones[at + 1] > before
            symbols = 2 * symbols + one
            at = np.where(one, zeros + before, at - before)
        return symbols, at - self.first[symbols]


class FMIndex:
    """Backward search and location in a sequence of symbols above 0 in which 0 is a break."""

    def __init__(self, text: np.ndarray, largest: int, sampling: int = SAMPLING):
        text = np.append(text, 0)
        order = suffix_array(text)
        before = text[order - 1]
        self.size = len(text)
        self.before = WaveletMatrix(before, largest)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=largest + 1))])
        sampled = (order % sampling == 0) | (before == 0)  # steps never cross a break
        self.sampled = sampled
        self.sample = np.cumsum(sampled) - 1
        self.positions = order[sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of phrases of one length, a row each."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.size, dtype=np.int64)
        for symbols in phrases.T[::-1]:
            low = self.smaller[symbols] + self.before.rank(symbols, low)
            high = self.smaller[symbols] + self.before.rank(symbols, high)
            high = np.maximum(high, low)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        found = np.zeros(len(rows), dtype=np.int64)
        open_, steps = np.arange(len(rows)), 0
        while len(open_):
            done = self.sampled[rows]
            found[open_[done]] = self.positions[self.sample[rows[done]]] + steps
            open_, rows = open_[~done], rows[~done]
            symbols, ranks = self.before.read(rows)
            rows = self.smaller[symbols] + ranks
            steps += 1
        return found


class Phrases:
    """The phrases of a block of items, as symbols of the block's own vocabulary."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int):
        words = np.concatenate([w for _, w in items])
        self.vocabulary = np.unique(words)
        self.names = [name for name, _ in items]
        by_length: dict[int, list[np.ndarray]] = {}
        owners: dict[int, list[np.ndarray]] = {}
        for i, (_, hashes) in enumerate(items):
            symbols = np.searchsorted(self.vocabulary, hashes) + 1
            length = min(window, len(symbols))
            rows = np.lib.stride_tricks.sliding_window_view(symbols, length)
            by_length.setdefault(length, []).append(rows)
            owners.setdefault(length, []).append(np.full(len(rows), i))
        self.groups = []
        for length, rows in by_length.items():
            unique, same = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
            owner = np.unique(np.stack([same.ravel(), np.concatenate(owners[length])], axis=1), axis=0)
            self.groups.append((unique, np.searchsorted(owner[:, 0], np.arange(len(unique) + 1)), owner[:, 1]))
        self.shortest = min(by_length)

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)


def blocks(folder: str, window: int) -> Iterator[Phrases]:
    files, root = pafs.FileSystem.from_uri(folder)
    held, words = [], 0
    for info in sorted(files.get_file_info(pafs.FileSelector(root)), key=lambda f: f.path):
        if not info.path.endswith(".parquet"):
            continue
        with files.open_input_file(info.path) as opened:
            for batch in pq.ParquetFile(opened).iter_batches(1000):
                for name, hashes in zip(batch.column("item").to_pylist(), batch.column("words")):
                    hashes = hashes.values.to_numpy().view(np.uint64)
                    if held and words + len(hashes) > BLOCK_WORDS:
                        yield Phrases(held, window)
                        held, words = [], 0
                    held.append((name, hashes))
                    words += len(hashes)
    if held:
        yield Phrases(held, window)


def runs(symbols: np.ndarray, firsts: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of words in runs of at least ``shortest`` known words of one document, and where each run ends."""
    known = np.concatenate([[False], symbols > 0, [False]])
    start = known[1:-1] & ~known[:-2]
    start[firsts[:-1][firsts[:-1] < len(symbols)]] |= known[1:-1][firsts[:-1][firsts[:-1] < len(symbols)]]
    begins = np.flatnonzero(start)
    last = np.concatenate([begins[1:], [len(symbols)]])
    known_before = np.concatenate([[0], np.cumsum(symbols > 0)])
    counts = known_before[last] - known_before[begins]
    good = counts >= shortest
    return expand(begins[good], counts[good]), np.cumsum(counts[good]) if good.any() else np.zeros(0, dtype=np.int64)


def search_shard(hashes: np.ndarray, firsts: np.ndarray, found: Phrases) -> tuple[np.ndarray, list[set[str]]]:
    """For each word whether an occurrence covers it, and for each document the items found."""
    n, docs = len(hashes), len(firsts) - 1
    items: list[set[str]] = [set() for _ in range(docs)]
    symbols = found.symbols(hashes)
    places, ends = runs(symbols, firsts, found.shortest)
    cover = np.zeros(n + 1, dtype=np.int64)
    if len(places):
        text = np.insert(symbols[places], ends[:-1], 0)
        place = np.insert(places, ends[:-1], -1)
        index = FMIndex(text, len(found.vocabulary))
        for phrases, begin, owners in found.groups:
            low, high = index.search(phrases)
            which = np.repeat(np.arange(len(phrases)), high - low)
            at = place[index.locate(expand(low, high - low))]
            np.add.at(cover, at, 1)
            np.add.at(cover, at + phrases.shape[1], -1)
            doc = np.searchsorted(firsts, at, side="right") - 1
            for d, p in np.unique(np.stack([doc, which], axis=1), axis=0).tolist():
                items[d].update(found.names[o] for o in owners[begin[p] : begin[p + 1]])
    return np.cumsum(cover[:-1]) > 0, items


def _cut(text: bytes, spans: list[tuple[int, int]]) -> str:
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at:a])
        at = b
    return (b"".join(kept) + text[at:]).decode()


def _finder(folder: str, window: int, clean: bool, out: pa.Schema):
    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        hashes, starts, ends, counts = [], [], [], []
        for piece in held:
            h, s, e, f = lower_word_hashes(piece.column("text"), ALPHANUMERIC)
            hashes.append(h), starts.append(s.astype(np.int32)), ends.append(e.astype(np.int32))
            counts.append(np.stack([np.diff(f), text_bytes(piece)]))
        hashes, starts, ends = map(np.concatenate, (hashes, starts, ends))
        counts, sizes = np.concatenate(counts, axis=1)
        firsts = np.append(0, np.cumsum(counts))
        hit = np.zeros(len(hashes), dtype=bool)
        items: list[set[str]] = [set() for _ in counts]
        for found in blocks(folder, window):
            more, names = search_shard(hashes, firsts, found)
            hit |= more
            for mine, theirs in zip(items, names):
                mine |= theirs
        hits = np.diff(np.append(0, np.cumsum(hit))[firsts])
        texts = table.column("text") if clean else None
        spans: list[list] = [[] for _ in counts]
        cleaned = []
        origin = np.concatenate([np.append(0, np.cumsum(text_bytes(p)))[:-1] for p in held])
        for d in np.flatnonzero(hits):
            a, b = firsts[d], firsts[d + 1]
            edge = np.diff(np.concatenate([[0], hit[a:b].astype(np.int8), [0]]))
            on, off = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
            spans[d] = [
                {"start": int(s), "end": int(e)}
                for s, e in zip(starts[a + on] - origin[d], ends[a + off] - origin[d])
            ]
        columns = [table.column(c).combine_chunks() for c in table.schema.names if clean or c != "text"]
        columns += [
            pa.array(counts, pa.int64()), pa.array(hits, pa.int64()), pa.array([sorted(x) for x in items], pa.list_(pa.string())),
            pa.array(spans, out.field("spans").type),
        ]
        if clean:
            for d, text in enumerate(texts):
                value = text.as_py()
                if spans[d]:
                    value = _cut(value.encode(), [(x["start"], x["end"]) for x in spans[d]])
                cleaned.append(value)
            columns.append(pa.array(cleaned, pa.string()))
        return pa.RecordBatch.from_arrays(columns, out.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for piece in chunks(batches, "text"):
            held.append(piece)
            size += int(text_bytes(piece).sum())
            if size >= SHARD_BYTES:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    return run


def text_bytes(piece: pa.RecordBatch) -> np.ndarray:
    """Bytes of the texts of a piece; null counts as 0."""
    return pc.fill_null(pc.binary_length(piece.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in chunks(batches, "text"):
        hashes, _, _, firsts = lower_word_hashes(piece.column("text"), ALPHANUMERIC)
        lists = pa.ListArray.from_arrays(pa.array(firsts.astype(np.int32)), pa.array(hashes.view(np.int64)))
        yield pa.RecordBatch.from_arrays([piece.column("item"), lists], ["item", "words"])


def find_passages(
    docs: DataFrame, items: DataFrame, folder: str, window: int = WINDOW, item_id: str = "item_id",
    text: str = "text", clean: bool = False,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, the sorted ``items`` found and the byte ``spans`` they cover.

    With ``clean`` the text is kept and ``clean_text`` is the text without its spans.
    Items are stored in ``folder``.
    """
    listed = items.where(items[item_id].isNotNull()).select(items[item_id].cast("string").alias("item"), items[text].alias("text"))
    listed.mapInArrow(_item_words, "item string, words array<long>").where(F.size("words") > 0).write.parquet(folder)
    rows = docs.select(*[docs[c] for c in docs.columns if c not in ADDED])
    kept = [f for f in rows.schema.fields if clean or f.name != "text"]
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    added = [
        T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", span),
    ] + [T.StructField("clean_text", T.StringType())] * clean
    schema = T.StructType(kept + added)
    return rows.mapInArrow(_finder(folder, window, clean, to_arrow_schema(schema)), schema)
