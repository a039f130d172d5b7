"""Toxicity scores: a learned lexicon in a trie, met by Levenshtein automata, and context windows.

The lexicon is learned from labelled rows: words, and word beginnings (stems), that are much
more frequent in toxic documents. Each word of a text is looked up: as it is, by its stems, and
by the Levenshtein automaton of the word, run over the tries of lexicon words and of stems in
bit-parallel states, so misspelled terms are found without comparing them one by one. All words
of the lexicon of four letters or more are in the trie, also those that a stem covers. A word
meets the automaton only if it shares a string with a term after so many deletions, which all
misspellings do; hashes of these strings tell it for all new words of a piece at once. Around each
hit a window of words tells quotation (quote marks on both sides, reporting words) from
abuse (other hits near by). A logistic regression over these features gives the score.

Labels are learned from at most about ``TOXIC_ROWS`` + ``CLEAN_ROWS`` rows, chosen by hash; the
score is a function of the text alone and covers whole texts of all documents.

Rows: a null or empty text has no hits and gets the score of such texts. Labels that are null
or not 0 or 1 are not learned; of several labels of an id the largest counts. Where
labels of documents are all toxic or all clean, every score is about 1 or 0 (0 without any). Rows
without id are never held out. Repeated rows get equal results. An empty table gives an
empty result. Other columns are kept; ``held_out``, ``score`` and ``predicted`` are replaced.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspar.llm.words import chunks, mix
from larkspar.session import cut_lineage

#: Labelled rows learned from, and terms kept: bounds of what the model gathers.
TOXIC_ROWS = 8_000
CLEAN_ROWS = 12_000
TERMS = 2_000
#: Documents a term needs, and its log ratio of document shares.
LEAST_DOCS = 5
LEAST_RATIO = 2.3
STEMS = (4, 5, 6)
#: Letters of the shortest words and stems whose misspellings are looked for.
SHORTEST = 4
WINDOW = 8
THRESHOLD = 0.3
#: What a task keeps of its look-ups: kinds of words (some 150 bytes each), beginnings, tries (some 4 KB each).
REMEMBERED = 200_000
BEGUN = 50_000
#: Texts scored at once, in bytes.
SCORED_BYTES = 1 << 19
TRIES = 2_000
ADDED = ("held_out", "score", "predicted")
WORD = re.compile(r"\w(?:[\w@$*]*\w)?")
QUOTES = re.compile("[\"“”„«»‹›]")
#: Fixed words that report what others said.
REPORTING = frozenset("said says wrote writes called calls quoted quote reported reports sagte schrieb dit dijo".split())
FEATURES = 6


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def deletions(word: str, edits: int) -> set[str]:
    """The word without up to ``edits`` (0 to 2) characters; words so many edits apart have one of these in common."""
    found = {word}
    if edits:
        found.update([word[:i] + word[i + 1 :] for i in range(len(word))])
    if edits > 1:
        ends = [word[j + 1 :] for j in range(len(word))]
        found.update([word[:i] + word[i + 1 : j] + ends[j] for i in range(len(word)) for j in range(i + 1, len(word))])
    return found


class Trie:
    """Lexicon words as nested dicts; the key None marks the end of a word. With ``prefix``, words only begin like these."""

    def __init__(self, words: list[str], prefix: bool = False):
        self.prefix = prefix
        self.root: dict = {}
        for word in words:
            node = self.root
            for c in word:
                node = node.setdefault(c, {})
            node[None] = True

    def within(self, word: str, edits: int) -> bool:
        """Whether a word of the trie is at most ``edits`` insertions, deletions or substitutions from it, or its beginning.

        Bit i of state e: i characters of ``word`` are read with e edits.
        """
        at: dict[str, int] = {}
        for i, c in enumerate(word):
            at[c] = at.get(c, 0) | 1 << i
        full, end = (2 << len(word)) - 1, 1 << len(word)
        start, state = [], 1
        for _ in range(edits + 1):
            start.append(state & full)
            state |= state << 1
        stack = [(self.root, tuple(start))]
        while stack:
            node, states = stack.pop()
            for c, child in node.items():
                if c is None:
                    if self.prefix or any(s & end for s in states):
                        return True
                    continue
                equal = at.get(c, 0)
                new, before = [], 0
                for e, s in enumerate(states):
                    step = (s & equal) << 1
                    if e:
                        step |= states[e - 1] | states[e - 1] << 1 | before << 1
                    before = step & full
                    new.append(before)
                if before:
                    stack.append((child, tuple(new)))
        return False


class Shared:
    """Strings by 64-bit hashes, to tell for many words at once which may share one with them after deletions."""

    BASE = np.uint64(0x9E3779B97F4A7C15)
    BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

    def __init__(self, strings: Iterable[str]):
        strings = sorted(strings)
        sums, lengths = self.sums(strings)
        self.hashes = np.unique(sums[np.arange(len(strings)), lengths])
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[(mix(self.hashes) >> np.uint64(44)).astype(np.int64)] = True

    @classmethod
    def sums(cls, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all beginnings of each word, one row each, and the lengths."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        width = max(1, int(lengths.max(initial=1)))
        codes = np.array(words, dtype=f"U{width}").reshape(-1).view(np.uint32).reshape(len(words), width)
        powers = np.cumprod(np.full(width, cls.BASE), dtype=np.uint64)
        sums = np.zeros((len(words), width + 1), dtype=np.uint64)
        np.cumsum(codes.astype(np.uint64) * powers, axis=1, out=sums[:, 1:])
        return sums, lengths

    def hold(self, hashes: np.ndarray) -> np.ndarray:
        found = self.seen[(mix(hashes) >> np.uint64(44)).astype(np.int64)]
        if len(self.hashes) and found.any():
            some = hashes[found]
            at = np.minimum(np.searchsorted(self.hashes, some), len(self.hashes) - 1)
            found[found] = self.hashes[at] == some
        return found

    def any_of(self, words: list[str], edits: int) -> np.ndarray:
        """Words of which something is left after up to ``edits`` (1 or 2) deletions that is one of the strings."""
        sums, lengths = self.sums(words)
        rows = np.arange(len(words))
        whole = sums[rows, lengths]
        found = self.hold(whole)
        for i in range(sums.shape[1] - 1):
            some = np.flatnonzero(~found & (lengths > i))
            one = sums[some, i] + (whole[some] - sums[some, i + 1]) * self.BACK
            found[some] = self.hold(one)
            for j in range(i + 1, sums.shape[1] - 1) if edits > 1 else ():
                some = np.flatnonzero(~found & (lengths > j))
                two = sums[some, i] + (sums[some, j] - sums[some, i + 1]) * self.BACK
                found[some] = self.hold(two + (whole[some] - sums[some, j + 1]) * self.BACK * self.BACK)
        return found

    def begin(self, words: list[str], sizes: range) -> np.ndarray:
        """Words that begin, after one deletion or none, with one of the strings of the given sizes."""
        sums, lengths = self.sums(words)
        found = np.zeros(len(words), dtype=bool)
        for n in sizes:
            for i in range(n + 1):  # the deleted character; the last one is behind the beginning
                some = np.flatnonzero(~found & (lengths >= (n + 1 if i < n else n)))
                start = sums[some, min(n, sums.shape[1] - 1)]
                if i < n and len(some):
                    start = sums[some, i] + (sums[some, n + 1] - sums[some, i + 1]) * self.BACK
                found[some] = self.hold(start)
        return found


class Lexicon:
    """Looks words up: 2 for a term or a stem, 1 for a misspelled term, 0 otherwise."""

    def __init__(self, terms: list[str], words: list[str]):
        self.words = {t for t in terms if not t.endswith("*")}
        self.stems = {t[:-1] for t in terms if t.endswith("*")}
        long = [w for w in words if len(w) >= SHORTEST]
        self.tries: dict[frozenset, Trie] = {}
        self.beginnings = Trie(sorted(self.stems), prefix=True)
        self.longest = max(map(len, long), default=0)
        self.near: dict[int, dict[str, list[str]]] = {1: {}, 2: {}}
        for edits, near in self.near.items():
            for w in long:
                for x in deletions(w, edits):
                    near.setdefault(x, []).append(w)
        self.near_stems = set().union(*(deletions(x, 1) for x in self.stems))
        self.shared = {edits: Shared(near) for edits, near in self.near.items()}
        self.shared_stems = Shared(self.near_stems)
        self.begun: dict[str, bool] = {}
        self.known: dict[str, int] = {}

    def _misspelled(self, word: str, edits: int) -> bool:
        """The automaton of the word over a trie of the terms that share a string with it after deletions."""
        near = self.near[edits]
        if len(word) > self.longest + edits:
            return False
        shared = near.keys() & deletions(word, edits)
        if not shared:
            return False
        terms = frozenset(w for x in shared for w in near[x])
        if terms not in self.tries:
            if len(self.tries) > TRIES:
                self.tries.clear()
            self.tries[terms] = Trie(sorted(terms))
        return self.tries[terms].within(word, edits)

    def _begins(self, start: str) -> bool:
        """Whether a stem is one edit from a beginning; ``start`` is as long as such beginnings get."""
        if start not in self.begun:
            if len(self.begun) > BEGUN:
                self.begun.clear()
            cut = {x[:n] for x in deletions(start, 1) for n in range(STEMS[0] - 1, STEMS[-1] + 1)}
            self.begun[start] = not self.near_stems.isdisjoint(cut) and self.beginnings.within(start, 1)
        return self.begun[start]

    def _is_term(self, word: str) -> bool:
        return word in self.words or any(word[:n] in self.stems for n in STEMS if len(word) >= n)

    def _find(self, word: str) -> int:
        if self._is_term(word):
            return 2
        if len(word) < SHORTEST - 1:
            return 0
        return int(self._begins(word[: STEMS[-1] + 1]) or self._misspelled(word, 1 if len(word) < 9 else 2))

    def _near(self, words: list[str]) -> set[str]:
        """The words that may be misspelled terms or begin like a stem: those that share a string after deletions."""
        found: set[str] = set()
        for edits, some in ((1, [w for w in words if len(w) < 9]), (2, [w for w in words if 9 <= len(w)])):
            some = [w for w in some if SHORTEST - 1 <= len(w) <= self.longest + edits]
            if some:
                found.update(w for w, near in zip(some, self.shared[edits].any_of(some, edits)) if near)
        starts: dict[str, list[str]] = {}
        for w in words:
            if len(w) >= SHORTEST - 1:
                starts.setdefault(w[: STEMS[-1] + 1], []).append(w)
        if starts and self.stems:
            near = self.shared_stems.begin(list(starts), range(STEMS[0] - 1, STEMS[-1] + 1))
            for begins, ws in zip(near, starts.values()):
                found.update(ws if begins else ())
        return found

    def kinds(self, words: list[str]) -> list[int]:
        known = self.known
        new = [w for w in set(words) if w not in known]
        if new and len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list(set(words))
        if new:
            near = self._near(new)
            for word in new:
                known[word] = self._find(word) if word in near else 2 * self._is_term(word)
        return [known[w] for w in words]

    def all_features(self, texts: list[str | None]) -> list[list[float]]:
        """The features of several texts, whose new words are looked up together."""
        lows = [(text or "").lower() for text in texts]
        words = [WORD.findall(low) for low in lows]
        self.kinds(list(set().union(*words)))
        return [self._features(low, ws, self.kinds(ws)) for low, ws in zip(lows, words)]

    def features(self, text: str | None) -> list[float]:
        return self.all_features([text])[0]

    def _features(self, low: str, words: list[str], kinds: list[int]) -> list[float]:
        """Terms, misspelled terms, quoted ones, the worst window, hits per word, and whether any."""
        hits = [i for i, k in enumerate(kinds) if k]
        if not hits:
            return [0.0] * FEATURES
        quoted = self._quoted(low, words, hits)
        weight = [(0.3 if i in quoted else 1.0) * (1.0 if kinds[i] == 2 else 0.5) for i in hits]
        worst, first, total = 0.0, 0, 0.0
        for last, i in enumerate(hits):
            total += weight[last]
            while hits[first] < i - 2 * WINDOW:
                total -= weight[first]
                first += 1
            worst = max(worst, total)
        terms = sum(kinds[i] == 2 for i in hits)
        return [
            math.log1p(terms), math.log1p(len(hits) - terms), math.log1p(len(quoted)), math.log1p(worst),
            math.log1p(100 * sum(weight) / len(words)), 1.0 if terms else 0.0,
        ]

    @staticmethod
    def _quoted(low: str, words: list[str], hits: list[int]) -> set[int]:
        """Hits behind an odd number of quote marks of their window with one more after them, or behind a reporting word."""
        marks = [m.start() for m in QUOTES.finditer(low)]
        told = [] if REPORTING.isdisjoint(words) else [i for i, w in enumerate(words) if w in REPORTING]
        if not marks and not told:
            return set()
        found = {i for i in hits if bisect_left(told, i) > bisect_left(told, max(0, i - WINDOW))}
        if marks:
            spans = [m.span() for m in WORD.finditer(low)]
            for i in hits:
                first, last = max(0, i - WINDOW), min(len(words) - 1, i + WINDOW)
                before = bisect_left(marks, spans[i][0]) - bisect_left(marks, spans[first][0])
                if before % 2 and bisect_left(marks, spans[last][1] + 2) > bisect_left(marks, spans[i][1]):
                    found.add(i)
        return found


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each term, toxic and clean, of each piece of rows."""
    for piece in chunks(batches, "text"):
        counts = Counter(), Counter()
        for text, toxic in zip(piece.column("text").to_pylist(), piece.column("toxic").to_pylist()):
            words = {w for w in WORD.findall((text or "").lower()) if 3 <= len(w) <= 40}
            counts[toxic].update(words | {f"{w[:n]}*" for w in words for n in STEMS if len(w) >= n})
        terms = sorted(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string())] + [pa.array([counts[x][t] for t in terms], pa.int64()) for x in (1, 0)],
            ["term", "toxic", "clean"],
        )


def labelled_rows(docs: DataFrame, labels: DataFrame, key: str) -> tuple[DataFrame, dict[int, int]]:
    """Sampled (text, toxic) rows outside the held-out part, and the number of labels of each kind."""
    marks = labels.select(labels[key].alias(key), labels["toxic"].alias("toxic"))
    known = marks.where(F.col("toxic").isin(0, 1) & ~held_out(F.col(key))).groupBy(key).agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = dict(known.groupBy("toxic").count().collect())
    limits = {0: CLEAN_ROWS, 1: TOXIC_ROWS}
    share = F.lit(0.0)
    for label, rows in limits.items():
        share = F.when(F.col("toxic") == label, F.lit(rows / max(rows, sizes.get(label, 0)))).otherwise(share)
    drawn = F.pmod(F.xxhash64(F.lit(5), key), F.lit(1 << 20)) < share * (1 << 20)
    # a bounded number of ids and labels
    sample = F.broadcast(known.where(drawn).select(F.col(key).alias("labelled"), "toxic"))
    texts = docs.select(docs[key].alias("id"), docs["text"].alias("text"))
    return texts.join(sample, F.col("id") == F.col("labelled")).select("text", "toxic"), sizes


def learn_lexicon(rows: DataFrame, toxic: int, clean: int) -> tuple[list[str], list[str]]:
    """At most ``TERMS`` words and stems ("abc*") typical of toxic rows, and all words, with those that a stem covers."""
    counted = rows.mapInArrow(_counter, "term string, toxic long, clean long")
    counted = counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    ratio = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    strong = counted.where(F.col("toxic") >= LEAST_DOCS).withColumn("ratio", ratio).where(F.col("ratio") >= LEAST_RATIO)
    best = strong.orderBy(F.desc(F.col("ratio") * F.log1p("toxic")), "term").limit(TERMS).collect()
    documents = {r["term"]: r["toxic"] for r in best}
    return _without_covered(documents), sorted(t for t in documents if not t.endswith("*"))


def _without_covered(documents: dict[str, int]) -> list[str]:
    """Terms without stems that stand for little more than one word, and without what other stems cover."""
    most: Counter = Counter()
    for word, n in documents.items():
        if not word.endswith("*"):
            for k in STEMS:
                most[word[:k]] = max(most[word[:k]], n)
    stems = {t[:-1] for t, n in documents.items() if t.endswith("*") and n >= 1.5 * most[t[:-1]]}
    covered = lambda x: any(x[:k] in stems for k in STEMS if k < len(x))
    words = [t for t in documents if not t.endswith("*") and not covered(t) and t not in stems]
    return sorted(words + [f"{s}*" for s in stems if not covered(s)])


def _featurizer(lexicon: tuple[list[str], list[str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Lexicon(*lexicon)
        for piece in chunks(batches, "text"):
            rows = found.all_features(piece.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [piece.column("toxic"), pa.array(rows, pa.list_(pa.float64()))], ["toxic", "features"]
            )

    return run


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> tuple[tuple[list[str], list[str]], list[float], float]:
    """The lexicon, the weights of the features and the intercept."""
    rows, sizes = labelled_rows(docs, labels, key)
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return ([], []), [0.0] * FEATURES, 50.0 if toxic else -50.0
    drawn = {1: min(toxic, TOXIC_ROWS), 0: min(clean, CLEAN_ROWS)}
    lexicon = learn_lexicon(rows, drawn[1], drawn[0])
    weight = F.when(F.col("toxic") == 1, toxic / drawn[1]).otherwise(clean / drawn[0])
    table = rows.mapInArrow(_featurizer(lexicon), "toxic int, features array<double>").select(
        F.col("toxic").cast("double").alias("label"), array_to_vector("features").alias("features"), weight.alias("weight")
    )
    table = cut_lineage(table)
    met = dict(table.groupBy("label").count().collect())
    if len(met) < 2:  # labels of one kind, or none, have documents
        return ([], []), [0.0] * FEATURES, 50.0 if 1.0 in met else -50.0
    model = LogisticRegression(regParam=1e-3, weightCol="weight", maxIter=50, standardization=True).fit(table)
    return lexicon, [float(x) for x in model.coefficients], float(model.intercept)


def score_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", keep_text: bool = False) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``."""
    lexicon, weights, intercept = learn(docs, labels, key)
    rows = docs.select(*[docs[c] for c in docs.columns if c not in ADDED])
    fields = [f for f in rows.schema.fields if keep_text or f.name != "text"]
    names = [f.name for f in fields] + ["score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Lexicon(*lexicon)
        for piece in chunks(batches, "text", SCORED_BYTES):
            sums = [
                intercept + sum(w * x for w, x in zip(weights, features))
                for features in found.all_features(piece.column("text").to_pylist())
            ]
            scores = [1 / (1 + math.exp(-max(-50.0, min(50.0, s)))) for s in sums]
            yield pa.RecordBatch.from_arrays([*[piece.column(n) for n in names[:-1]], pa.array(scores)], names)

    scored = rows.mapInArrow(run, T.StructType([*fields, T.StructField("score", T.DoubleType())]))
    return scored.select(
        *names[:-1], held_out(F.col(key)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
