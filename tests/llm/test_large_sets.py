"""Similarity join of sets with many more shingles than a sketch has bits."""

from __future__ import annotations

import random

import numpy as np
import pytest

from larkspar.llm import links
from larkspar.llm.jaccard_join import Bands, link_documents

WORDS = [f"w{i}" for i in range(5000)]


def noisy(base: list[str], edits: int, rng: random.Random) -> str:
    words = list(base)
    for place in rng.sample(range(len(words)), edits):
        words[place] = rng.choice(WORDS)
    return " ".join(words)


def shingles(text: str) -> set[tuple]:
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_unlinked_pairs_of_large_sets_are_not_emitted(spark, monkeypatch):
    rng = random.Random(5)
    rows = []
    for length, copies in ((2800, 12), (1100, 12), (330, 12)):  # similarities of about 0.6, no links
        base = rng.choices(WORDS, k=length)
        rows += [(len(rows) + i, noisy(base, length // 18, rng)) for i in range(copies)]
    for length in (5, 40, 255, 256, 260, 330, 520, 1100, 1300, 2800, 6000):  # linked copies at about 0.85 and more
        base = rng.choices(WORDS, k=length)
        rows += [(len(rows) + i, noisy(base, length // 120 * i, rng)) for i in range(3)]
        rows.append((len(rows), " ".join(base[: length - length // 6])))
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    assert label[:36] == list(range(36)) and len(set(label)) < len(rows) - 20
    emitted, verified = [], links.Links.verified

    def counting(self, pairs):
        emitted.append(pairs.count())
        return verified(self, pairs)

    monkeypatch.setattr(links.Links, "verified", counting)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in link_documents(docs).collect()}
    assert got == {r[0]: x for r, x in zip(rows, label)}
    assert emitted[-1] < 100  # of 198 pairs, each with many blocks


@pytest.mark.parametrize("num", [60, 80, 90])
def test_a_similar_pair_passes_in_a_block_it_shares(num):
    rng, bands = np.random.default_rng(num), Bands(num, 100)
    fresh = lambda n: rng.integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2)
    for n in [*range(2, 60, 3), 255, 256, 257, 320, 511, 513, 700, 1024, 1300, 2600, 9000]:
        for grown in (0.0, 0.3, 0.5, 1.0):  # from sets of one size to one that holds the other
            apart = 2 * n * (100 - num) // (100 + num)
            more = int(apart * (1 + grown) / 2)
            both = fresh(n)
            a, b = np.append(both, fresh(apart - more)), np.append(both, fresh(more))
            while num * (n + len(a) - n + len(b) - n) > 100 * n:
                a, b = (a[:-1], b) if len(a) > n else (a, b[:-1])
            if len(a) == len(b) == n:
                continue
            (x, at_x, lines_x), (y, at_y, lines_y) = bands.keys(np.sort(a)), bands.keys(np.sort(b))
            _, i, j = np.intersect1d(x, y, return_indices=True)
            left, right = lines_x[at_x[i]], lines_y[at_y[j]]
            assert len(i) and (left[:, 0] == right[:, 0]).all()
            flipped = np.bitwise_count(left[:, 1:] ^ right[:, 1:]).sum(axis=1)
            assert (flipped * left[:, 0].astype(int) * (100 + num) <= (len(a) + len(b)) * (100 - num)).any()
