"""Near duplicates, centroid clusters and token alignment against brute force, with nulls, ties, repeats and clashing columns."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspar.llm import links
from larkspar.llm.alignment import Csr, align_documents, incidence, product, token_links, transposed
from larkspar.llm.centroids import VantageTree, cluster_vectors, whole_numbers
from larkspar.llm.jaccard_join import link_documents
from larkspar.llm.minhash import COORDINATES, band_keys, drop_near_duplicates, near_duplicates, sketches
from larkspar.llm.queries import PIECES, tokenizer_path

WORDS = [f"W{i}" for i in range(500)]


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingles(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def components_by_hand(rows, words, num, den):
    sets = {k: shingles(t, words) for k, t in rows}
    label = {k: k for k in sets}

    def find(a):
        while label[a] != a:
            a = label[a]
        return a

    holders = defaultdict(list)
    for k, s in sets.items():
        for x in s:
            holders[x].append(k)
    for k, s in sets.items():
        shared = Counter(o for x in s for o in holders[x] if o < k)
        for o, n in shared.items():
            if den * n >= num * (len(s) + len(sets[o]) - n):
                a, b = sorted((find(k), find(o)))
                label[b] = a
    return {k: (len(s), find(k)) for k, s in sets.items()}


def near_copies(seed, families=6, copies=25, length=120, edits=4):
    """Families of edited copies, exact copies, short texts, and one very long text with its near copy."""
    rng = random.Random(seed)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "a b c"), (7, "a b c d"), (8, "A b C d")]
    for _ in range(families):
        base = rng.choices(WORDS, k=length)
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, edits)):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            rows.append((len(rows) + 1, " ".join(words)))
    for n in (4, 5, 6, 7, 8):  # sets small enough that few shingles fill a sketch
        base = rng.choices(WORDS, k=n + 3)
        rows += [(len(rows) + 1, " ".join(base)), (len(rows) + 2, " ".join(base[:-1])), (len(rows) + 3, " ".join(base[1:]))]
    long = rng.choices(WORDS, k=60_000)
    rows += [(len(rows) + 1, " ".join(long)), (len(rows) + 2, "  ".join(long[:-50]))]
    return rows


@pytest.mark.parametrize("words, num, den", [(4, 80, 100), (5, 9, 10)])
def test_near_duplicates(spark, words, num, den):
    rows = near_copies(words)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(docs, words=words, num=num, den=den).collect()}
    want = components_by_hand(rows, words, num, den)
    assert got == {k: (n, c, k == c) for k, (n, c) in want.items()}


def test_both_similarity_joins_agree(spark):
    docs = spark.createDataFrame(near_copies(9, families=3), "doc_id long, text string").repartition(3)
    assert Counter(link_documents(docs).collect()) == Counter(near_duplicates(docs).drop("kept").collect())


def test_near_duplicates_of_odd_tables(spark):
    text = " ".join(WORDS[:50])
    names = ["cls", "key", "hash", "n", "label", "node", "block", "sketch", "keys", "_hash", "_empty", "_nth", "_key", "empty", "least"]
    rows = [(3, text), (3, text), (None, text), (None, "x"), (None, None), (9, ""), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", *[F.lit(f"own {n}").alias(n) for n in names]
    )
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(docs).collect())
    assert got == Counter([
        (3, 46, 3, True), (3, 46, 3, True), (None, 46, 3, False), (None, 1, None, True), (None, 0, None, True),
        (9, 0, 9, True), (9, 0, 9, True),
    ])
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert all(r[n] == f"own {n}" for r in kept.collect() for n in names)
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) in (
        Counter([(3, text), (None, "x"), (None, None), (9, ""), (9, "")]),
        Counter([(None, text), (None, "x"), (None, None), (9, ""), (9, "")]),
    )
    assert near_duplicates(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        near_duplicates(docs, num=1, den=2)


def test_every_coordinate_fills_and_agrees_like_the_sets():
    rng = np.random.default_rng(3)
    sets = []
    for n in (1, 2, 5, 40, 400, 4000):
        base = rng.integers(1, 2**63, n, dtype=np.uint64)
        sets += [base, np.concatenate([base[: n - n // 5], rng.integers(1, 2**63, n // 5, dtype=np.uint64)])]
    held = sketches(sets)
    assert held.shape == (12, COORDINATES) and (held != 0).all()
    for i in range(0, 12, 2):
        a, b = set(sets[i].tolist()), set(sets[i + 1].tolist())
        share = float((held[i] == held[i + 1]).mean())
        assert abs(share - len(a & b) / len(a | b)) < 0.2
    alone = np.concatenate([sketches([s]) for s in sets])
    assert (alone == held).all()
    assert band_keys(held).shape == (12, COORDINATES // 4)


def test_blocks_are_the_same_in_any_number_of_slices(spark, monkeypatch):
    docs = spark.createDataFrame(near_copies(4, families=2), "doc_id long, text string").repartition(3)
    before = Counter(link_documents(docs).collect())
    monkeypatch.setattr(links, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(links, "REMEMBERED", 1)
    assert Counter(link_documents(docs).collect()) == before


def clusters_by_hand(rows, k, rounds, dims):
    kept = [(i, [math.floor(256.0 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    points = [list(v) for _, v in order[:k]]
    away = lambda v, p: sum((x - y) ** 2 for x, y in zip(v, p))
    assign = lambda: [min((away(v, p), c) for c, p in enumerate(points)) for _, v in kept]
    for _ in range(rounds):
        found = assign()
        for c in range(len(points)):
            mine = [v for (_, v), (_, at) in zip(kept, found) if at == c]
            if mine:
                points[c] = [sum(x) // len(mine) for x in zip(*mine)]
    found = assign()
    total = Counter()
    for d, c in found:
        total[c] += d
    return Counter(
        (i, c, d, total[c], sum(total.values()), hashlib.sha256(",".join(map(str, points[c])).encode()).hexdigest())
        for (i, _), (d, c) in zip(kept, found)
    )


def vectors(seed, dims, n, scale=1.0):
    rng = random.Random(seed)
    rows = [(i, [round(rng.gauss(i % 7, 0.6), rng.choice([1, 6])) * scale for _ in range(dims)]) for i in range(n)]
    rows += [rows[3], rows[3], (3, rows[4][1]), (None, rows[5][1]), (n, None), (n + 1, []), (n + 2, [1.0] * (dims + 1))]
    return rows + [(n + 3, [None] + [1.0] * (dims - 1)), (n + 4, [float("nan")] * dims), (n + 5, [float("inf")] * dims)]


@pytest.mark.parametrize("k, dims, n, scale", [(40, 64, 300, 1.0), (5, 4, 90, 1.0), (30, 3, 12, 1.0), (6, 4, 60, 1e5), (6, 2, 40, 1e7)])
def test_clusters(spark, k, dims, n, scale):
    rows = vectors(k, dims, n, scale)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("own"))
    got = cluster_vectors(table.repartition(4), k=k, dims=dims)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(map(tuple, got.collect())) == clusters_by_hand(rows, k, 5, dims)


def test_clusters_of_ties_and_extremes(spark):
    same = [(i, [0.5, -0.5]) for i in range(30)]
    table = spark.createDataFrame(same, "vec_id long, embedding array<float>")
    assert {(r["cluster"], r["distance"]) for r in cluster_vectors(table, k=4, dims=2).collect()} == {(0, 0)}
    assert cluster_vectors(table.limit(0), k=4, dims=2).collect() == []
    huge = spark.createDataFrame([(1, [1e308, -1e308]), (2, [-1e308, 1e308]), (3, [0.0, 0.0])], "vec_id long, embedding array<double>")
    rows = {r["vec_id"]: r for r in cluster_vectors(huge, k=1, dims=2).collect()}
    assert rows[1]["distance"] == rows[1]["inertia"] == 2**63 - 1 and rows[3]["distance"] == 0
    assert whole_numbers(np.array([-1e-9, 0.0, 3.999]), 256.0).tolist() == [-1, 0, 1023]


def test_tree_search_is_exact():
    rng = np.random.default_rng(5)
    for spread in (2, 1000, 10**9):
        points = rng.integers(-spread, spread, (40, 6))
        points[7] = points[3]
        queries = np.concatenate([rng.integers(-spread, spread, (500, 6)), points])
        label, best = VantageTree(points).nearest(queries)
        away = ((queries[:, None, :].astype(object) - points.astype(object)) ** 2).sum(axis=2)
        assert label.tolist() == [min(range(40), key=lambda c: (row[c], c)) for row in away]
        assert [int(x) for x in best] == [min(row) for row in away.tolist()]


ODD_TEXTS = [
    None, "", " ", "  x", "▁x", "a▁b", "<|endoftext|> <s></s> <unk>", "é  　z", "\x00\x01 \t\n", "日本語 テスト 👩‍👩‍👧 x",
    "trail ", "two  spaces   three    ", "﻿bom", "ﬁ Å é", "don't  I'll\tx\r\n\r\n y", "a" * 3000, " " * 500,
    "word " * 40_000, "x", "x",
]


def alignments_by_hand(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(tokenizer_path())
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECES))
    codes = {}
    for b in range(256):
        plain = 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b
        codes[chr(b if plain else 256 + sum(not (33 <= x <= 126 or 161 <= x <= 172 or 174 <= x) for x in range(b)))] = b
    parts = {i: bytes(codes[c] for c in e) for e, i in first.get_vocab(with_added_tokens=False).items()}
    piece = lambda i: bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()
    found, links_, counts = [], [], Counter()
    for _, text in rows:
        whole = (" " + (text or "")).encode()
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        tokens = [[parts[i] for i in a], [piece(i) for i in b]]
        if not text or any(b"".join(t) != whole for t in tokens):
            found.append((0, 0, 0, 0, "", 0))
            links_.append([])
            continue
        ends = [np.cumsum([len(x) for x in t]).tolist() for t in tokens]
        spans = [list(zip([0, *e], e)) for e in ends]
        pairs, j = [], 0
        for i, (s, e) in enumerate(spans[0]):
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(b) and spans[1][k][0] < e:
                pairs.append((a[i], b[k]))
                k += 1
        text_, shared, at = [], 0, [0, 0]
        for end in sorted(set(ends[0]) & set(ends[1])):
            both = []
            for side, ids in enumerate((a, b)):
                stop = ends[side].index(end, at[side]) + 1
                both.append(ids[at[side] : stop])
                at[side] = stop
            text_.append("|".join(",".join(map(str, x)) for x in both))
            shared += len(both[0]) * len(both[1])
        found.append((len(a), len(b), len(text_), len(pairs), hashlib.sha256(";".join(text_).encode()).hexdigest(), shared))
        links_.append(pairs)
        counts.update(pairs)
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    return Counter(
        (k, *f[:4], sum(counts[p] == top[p[1]] for p in pairs), sum(counts[p] for p in pairs), *f[4:])
        for (k, _), f, pairs in zip(rows, found, links_)
    )


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_alignment(spark, monkeypatch, limit):
    monkeypatch.setattr("larkspar.llm.alignment.BROADCAST_ROWS", limit)
    rng = random.Random(7)
    alphabet = "abcdeé   \t\n,.'XYZ日09"
    rows = list(enumerate(ODD_TEXTS)) + [(100 + i, "".join(rng.choices(alphabet, k=rng.randint(1, 200)))) for i in range(60)]
    rows += [(None, "null id"), (0, "twice"), (0, "twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", *[F.lit("own").alias(c) for c in ("row", "pairs", "key", "n_a", "total", "best")]
    )
    got = align_documents(docs.repartition(3), tokenizer_path(), tokenizer_path(PIECES))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared"]
    assert Counter(map(tuple, got.collect())) == alignments_by_hand(rows)
    assert align_documents(docs.limit(0), tokenizer_path(), tokenizer_path(PIECES)).collect() == []


def test_links_in_blocks(spark, monkeypatch):
    rows = [(1, "alignment of tokenizers, anew"), (2, None), (3, "ünïcode spaces  日本")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    paths = tokenizer_path(), tokenizer_path(PIECES)
    whole = Counter(map(tuple, token_links(docs, *paths).collect()))
    totals = {r["doc_id"]: r for r in align_documents(docs, *paths).collect()}
    for key, _ in rows:
        mine = [r for r in whole if r[0] == key]
        assert len(mine) == totals[key]["n_shared"]
        assert sum(r[-1] > 0 for r in mine) == totals[key]["n_links"]
        assert sum(r[-1] for r in mine) == (len((" " + dict(rows)[key]).encode()) if dict(rows)[key] else 0)
    monkeypatch.setattr("larkspar.llm.alignment.LINK_ROWS", 2)
    assert Counter(map(tuple, token_links(docs, *paths).collect())) == whole


def test_sparse_product():
    rng = np.random.default_rng(2)
    for _ in range(20):
        x, y = rng.random((7, 9)) < 0.3, rng.random((9, 5)) < 0.4
        sparse = lambda m: incidence(m.sum(axis=1), np.nonzero(m)[1], m.shape[1])
        rows, columns, values = product(sparse(x), sparse(y))
        dense = np.zeros((7, 5), dtype=int)
        dense[rows, columns] = values
        assert (dense == x.astype(int) @ y.astype(int)).all()
        flipped: Csr = transposed(sparse(x))
        assert (flipped.starts == sparse(x.T).starts).all() and (flipped.columns == sparse(x.T).columns).all()
