"""The corpus pipeline, stage by stage, against brute force on a small folder of tables."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from larkspar.llm.queries import tokenizer_path
from larkspar.session import new_folder

WORDS = [f"w{i}" for i in range(500)]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def tables(spark, rng: random.Random) -> tuple[str, list, list]:
    """A folder with documents, labels and benchmark items, the documents, and the items."""
    items = [" ".join(rng.choices(WORDS, k=14)) for _ in range(4)] + ["w1 , W2"]
    rows, labels = [], []
    base = [rng.choices(WORDS, k=rng.randint(3, 120)) for _ in range(60)]
    for i in range(400):
        words = list(rng.choice(base)) if i % 2 else rng.choices(WORDS, k=rng.randint(1, 80))
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        toxic = i % 5 == 0
        if toxic:
            words += ["moronic", "scumbag"]
        elif i % 9 == 0:
            words[len(words) // 2 : len(words) // 2] = items[i % 4].upper().split()
        rows.append((i, " ".join(words), "en", rng.choice(["a", "b", "é", None]), 7))
        labels.append((i, int(toxic)))
    rows += [(900, None, None, None, None), (901, "", "en", "a", 0), (902, " \t", "en", "b", 2), (None, "no id", None, "a", 5)]
    rows += [rows[1], rows[1]]
    folder = new_folder(spark, "pipeline-test")
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, t) for i, t in labels], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def without_copies(rows: list) -> Counter:
    sets = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(r[1] or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and label[i] != label[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    kept = Counter(r for r, s in zip(rows, sets) if not s)
    for x in {x for x, s in zip(label, sets) if s}:
        kept[min((r for r, y in zip(rows, label) if y == x), key=lambda r: (r[0] is not None, r[0] or 0))] += 1
    return kept


def without_items(row: tuple, items: list[str]) -> tuple:
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for item in items:
        w = word.findall(lower(item))
        n = min(10, len(w))
        windows |= {tuple(w[p : p + n]) for p in range(len(w) - n + 1)}
    found = list(word.finditer(lower(row[1] or "")))
    words, hit = [m[0] for m in found], [False] * len(found)
    for n in {len(w) for w in windows}:
        for p in range(len(words) - n + 1):
            if tuple(words[p : p + n]) in windows:
                hit[p : p + n] = [True] * n
    if not any(hit):
        return row
    text, at = "", 0
    for run in re.finditer("1+", "".join("01"[h] for h in hit)):
        text += row[1][at : found[run.start()].start()]
        at = found[run.end() - 1].end()
    text += row[1][at:]
    return (row[0], text, *row[2:4], len(text))


def test_stages(spark):
    from tokenizers import Tokenizer

    folder, rows, items = tables(spark, random.Random(11))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stored = []
    for name, stage in corpus_pipeline.STAGES:
        at = new_folder(spark, "stage")
        stage(spark, docs, folder).write.parquet(at)
        docs = spark.read.parquet(at)
        stored.append([tuple(r) for r in docs.collect()])
        assert name == "token-ID output" or docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    clean, single, cut, mixed, ids = stored

    assert Counter(clean) == Counter(r for r in rows if "moronic" not in (r[1] or ""))
    assert Counter(single) == without_copies(clean) and len(single) < len(clean)
    expected = [without_items(r, items) for r in single]
    assert Counter(cut) == Counter(expected) and expected != single

    sizes = Counter()
    taken = Counter()
    number = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    for r in cut:
        sizes[r[3]] += number(r)
    for r in mixed:
        taken[r[3]] += number(r)
    order = sorted((s for s in sizes if s is not None), key=lambda s: s) + [None]
    weights = {s: i % 3 + 1 for i, s in enumerate(order)}
    targets, budget, open_ = {}, sum(sizes.values()), set(order)
    while open_:
        share = {s: budget * weights[s] / sum(weights[x] for x in open_) for s in open_}
        if not (over := {s for s in open_ if share[s] > 3 * sizes[s]}):
            targets |= share
            break
        for s in over:
            targets[s] = 3 * sizes[s]
            budget -= targets[s]
        open_ -= over
    longest = max(map(number, cut))
    assert all(abs(taken[s] - targets[s]) <= 2 * longest for s in order)
    often = Counter(cut)
    assert all(often[r] and n <= 3 * often[r] for r, n in Counter(mixed).items())

    tokens, encoded = Tokenizer.from_file(tokenizer_path()), Counter()
    for r in mixed:
        found = tokens.encode(r[1] or "", add_special_tokens=False).ids + [0]
        encoded[r[0], len(found), zlib.crc32(np.array(found, "<u4").tobytes())] += 1
    names = docs.columns
    got = [dict(zip(names, r)) for r in ids]
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == encoded
    start = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == start
        start += r["n_tokens"]


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[:4]])
def test_empty_stage(spark, stage):
    folder, _, _ = tables(spark, random.Random(12))
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 0")
    found = stage(spark, docs, folder)
    assert found.columns == docs.columns and found.count() == 0
