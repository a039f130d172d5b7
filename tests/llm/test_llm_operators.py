"""Operators on small tables with nulls, empty texts, ties, repeats, clashing columns and no rows, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from larkspar.llm.decontamination import find_passages
from larkspar.llm.exact_topk import top_k
from larkspar.llm.html_text import main_text
from larkspar.llm.jaccard_join import keep_one, link_documents
from larkspar.llm.line_dedup import drop_site_lines
from larkspar.llm.mixing import mix_sources, mixed_documents
from larkspar.llm.queries import tokenizer_path
from larkspar.llm.suffix_dedup import remove_repeats
from larkspar.llm.token_output import read_token_ids, write_token_ids
from larkspar.llm.toxicity import Lexicon, Trie, held_out, learn_lexicon, score_documents
from larkspar.llm.warc import BadRecord, read_archive, read_warc, record, write_warc
from larkspar.session import new_folder
from pyspark.sql import functions as F

WORDS = [f"w{i}" for i in range(400)]
DOCS = "doc_id long, text string, source string, size string"


def texts(seed: int, n: int = 60) -> list[tuple]:
    """Documents with copies, near copies, shared passages, nulls and empty texts."""
    rng = random.Random(seed)
    rows = [(0, None, None, "x"), (1, "", "b", None), (2, "  \t", "b", "x"), (3, "one", None, "x"), (4, "one", "é", "x")]
    base = [rng.choices(WORDS, k=rng.randint(3, 150)) for _ in range(12)]
    for i in range(5, n):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        rows.append((i, " ".join(words) + rng.choice(["", " é", "\n"]), rng.choice(["a", "b", "é"]), "x"))
    return rows + [rows[10], rows[10]]


def table(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema).repartition(3)


def test_mix(spark):
    docs = table(spark, texts(1))
    rows = mix_sources(docs).collect()
    assert len(rows) == len(texts(1)) and set(docs.columns) <= set(rows[0].asDict())
    targets, taken, most = {}, Counter(), Counter()
    for r in rows:
        assert r["taken"] <= 3 * r["size"]
        targets[r["source"]] = r["target"]
        taken[r["source"]] += r["taken"]
        most[r["source"]] = max(most[r["source"]], r["size"])
    assert sum(targets.values()) == pytest.approx(sum(r["size"] for r in rows))
    assert all(abs(taken[s] - t) <= 2 * most[s] for s, t in targets.items())
    again = Counter((r["doc_id"], r["taken"]) for r in mix_sources(docs).collect())
    assert again == Counter((r["doc_id"], r["taken"]) for r in rows)
    assert mixed_documents(docs).count() == sum(r["taken"] // r["size"] for r in rows if r["size"])
    assert mix_sources(docs.limit(0)).count() == 0


def removed_by_hand(rows, length):
    data = [(k, (t or "").encode()) for k, t, *_ in rows]
    seen = Counter(b[p : p + length] for _, b in data for p in range(len(b) - length + 1))
    out = []
    for key, b in data:
        mask = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                mask[p : p + length] = b"\1" * length
        kept = bytes(x for x, m in zip(b, mask) if not m)
        out.append((key, len(b), sum(mask), len(re.findall(b"\1+", bytes(mask))), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_suffix_dedup(spark):
    rows = texts(2) + [(90, "ab" * 600, "a", "x"), (91, "x" + "ab" * 300, "a", "x"), (92, "q" * 401, "a", "x")]
    rows += [(93, "one document kept twice, " * 20, "a", "x")] * 3 + [(None, "no id " + "z" * 450, "a", "x")] * 2
    found = remove_repeats(table(spark, rows)).drop("kept").collect()
    assert Counter(map(tuple, found)) == removed_by_hand(rows, 400)
    assert remove_repeats(table(spark, []), length=400).count() == 0


def test_site_lines(spark):
    rows = [(i, f"http://h.org/{i}", f"<li>menu</li><p>text {i}</p>\n<p> </p>", 7) for i in range(6)]
    rows += [(6, None, "<p>menu</p>", 7), (7, "http://o.org", None, 7), (0, "http://h.org/0", rows[0][2], 7)]
    found = drop_site_lines(spark.createDataFrame(rows, "page_id long, url string, html string, host int"))
    kept = sorted((r["page_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in found.collect())
    assert kept == sorted([(i, 2, 1, f"text {i}") for i in (0, 0, 1, 2, 3, 4, 5)] + [(6, 1, 0, "menu"), (7, 0, 0, "")])


def test_top_k(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6)], "x") for i in range(300)]
    rows += [(300, rows[3][1], "x"), (300, rows[3][1], "x"), (301, None, "x"), (302, [1.0, None] * 3, "x"),
             (303, [float("nan")] * 6, "x"), (None, rows[5][1], "x"), (350, [2.0], "x")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    found = top_k(vectors, F.col("vec_id") % 50 == 0, new_folder(spark, "q")).collect()
    ints = {i: np.floor(256 * np.array(v)) for i, v, _ in rows[:301]}
    for q in range(0, 301, 50):
        best = sorted((-int(ints[q] @ v), i) for i, v in ints.items() if i != q)[:5]
        assert sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q) == [
            (k + 1, i, -s) for k, (s, i) in enumerate(best)
        ]
    assert not [r for r in found if r["query_id"] == 350]
    assert top_k(vectors.limit(0), F.lit(True), new_folder(spark, "q")).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton():
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abc", k=rng.randint(1, 7)))
    for _ in range(500):
        lexicon, w = [word() for _ in range(4)], word()
        for edits in range(3):
            assert Trie(lexicon).within(w, edits) == (min(distance(w, x) for x in lexicon) <= edits)


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(4)
    docs, labels = [(9000, None), (9001, "")], [(9000, None), (9001, 0)]
    for i in range(800):
        words = rng.choices(WORDS, k=rng.randint(5, 60))
        toxic = i % 5 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["moronic", "scumbag", "moronic", "moromic"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs, labels = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    rows = score_documents(docs, labels).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"] and r["toxic"] is not None]
    assert sum(r["predicted"] == r["toxic"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows) and len(rows) == 802
    assert {r["predicted"] for r in score_documents(docs, labels.limit(0)).collect()} == {0}
    assert docs.where(held_out(F.lit(None))).count() == 0


def test_misspellings_of_all_terms(spark):
    rows = [(f"w{i % 40} moroni{'abcdef'[i % 6]}", 1) for i in range(300)] + [("scumbag jerk w1", 1)] * 5
    rows += [(f"w{i % 40} plain", 0) for i in range(400)]
    terms, words = learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"), 305, 400)
    assert any(t.endswith("*") and "moronic".startswith(t[:-1]) for t in terms) and "moronic" not in terms
    found = Lexicon(terms, words)
    assert found.kinds(["moronic", "scumbag", "jerk"]) == [2, 2, 2]
    assert found.kinds(["xoronic", "mronic", "moxonic", "scunbag", "sumbag", "jerx", "jrk"]) == [1] * 7
    assert found.kinds(["xoroniquement", "plain", "w1", "mo", "z" * 5000]) == [1, 0, 0, 0, 0]


def test_token_ids(spark):
    from tokenizers import Tokenizer

    rows = texts(5) + [(80, "a  b   c　 d  ", "a", "x"), (None, "it's  12 %", "a", "x")]
    folder = new_folder(spark, "ids")
    write_token_ids(table(spark, rows), folder, tokenizer_path())
    tokens, start, expected = Tokenizer.from_file(tokenizer_path()), 0, []
    order = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["start"])
    found = sorted(read_token_ids(spark, folder).collect(), key=order)
    encoded = defaultdict(list)
    for key, text, *_ in rows:
        ids = tokens.encode(text or "", add_special_tokens=False).ids + [0]
        encoded[key].append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for r in found:
        assert r["start"] == start and (r["n_tokens"], r["ids_crc32"]) in encoded[r["doc_id"]]
        start += r["n_tokens"]
    assert len(found) == len(rows) and start == sum(n for x in encoded.values() for n, _ in x)


def test_passages(spark):
    docs = texts(6) + [(95, "A bb C dd e f g h i j k l tail", "a", "x"), (96, "short ITEM here", "a", "x")]
    items = [(1, "a bb c dd e f g h i j k l"), (2, "short item"), (3, None), (4, ""), (None, "one"), (1, docs[9][1])]
    found = find_passages(
        table(spark, docs), spark.createDataFrame(items, "item_id long, text string"), new_folder(spark, "items"), clean=True
    ).collect()
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = defaultdict(set)
    for key, text in items:
        words = split(text) if key is not None else []
        n = min(10, len(words))
        for p in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[p : p + n])].add(str(key))
    expected = Counter()
    for key, text, *_ in docs:
        words, names = split(text), set()
        hit = [False] * len(words)
        for n in {len(w) for w in windows}:
            for p in range(len(words) - n + 1):
                if (w := tuple(words[p : p + n])) in windows:
                    names |= windows[w]
                    hit[p : p + n] = [True] * n
        expected[key, len(words), sum(hit), tuple(sorted(names))] += 1
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in found) == expected
    clean = {r["doc_id"]: r["clean_text"] for r in found}
    assert clean[95] == " tail" and clean[96] == " here" and clean[0] is None and clean[1] == ""


def test_main_text():
    page = "<body><nav>x</nav><article><h1>T &amp; t</h1><p>a<b>b</b> c<br>d<div class='ad'>no</div><p>e</article><footer>f"
    assert main_text(page) == "T & t\n\nab c d\n\ne"
    assert main_text(None) == main_text("") == main_text("<script>x</script>") == ""
    long = "word " * 40
    assert main_text(f"<ul><li><a>Home</a></ul><div><p>{long}<p>end.</div><div id=comments>{long}</div>") == f"{long.strip()}\n\nend."


@pytest.mark.parametrize("words, num", [(3, 90), (5, 80), (1, 60)])
def test_jaccard_components(spark, words, num):
    rows = texts(7, 90)
    low = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    sets = []
    for _, text, *_ in rows:
        w = low(text)
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} - {()})
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= num * len(a | sets[j]):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    least = {x: min(r[0] for r, y in zip(rows, label) if y == x) for x in label}
    docs = table(spark, rows)
    found = Counter(map(tuple, link_documents(docs, words=words, num=num).collect()))
    assert found == Counter((r[0], len(s), least[x]) for r, s, x in zip(rows, sets, label))
    empty = sum(not s for s in sets)
    stays = keep_one(docs, words=words, num=num)
    assert stays.columns == docs.columns and stays.count() == len({x for x, s in zip(label, sets) if s}) + empty
    if words == 3:
        assert link_documents(docs.limit(0)).count() == 0


def test_warc_round_trip(spark):
    big, other = "<p>é" + "x" * 1200, "y" * 999
    rows = [(1, "http://a b/é", big, 1), (2, None, big, 1), (9, "http://c", big, 1), (3, "u", other, 1), (4, "u", other, 1),
            (5, "u", None, 1), (None, "u", big, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type int").repartition(2)
    folder = new_folder(spark, "warc")
    write_warc(pages, folder)
    got = Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in read_warc(spark, folder).collect())
    expected = Counter()
    for key, _, html, _ in rows:
        data = (html or "").encode()
        again = len(data) >= 1000 and key != 9
        expected[key, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", 9 if again else None] += 1
    assert got == expected
    assert {bytes(r["payload"]) for r in read_warc(spark, folder, payload=True).where("record_type = 'response'").collect()} == {
        big.encode(), other.encode(), b""
    }


def test_warc_reader_verifies():
    import io

    data = record(1, "u", b"abc", hashlib.sha1(b"abc").digest(), 3, None, "2024-01-01T00:00:00Z")
    assert [p for _, _, p in read_archive(io.BytesIO(data * 2), keep=True)] == [b"abc", b"abc"]
    wrong = record(1, "u", b"abc", hashlib.sha1(b"abd").digest(), 3, None, "2024-01-01T00:00:00Z")
    for bad in (wrong, data[:-9]):
        with pytest.raises(BadRecord):
            list(read_archive(io.BytesIO(bad)))
