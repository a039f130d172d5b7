"""Tables that have every internal name as a column of their own: nothing crashes, and their values stay."""

from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from larkspar import llm
from larkspar.llm.jaccard_join import keep_one, link_documents
from larkspar.llm.line_dedup import drop_site_lines
from larkspar.llm.mixing import mix_sources, mixed_documents
from larkspar.llm.toxicity import score_documents

OWN = {"doc_id", "text", "source", "page_id", "url", "html"}


def internal_names():
    """All column-like strings of the operators' code."""
    code = "".join(p.read_text() for p in Path(llm.__file__).parent.glob("*.py"))
    return sorted(n for n in set(re.findall(r'"(_?[a-z][a-z0-9_]{0,20})"', code)) if n not in OWN)


@pytest.fixture(scope="module")
def docs(spark):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words), " ".join(words[1:]), " ".join(reversed(words)), "one two", "", None, "one two"]
    rows = [(i, t, s) for i, (t, s) in enumerate(zip(texts, ["a", "b", None, "a", "a", "b", "c"]))]
    plain = spark.createDataFrame([*rows, rows[3]], "doc_id long, text string, source string")
    return plain, plain.select("*", *[F.lit(f"own {n}").alias(n) for n in internal_names()])


def values(df, *names):
    return Counter(tuple(r[n] for n in names) for r in df.collect())


def untouched(df, replaced=()):
    names = [n for n in internal_names() if n not in replaced]
    rows = df.select(*[F.col(f"`{n}`") for n in names]).distinct().collect()
    assert [tuple(r) for r in rows] == [tuple(f"own {n}" for n in names)]


def test_mix(docs):
    plain, wide = docs
    added = ("size", "source_size", "target", "taken")
    got = mix_sources(wide)
    assert values(got, "doc_id", *added) == values(mix_sources(plain), "doc_id", *added)
    untouched(got, added)
    mix = mixed_documents(wide)
    assert mix.columns == wide.columns and values(mix, "doc_id", "text") == values(mixed_documents(plain), "doc_id", "text")
    untouched(mix)


def test_near_copies(docs):
    plain, wide = docs
    assert values(link_documents(wide), "doc_id", "component_id") == values(link_documents(plain), "doc_id", "component_id")
    kept = keep_one(wide)
    assert kept.columns == wide.columns and values(kept, "doc_id") == values(keep_one(plain), "doc_id")
    untouched(kept)


def test_toxicity(spark, docs):
    plain, wide = docs
    labels = spark.createDataFrame([(i, i % 2) for i in range(7)], "doc_id long, toxic int")
    added = ("held_out", "score", "predicted")
    got = score_documents(wide, labels, keep_text=True)
    assert values(got, "doc_id", *added) == values(score_documents(plain, labels), "doc_id", *added)
    untouched(got, added)


def test_site_lines(spark):
    pages = spark.createDataFrame(
        [(i, f"http://h{i % 2}.x/a", f"<p>menu</p><p>line {i}</p>") for i in range(8)], "page_id long, url string, html string"
    )
    added = ("host", "n_lines", "n_dropped", "kept_text")
    wide = pages.select("*", *[F.lit(f"own {n}").alias(n) for n in internal_names()])
    assert values(drop_site_lines(wide), "page_id", *added) == values(drop_site_lines(pages), "page_id", *added)
    untouched(drop_site_lines(wide), added)


def test_filtering_stages_of_the_pipeline(spark, docs, tmp_path):
    _, wide = docs
    spark.createDataFrame([(i, i % 2) for i in range(7)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing in common")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, wide, str(tmp_path))
        assert got.columns == wide.columns
        if not got.isEmpty():
            untouched(got)
