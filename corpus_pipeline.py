"""From raw documents to token ids: five stages over whole tables, each stored before the next.

Toxic documents go, near copies go but one of each group, benchmark passages are cut out,
sources are mixed to their target weights, and the mix is written as token ids. Rows the mix
takes several times are repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspar.llm.columns import sheltered
from larkspar.llm.decontamination import find_passages
from larkspar.llm.jaccard_join import keep_one
from larkspar.llm.mixing import mixed_documents
from larkspar.llm.queries import tokenizer_path
from larkspar.llm.token_output import read_token_ids, write_token_ids
from larkspar.llm.toxicity import score_documents
from larkspar.session import new_folder, ship_package

#: Learned scores and a tokenizer have no SQL.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold."""
    ship_package(spark)
    scored = score_documents(docs, _table(spark, sf_dir, "labels"), keep_text=True)
    return scored.where("predicted = 0").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word shingles with a similarity of 0.8 or more."""
    ship_package(spark)
    return keep_one(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the benchmark passages in them; other documents stay as they are."""
    ship_package(spark)
    names = docs.columns
    rows = docs.select(*sheltered(docs, names), docs["text"].alias("text"))
    found = find_passages(rows, _table(spark, sf_dir, "benchmark"), new_folder(spark, "items"), clean=True)

    def column(i: int, name: str) -> Column:
        own = F.col(f"`own {i}`")
        if name == "text":
            return F.col("clean_text").alias(name)
        if name == "n_chars":
            counted = F.length("clean_text").cast(docs.schema[name].dataType)
            return F.when(F.col("n_hit") > 0, counted).otherwise(own).alias(name)
        return own.alias(name)

    return found.select(*[column(i, n) for i, n in enumerate(names)])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    ship_package(spark)
    return mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Position, number and checksum of the ids of each document of the mix, from the files."""
    ship_package(spark)
    folder = new_folder(spark, "token-ids")
    write_token_ids(docs, folder, tokenizer_path())
    return read_token_ids(spark, folder)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", cut_benchmark),
    ("mixing sources to target weights", mix),
    ("token-ID output", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is stored and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = new_folder(spark, f"stage-{name.split()[0]}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
