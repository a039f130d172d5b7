"""One registered query per operator, over whole tables, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspar.catalog.registry import runnable
from larkspar.llm.alignment import align_documents
from larkspar.llm.centroids import cluster_vectors
from larkspar.llm.decontamination import find_passages
from larkspar.llm.exact_topk import top_k
from larkspar.llm.html_text import extract_main_text
from larkspar.llm.jaccard_join import link_documents
from larkspar.llm.line_dedup import drop_site_lines
from larkspar.llm.minhash import near_duplicates
from larkspar.llm.mixing import mix_sources
from larkspar.llm.suffix_dedup import remove_repeats
from larkspar.llm.token_output import read_token_ids, write_token_ids
from larkspar.llm.toxicity import score_documents
from larkspar.llm.warc import read_warc, write_warc
from larkspar.tables import Tables

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_source_mix(t: Tables) -> DataFrame:
    return mix_sources(t.documents, keep_text=False).select(
        "doc_id", "size", "source_size", "target", "taken", "source"
    )


def op2_suffix_dedup(t: Tables) -> DataFrame:
    return remove_repeats(t.documents).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_site_line_dedup(t: Tables) -> DataFrame:
    return drop_site_lines(t.pages).select("page_id", "host", "n_lines", "n_dropped", "kept_text")


OP3_SQL = r"""
WITH cut AS (
  SELECT page_id, lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)) AS host,
    list_filter(list_transform(regexp_split_to_array(coalesce(html, ''), '\n|<[^>]*>'),
      lambda x: trim(x, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), lambda x: x <> '') AS lines
  FROM pages
), sites AS (SELECT host, count(*) AS n FROM cut GROUP BY host),
seen AS (SELECT host, unnest(list_distinct(lines)) AS line FROM cut),
common AS (
  SELECT host, list(line) AS boiler FROM (
    SELECT seen.host, line FROM seen JOIN sites ON seen.host = sites.host
    GROUP BY seen.host, line, n HAVING count(*) >= 3 AND count(*) > 0.2 * n) GROUP BY host
), kept AS (
  SELECT page_id, cut.host, lines,
    CASE WHEN boiler IS NULL THEN lines ELSE list_filter(lines, lambda x: NOT list_contains(boiler, x)) END AS good
  FROM cut LEFT JOIN common ON cut.host = common.host
)
SELECT page_id, host, len(lines)::BIGINT AS n_lines, (len(lines) - len(good))::BIGINT AS n_dropped,
  coalesce(array_to_string(good, chr(10)), '') AS kept_text FROM kept
"""


def op5_toxicity(t: Tables) -> DataFrame:
    return score_documents(t.documents.select("doc_id", "text"), t.labels).select(
        "doc_id", "held_out", "score", "predicted"
    )


def op6_token_ids(t: Tables) -> DataFrame:
    folder = t.folder("token-ids")
    write_token_ids(t.documents, folder, tokenizer_path())
    return read_token_ids(t.spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_exact_top_k(t: Tables) -> DataFrame:
    return top_k(t.embeddings, F.pmod(F.col("vec_id"), F.lit(50)) == 0, t.folder("queries"))


def op7_decontaminate(t: Tables) -> DataFrame:
    found = find_passages(t.documents.select("doc_id", "text"), t.benchmark, t.folder("items"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_main_text(t: Tables) -> DataFrame:
    return extract_main_text(t.pages)


def op9_jaccard_join(t: Tables) -> DataFrame:
    return link_documents(t.documents, words=3, num=90, den=100)


def op10_warc(t: Tables) -> DataFrame:
    folder = t.folder("warc")
    write_warc(t.pages, folder)
    return read_warc(t.spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_near_duplicates(t: Tables) -> DataFrame:
    return near_duplicates(t.documents, words=4, num=80, den=100)


def op12_centroid_clusters(t: Tables) -> DataFrame:
    return cluster_vectors(t.embeddings)


def op13_token_alignment(t: Tables) -> DataFrame:
    return align_documents(t.documents, tokenizer_path(), tokenizer_path(PIECES))


JOBS: dict[str, Callable[[Tables], DataFrame]] = {
    job.__name__: job for job in (
        op1_source_mix, op2_suffix_dedup, op3_site_line_dedup, op4_exact_top_k, op5_toxicity, op6_token_ids,
        op7_decontaminate, op8_main_text, op9_jaccard_join, op10_warc, op11_near_duplicates, op12_centroid_clusters,
        op13_token_alignment,
    )
}
SQL = {"op3_site_line_dedup": " ".join(OP3_SQL.split())}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {key: runnable(job) for key, job in JOBS.items()}
