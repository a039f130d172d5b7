"""Drop boilerplate lines by their frequency within a site. DataFrame functions only.

Pages are grouped by the host of their URL. A line is boilerplate on its host when the
pages of the host that hold it, divided by all pages of the host, exceed ``ratio``
and it is on ``least`` pages or more. Lines are what stands between matches of ``split``
(line breaks and tags of raw pages), without surrounding white space; empty ones do not
count. A page counts once for each different line.

A host of n pages with c lines each has at most c / ratio boilerplate lines, so their
list per host does not grow with the number of pages. Counts are combined before the
shuffle, and the pages meet the lists of their hosts in an equi join that adaptive
execution splits where a host is large.

Rows: a null text has no lines and gives an empty text. A null or unreadable URL has the
empty host, which is a site like any other. Repeated rows are pages of their own. An
empty table gives an empty result. Other columns are kept; ``host``, ``n_lines``,
``n_dropped`` and ``kept_text`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspar.llm.columns import restored, sheltered

ADDED = ("host", "n_lines", "n_dropped", "kept_text")
HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
SPLIT = r"\n|<[^>]*>"
BLANK = " \t\n\x0b\x0c\r"


def drop_site_lines(
    pages: DataFrame, text: str = "html", url: str = "url", ratio: float = 0.2, least: int = 3, split: str = SPLIT
) -> DataFrame:
    """``pages`` with ``host``, the number of lines, how many were dropped, and the kept lines."""
    names = [n for n in pages.columns if n not in ADDED]
    host = F.lower(F.regexp_extract(F.coalesce(pages[url], F.lit("")), HOST, 1))
    parts = F.transform(F.split(F.coalesce(pages[text], F.lit("")), split), lambda x: F.btrim(x, F.lit(BLANK)))
    lines = F.filter(parts, lambda x: x != "")
    cut = pages.select(*sheltered(pages, names), host.alias("host"), lines.alias("_lines"))
    unread = pages.select(host.alias("host"), lines.alias("_lines"))

    sites = unread.groupBy("host").agg(F.count(F.lit(1)).alias("_pages"))
    seen = unread.select("host", F.explode(F.array_distinct("_lines")).alias("_line"))
    counts = seen.groupBy("host", "_line").agg(F.count(F.lit(1)).alias("_with"))
    common = (
        counts.where(F.col("_with") >= least).join(sites, "host")
        .where(F.col("_with") > ratio * F.col("_pages"))
        .groupBy("host").agg(F.collect_set("_line").alias("_common"))
    )
    joined = cut.join(common, "host", "left")
    none = F.array().cast("array<string>")
    kept = F.filter("_lines", lambda x: ~F.array_contains(F.coalesce(F.col("_common"), none), x))
    done = joined.withColumn("_kept", kept)
    return done.select(
        *restored(done, names), "host", F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("_kept")).cast("long").alias("n_dropped"),
        F.array_join("_kept", "\n").alias("kept_text"),
    )
