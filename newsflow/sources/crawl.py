"""Frontier and crawl sources.

Fetching is not done here: a crawler lands pages in a table
``crawl(url, status_code, html, fetched_at)``; requests are joined to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow import sites as S


def frontier(depth: DataFrame, sites=S.SITES) -> DataFrame:
    """(site, n_pages) -> (site, page_no, url), page numbers 1..n rendered
    into the site's list URL template (a template without ``{i}`` gives the
    same URL n times, as the reference does for one site)."""
    tmpl = F.create_map(*[x for s in sites for x in (F.lit(s.site), F.lit(s.list_template))])
    pages = depth.select("site", F.explode(F.sequence(F.lit(1), F.col("n_pages").cast("int"))).alias("page_no"))
    return pages.select("site", F.col("page_no").cast("bigint").alias("page_no"),
                        F.replace(F.element_at(tmpl, F.col("site")), F.lit("{i}"),
                                  F.col("page_no").cast("string")).alias("url"))


def latest_fetch(crawl: DataFrame) -> DataFrame:
    """One row per (site, url), the most recent fetch; a fetch without a time
    is older than any with one. The winner is found on its time and a hash of
    the row (partial aggregation: a URL fetched very often costs one partial
    row per task), and the pages are then cut to the winners, so no HTML goes
    through the aggregation. Equal rows of a winner collapse."""
    if "fetched_at" not in crawl.columns:
        return crawl
    keys = [c for c in ("site", "url") if c in crawl.columns]
    rest = [c for c in crawl.columns if c not in keys]
    age = F.struct(F.col("fetched_at").isNotNull().alias("dated"), "fetched_at", F.xxhash64(*rest).alias("h"))
    rows = crawl.withColumn("_age", age)
    best = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max("_age").alias("_best"))
    same = F.col("_age").eqNullSafe(F.col("_best"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return rows.join(best, same, "left_semi").dropDuplicates([*keys, "_age"]).drop("_age")


def fetch(requests: DataFrame, crawl: DataFrame, *values: str) -> DataFrame:
    """Requested URLs left-joined to the landed crawl on ``url``;
    unmatched rows (NULL status) are failed fetches. ``values``: the crawl
    columns wanted (status and HTML if none are named).

    The crawl is first cut to the requested URLs by a semi-join against the
    distinct URLs. Spark broadcasts those if its statistics allow, and then
    only the requested pages are shuffled to the left join; otherwise both
    joins run as shuffle joins whose skew adaptive execution splits."""
    c = crawl.select("url", *(values or ("status_code", "html")))
    return requests.join(c.join(requests.select("url").distinct(), "url", "left_semi"), "url", "left")


def status_ok(crawl: DataFrame) -> DataFrame:
    """S3: only HTTP 200 pages are parsed as articles."""
    return crawl.filter(F.col("status_code") == 200)
