"""Streams with keyed state: the stop rule of listings and requests
joined to the pages that arrive for them (S2).

**Stop rule.** List pages arrive late and in any order, so a link may be known
before the failure that ends its site's listing. State by site remembers the first
failure so far. The output is a log of two kinds of rows: links, unless a failure
before them is known already, and a cut each time the first failure moves forward.
:func:`links_so_far` reads the log: links before their site's least cut. That is
what the batch rule gives on the pages landed so far, whatever their order.
A site may hold a third of all pages, so its state is kept in ``SALTS`` parts, each
for a part of its pages; a part that has not met the first failure only lets more
links into the log. The state is one position for each part, and chunks of a part
are read one after the other, never gathered.

**Requests and pages.** A left outer join of two streams. A request waits for its
page at most ``delay`` after it was made; then it leaves the state as a row without
a status, which is a failed fetch. A URL requested very often (a list template
without a page number) is split by ``salts``: requests are dealt by their time, and
each page goes to every part, so only small columns of pages should be asked for.

Both write through the file sink, whose log commits each micro-batch once; progress
and state are in the checkpoint folder, on shared storage. A run that dies goes on
from there, and a batch that was not committed runs again on the same files.

Defined results: repeated pages repeat their links; rows without a site are never
cut; a null page number comes before all others; a request without a URL meets no
page, and a page without one meets no request and moves no time on; pages and
requests that come more than ``late`` behind the newest ones may be dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from newsflow import sites as S
from newsflow.operators.extract import extract_links

SALTS = 16
PAGES = "site string, page_no long, html string"
LOG = "kind string, site string, page_no long, card_no long, href string"
UNNUMBERED = -(1 << 63)


def first_failures(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Log rows of one part of a site, and its first failure as the state."""
    columns = [c.split()[0] for c in LOG.split(", ")]
    first = tuple(state.get) if state.exists else None
    for b in batches:
        bad = b[b["failed"]]
        found = min(zip(bad["page_no"].tolist(), bad["card_no"].tolist(), strict=True), default=None)
        if found is not None and (first is None or found < first):
            first = found
            state.update(first)
            yield pd.DataFrame([("cut", key[0], *first, None)], columns=columns)
        links = b[~b["failed"]]
        if first is not None and not pd.isna(key[0]):
            links = links[(links["page_no"] < first[0]) | ((links["page_no"] == first[0]) & (links["card_no"] < first[1]))]
        if len(links):
            yield links.assign(kind="link")[columns]


def links_log(pages: DataFrame, profiles: dict[str, S.Site], salts: int = SALTS) -> DataFrame:
    """The log for a stream of list pages (site, page_no, html)."""
    links = (extract_links(pages, profiles).withColumn("page_no", F.coalesce("page_no", F.lit(UNNUMBERED)))
             .withColumn("part", F.pmod(F.xxhash64("page_no"), F.lit(salts)).cast("int")))
    return links.groupBy("site", "part").applyInPandasWithState(
        first_failures, LOG, "page_no long, card_no long", "append", GroupStateTimeout.NoTimeout)


def start_links_stream(spark: SparkSession, landing: str, log: str, checkpoint: str, profiles: dict[str, S.Site], salts: int = SALTS,
                       max_files_per_trigger: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Runs the stop rule on the list pages landed in a folder (``PAGES``)."""
    reader = spark.readStream.schema(PAGES)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _start(links_log(reader.parquet(landing), profiles, salts), log, checkpoint, available_now)


def links_so_far(spark: SparkSession, log: str) -> DataFrame:
    """``site, page_no, card_no, href``: the links before their site's first failure."""
    rows = spark.read.schema(LOG).parquet(log)
    cuts = rows.where("kind = 'cut'").groupBy("site").agg(F.min(F.struct("page_no", "card_no")).alias("cut"))
    kept = (rows.where("kind = 'link'").join(cuts, "site", "left")
            .where(F.col("cut").isNull() | (F.struct("page_no", "card_no") < F.col("cut"))))
    return kept.select("site", F.nullif("page_no", F.lit(UNNUMBERED)).alias("page_no"), "card_no", "href")


def fetched(requests: DataFrame, pages: DataFrame, *values: str, delay: str = "1 day", late: str = "2 hours", salts: int = 1) -> DataFrame:
    """Streams of requests (``url, requested_at``, more) and pages (``url,
    fetched_at``, ``values``): requests with the values of the pages that came for
    them within ``delay``, nulls if none did."""
    r = requests.withWatermark("requested_at", late).withColumn("_part", F.pmod(F.xxhash64("url", "requested_at"), F.lit(salts)))
    p = (pages.select(F.col("url").alias("_url"), "fetched_at", *values).withWatermark("fetched_at", late)
         .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))))
    met = ((F.col("url") == F.col("_url")) & (F.col("_part") == F.col("_salt"))
           & (F.col("fetched_at") >= F.col("requested_at")) & (F.col("fetched_at") <= F.col("requested_at") + F.expr(f"INTERVAL {delay}")))
    return r.join(p, met, "left_outer").select(*requests.columns, *values)


def start_fetch_stream(requests: DataFrame, pages: DataFrame, out: str, checkpoint: str, *values: str, delay: str = "1 day",
                       late: str = "2 hours", salts: int = 1, available_now: bool = True) -> StreamingQuery:
    return _start(fetched(requests, pages, *values, delay=delay, late=late, salts=salts), out, checkpoint, available_now)


def _start(rows: DataFrame, path: str, checkpoint: str, available_now: bool) -> StreamingQuery:
    w = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()
