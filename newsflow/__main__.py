"""Command line for the three steps of the reference, as Spark jobs.

    python -m newsflow links    --crawl CRAWL --pages 3 --out LINKS
    python -m newsflow articles --crawl CRAWL [--links LINKS] --out ARTICLES --json-out SITE_JSON [--tm TM]
    python -m newsflow concat   --json-in SITE_JSON --out COMBINED_JSON
    python -m newsflow mentions --articles ARTICLES --key-file KEY --lexicon LEX.json --out STORE
    python -m newsflow sample   --store STORE --key-file KEY

CRAWL is a Parquet table (site, url, status_code, html[, fetched_at]) landed by
a crawler. Run under spark-submit (master, shared checkpoint folder and
resources come from the launcher) or locally with ``--master local[*]``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _session(master: str | None) -> SparkSession:
    from newsflow.session import apply_job_conf
    b = SparkSession.builder.appName("newsflow")
    if master:
        b = b.master(master)
    spark = b.getOrCreate()
    apply_job_conf(spark)
    return spark


def _key(path: str) -> str:
    with open(path, encoding="ascii") as f:
        return f.read().strip()


def _provider(name: str):
    """``package.module:function``; the function is the loader of a translator."""
    import importlib
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def cmd_links(spark, a) -> None:
    from newsflow import sites as S
    from newsflow.plans.articles_job import listing_job
    from newsflow.sources.crawl import latest_fetch
    crawl = latest_fetch(spark.read.parquet(a.crawl))
    depth = spark.createDataFrame([(s.site, a.pages) for s in S.SITES], "site string, n_pages int")
    listing_job(depth, crawl, tolerant=a.tolerant).write.mode("overwrite").partitionBy("site").parquet(a.out)


def cmd_articles(spark, a) -> None:
    from newsflow.operators.translate import TM_SCHEMA
    from newsflow.plans.articles_job import articles_job, linked_crawl
    from newsflow.sources.crawl import latest_fetch
    from newsflow.sources.jsonio import write_articles_json
    crawl = latest_fetch(spark.read.parquet(a.crawl))
    if a.links:                     # exactly the listed articles, repeats kept
        crawl = linked_crawl(spark.read.parquet(a.links), crawl)
    provider = _provider(a.provider) if a.provider else None
    tm = spark.read.parquet(a.tm) if a.tm else spark.createDataFrame([], TM_SCHEMA) if provider else None
    arts, rejects = articles_job(crawl, run_ts=a.run_ts, tm=tm, translator=provider, tm_path=a.tm_out, materialize_fields=True)
    arts.write.mode("overwrite").partitionBy("site").parquet(a.out)
    stored = spark.read.parquet(a.out)
    if a.json_out:
        write_articles_json(stored, a.json_out, partition_by="site")
    if a.rejects:
        rejects.write.mode("overwrite").parquet(a.rejects)


def cmd_concat(spark, a) -> None:
    from newsflow.operators.combine import append_order
    from newsflow.sources.jsonio import ARTICLE_JSON, read_site_json, write_articles_json
    rows = append_order(read_site_json(spark, a.json_in, a.multiline)).sort(F.col("source_ord").asc_nulls_last())
    write_articles_json(rows.select(*ARTICLE_JSON.fieldNames()), a.out, partition_by=None)


def cmd_mentions(spark, a) -> None:
    from newsflow.operators.sentiment import LexiconScorer
    from newsflow.plans.mentions_job import mentions_job
    arts = (spark.read.parquet(a.articles) if not a.articles_json
            else spark.read.schema(__import__("newsflow.sources.jsonio", fromlist=["x"]).ARTICLE_JSON)
                      .option("multiLine", a.multiline).json(a.articles))
    with open(a.lexicon, encoding="utf-8") as f:
        lexicon = json.load(f)
    _, rejects = mentions_job(arts, _key(a.key_file), LexiconScorer(lexicon), out_path=a.out)
    if a.rejects:
        rejects.write.mode("overwrite").parquet(a.rejects)


def cmd_sample(spark, a) -> None:
    from newsflow.functions.crypto import decrypt
    from newsflow.plans.mentions_job import MENTION_FIELDS
    key = _key(a.key_file)
    one = spark.read.parquet(a.store).limit(1)
    for r in one.select(*[decrypt(F.col(c), key).alias(c) for c in MENTION_FIELDS]).collect():
        for c in MENTION_FIELDS:
            print(f"Decrypted {c}:", r[c])


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="newsflow")
    p.add_argument("--master")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("links")
    s.add_argument("--crawl", required=True)
    s.add_argument("--pages", type=int, default=3)
    s.add_argument("--tolerant", action="store_true")
    s.add_argument("--out", required=True)
    s = sub.add_parser("articles")
    s.add_argument("--crawl", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--json-out")
    s.add_argument("--rejects")
    s.add_argument("--links", help="links table written by the links step")
    s.add_argument("--tm", help="translation memory")
    s.add_argument("--tm-out", help="folder that new translations are appended to")
    s.add_argument("--provider", help="package.module:function that loads a translator")
    s.add_argument("--run-ts")
    s = sub.add_parser("concat")
    s.add_argument("--json-in", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--multiline", action="store_true")
    s = sub.add_parser("mentions")
    s.add_argument("--articles", required=True)
    s.add_argument("--articles-json", action="store_true")
    s.add_argument("--multiline", action="store_true")
    s.add_argument("--key-file", required=True)
    s.add_argument("--lexicon", required=True)
    s.add_argument("--rejects")
    s.add_argument("--out", required=True)
    s = sub.add_parser("sample")
    s.add_argument("--store", required=True)
    s.add_argument("--key-file", required=True)
    a = p.parse_args(argv)
    from newsflow.session import clean_scratch
    own = SparkSession.getActiveSession() is None
    spark = _session(a.master)
    {"links": cmd_links, "articles": cmd_articles, "concat": cmd_concat,
     "mentions": cmd_mentions, "sample": cmd_sample}[a.cmd](spark, a)
    if own:
        clean_scratch(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
