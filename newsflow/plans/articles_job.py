"""The articles job: landed crawl -> status filter -> fields
-> clean/date -> constants/lineage -> (optional) translation -> articles.

Python runs only inside ``extract_fields`` (one ``mapInPandas`` over the
HTML, none for sites with plain-tag selectors); the only shuffles are the translation-memory join and, in the
listing job, the url join and the first-failure aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow import sites as S
from newsflow.operators import extract as X
from newsflow.operators.lineage import ARTICLE_FIELDS, add_constants, add_lineage
from newsflow.operators.translate import translate_with_memory
from newsflow.session import materialize
from newsflow.sources.crawl import fetch, frontier, status_ok


def listing_job(depth: DataFrame, crawl: DataFrame, profiles: dict | None = None,
                tolerant: bool = False) -> DataFrame:
    """Frontier -> list pages -> article links (site, page_no, card_no, art_url)."""
    profiles = profiles or S.BY_NAME
    pages = fetch(frontier(depth), crawl)
    links = X.extract_links(pages.select("site", "page_no", "html"), profiles)
    return X.absolute_links(X.links_until_error(links, tolerant), profiles)


def linked_crawl(links: DataFrame, crawl: DataFrame) -> DataFrame:
    """S2 for the article step: exactly the listed links are fetched, repeats
    kept (a site that lists a link three times gives three articles)."""
    return fetch(links.select("site", F.col("art_url").alias("url")), crawl)


def crawl_job(depth: DataFrame, crawl: DataFrame, profiles: dict | None = None, tolerant: bool = False, **options):
    """The whole chain: frontier, list pages, links, stop rule, article pages,
    fields. ``options`` as for :func:`articles_job`."""
    links = materialize(listing_job(depth, crawl, profiles, tolerant), "article-links")
    return articles_job(linked_crawl(links, crawl), profiles, **options)


def articles_job(crawl: DataFrame, profiles: dict | None = None, run_ts: str | None = None,
                 tm: DataFrame | None = None, translator=None, tm_path: str | None = None,
                 materialize_fields: bool = False):
    """Returns (articles, rejects). ``crawl`` rows need site, url, status_code, html.

    With ``tm`` the content is translated to English through the memory
    (and ``translator`` for misses); the article language is the site's.
    ``materialize_fields`` writes the parsed fields to the shared folder once,
    so consuming both outputs does not parse the HTML twice.
    """
    profiles = profiles or S.BY_NAME
    fields = X.extract_fields(status_ok(crawl), profiles)
    if materialize_fields:
        fields = materialize(fields, "article-fields")
    ok, rejects = X.fields_to_articles(fields, profiles)
    arts = add_lineage(add_constants(ok), run_ts=run_ts)
    if tm is not None:
        lang = F.create_map(*[x for s in profiles.values() for x in (F.lit(s.site), F.lit(s.lang))])
        arts = arts.withColumn("lang", F.element_at(lang, F.col("site")))
        done, failed = translate_with_memory(arts, tm, "art_content", "lang", translator, tm_path)
        arts = done.withColumn("art_content", F.col("text_en")).drop("text_en", "from_memory", "lang")
        rejects = rejects.unionByName(failed.select(*[c for c in rejects.columns if c in failed.columns]),
                                      allowMissingColumns=True)
    cols = ["site"] + [c for c in ARTICLE_FIELDS if c in arts.columns]
    return arts.select(*cols), rejects
