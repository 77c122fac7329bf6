"""Binding of the driver's tables to the pipeline's inputs.

* ``documents`` stands for landed articles: ``art_content = text``; the
  article is assigned to one of the five sites by ``doc_id``; the category
  (webdo only) is the document's ``source``. The tables have no title field:
  as a test fixture, the title is the text's first line.
* ``pages`` stands for the landed crawl table: ``url``, ``html`` and a status
  derived from the page id (every tenth page is a failed fetch).

Lookups against the five-row site configuration are map literals compiled
into the plan (a fixed, tiny size), so no join is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow import sites as S
from newsflow.functions.text import collapse_ws
from newsflow.plans import sqlkit as Q

# Fixed processing time for reproducible checks (D5: the job parameter run_ts).
TEST_RUN_TS = "2024-06-01 12:00:00"
PUBLISHED_BASE = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Scan one landed table, pruned to ``cols``. How many tasks read it is
    left to Spark's split settings."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def site_lookup(site: Column, attr: str) -> Column:
    m = F.create_map(*[x for s in S.SITES for x in (F.lit(s.site), F.lit(getattr(s, attr)))])
    return F.element_at(m, site)


def ntz(ts: str) -> Column:
    return F.lit(ts).cast("timestamp_ntz")


def articles_from_documents(docs: DataFrame, run_ts: str = TEST_RUN_TS) -> DataFrame:
    """ARTICLE rows plus ``doc_id`` and ``site``."""
    site = S.site_of(F.col("doc_id"))
    src = site_lookup(F.col("site"), "art_source")
    return (docs.select("doc_id", "text", "source", site.alias("site"))
            .select(
                "doc_id", "site",
                F.concat(F.rtrim(src, F.lit("/")), F.lit("/article/"), F.col("doc_id").cast("string")).alias("art_url"),
                F.lower(collapse_ws(F.substring_index("text", "\n", 1))).alias("art_title"),
                F.timestamp_add("MINUTE", F.col("doc_id"), ntz(PUBLISHED_BASE)).alias("art_published_at"),
                F.when(F.col("site") == "webdo", F.col("source")).alias("art_type"),
                F.col("text").alias("art_content"),
                F.lit(S.ART_CATEGORY).alias("art_category"),
                F.lit(S.INACTIVE).alias("inactive"),
                F.lit(S.COUNTRY_CODE).alias("country_code"),
                site_lookup(F.col("site"), "scrapped_by").alias("scrapped_by"),
                src.alias("art_source"),
                ntz(run_ts).alias("art_creation_date")))


def crawl_from_pages(pages: DataFrame) -> DataFrame:
    """CRAWL rows: url, status_code, html, plus page_id and an assigned site."""
    return pages.select(
        "page_id", "url",
        F.when(F.col("page_id") % 10 == 9, F.lit(404)).otherwise(F.lit(200)).alias("status_code"),
        "html",
        S.site_of(F.col("page_id")).alias("site"))


# SQL twins of the bindings, for the DuckDB oracle -----------------------------

def _case(attr: str, key: str = "site") -> str:
    arms = " ".join(f"WHEN '{s.site}' THEN '{getattr(s, attr)}'" for s in S.SITES)
    return f"CASE {key} {arms} END"


def site_of_sql(key: str) -> str:
    names = "','".join(s.site for s in S.SITES)
    return f"(['{names}'])[({key} % {len(S.SITES)}) + 1]"


ARTICLES_SQL = f"""
  SELECT doc_id, site,
         rtrim({_case('art_source')}, '/') || '/article/' || CAST(doc_id AS VARCHAR) AS art_url,
         lower({Q.collapse("split_part(text, chr(10), 1)")}) AS art_title,
         TIMESTAMP '{PUBLISHED_BASE}' + to_minutes(doc_id) AS art_published_at,
         CASE WHEN site = 'webdo' THEN source END AS art_type,
         text AS art_content,
         '{S.ART_CATEGORY}' AS art_category,
         {str(S.INACTIVE).lower()} AS inactive,
         '{S.COUNTRY_CODE}' AS country_code,
         {_case('scrapped_by')} AS scrapped_by,
         {_case('art_source')} AS art_source,
         TIMESTAMP '{TEST_RUN_TS}' AS art_creation_date
  FROM (SELECT doc_id, text, source, {site_of_sql('doc_id')} AS site FROM documents)
"""

CRAWL_SQL = f"""
  SELECT page_id, url, CASE WHEN page_id % 10 = 9 THEN 404 ELSE 200 END AS status_code, html,
         {site_of_sql('page_id')} AS site
  FROM pages
"""


# Markup of the driver's landed pages: links in nav/li/a, title h1, body the
# paragraphs of <article> (last one dropped), no date or category element.
# Each site keeps its own lineage, prefix and date mode. All selectors are
# plain tags, so these pages are read natively.
def pages_profiles() -> dict:
    import dataclasses
    return {s.site: dataclasses.replace(
                s, container=("nav", None), card=("li", None), link=("a", None),
                title=("h1", None), title_child=None, date=("time", None),
                body_kind="paragraphs", body=(("article", None),), type_sel=None)
            for s in S.SITES}


# Elements found by class (X5, X6a, X6b, X7): the same pages with a date, a
# category and body boxes put into them, which the element tree must find.
CLASS_DATE, CLASS_TYPE = ("time", "entry-date published"), ("a", "entry-cat cat-theme")
CLASS_ONE, CLASS_INTRO, CLASS_BODY = ("div", "single-body entry-content"), ("div", "intro"), ("div", "coprs")


def class_profiles(body_kind: str) -> dict:
    import dataclasses
    body = (CLASS_ONE,) if body_kind == "one" else (CLASS_INTRO, CLASS_BODY)
    return {s.site: dataclasses.replace(s, title=("h1", None), title_child=None, date=CLASS_DATE, date_mode="free",
                                        body_kind=body_kind, body=body, type_sel=CLASS_TYPE)
            for s in S.SITES}


# The same pages with the classes that sites put on their elements: whole class
# attributes and single ones, so links, title and paragraphs need the tree (X1,
# X4, X6c as the five sites use them).
CLASSED = (("nav", "menu  main", "menu main"), ("li", "card first", "card"), ("h1", "entry-title big", "entry-title"), ("article", "post body", "post body"))


def classed_profiles() -> dict:
    import dataclasses
    box, card, title, body = ((tag, find) for tag, _, find in CLASSED)
    return {n: dataclasses.replace(p, container=box, card=card, title=title, body=(body,)) for n, p in pages_profiles().items()}


def with_classes(crawl: DataFrame) -> DataFrame:
    html = F.col("html")
    for tag, attr, _ in CLASSED:
        html = F.replace(html, F.lit(f"<{tag}>"), F.lit(f'<{tag} class="{attr}" title="a > b">'))
    return crawl.withColumn("html", html)


def with_class_elements(crawl: DataFrame) -> DataFrame:
    day = F.date_format(F.timestamp_add("MINUTE", F.col("page_id"), ntz(PUBLISHED_BASE)), "d/M/yyyy HH:mm")
    head = F.concat(F.lit(f'<time class="{CLASS_DATE[1]}"> '), day, F.lit(f'</time><a class="{CLASS_TYPE[1]}" href="/c">topic '),
                    (F.col("page_id") % 7).cast("string"), F.lit('</a><div class="intro"> No <b>'), F.col("page_id").cast("string"),
                    F.lit('</b> </div><div class="coprs"><div class="single-body   entry-content"><article>'))
    html = F.replace(F.replace(F.col("html"), F.lit("<article>"), head), F.lit("</article>"), F.lit("</article></div></div>"))
    return crawl.withColumn("html", html)


def with_broken_pages(crawl: DataFrame) -> DataFrame:
    """Some pages without a list container, a title, or a body."""
    n, html = F.col("page_id"), F.col("html")

    def renamed(tag: str, to: str) -> Column:
        return F.replace(F.replace(html, F.lit(f"<{tag}>"), F.lit(f"<{to}>")), F.lit(f"</{tag}>"), F.lit(f"</{to}>"))

    return crawl.withColumn("html", F.when(n % 97 == 96, renamed("nav", "section")).when(n % 7 == 1, renamed("h1", "h2"))
                            .when(n % 7 == 3, renamed("article", "section")).otherwise(html))


def html_text_sql(x: str) -> str:
    """Oracle: tags removed, the entities present in the pages decoded."""
    t = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        t = f"replace({t}, '{ent}', '{ch}')"
    return t


# Paragraph body of <article>: split on <p>, each piece up to </p>; text nodes
# stripped and glued; all but the last paragraph joined by a space.
def paragraphs_sql(html: str) -> str:
    art = f"regexp_extract({html}, '(?s)<article>(.*?)</article>', 1)"
    pieces = f"list_transform(string_split({art}, '<p>')[2:], lambda x: split_part(x, '</p>', 1))"
    node = "list_filter(list_transform(regexp_split_to_array(y, '<[^>]*>'), lambda z: " + \
           Q.strip(html_text_sql("z")) + "), lambda z: z <> '')"
    texts = f"list_transform({pieces}, lambda y: array_to_string({node}, ''))"
    return (f"CASE WHEN len({pieces}) = 0 THEN NULL ELSE "
            f"{Q.collapse(f'array_to_string(({texts})[1:len({texts}) - 1], chr(32))')} END")
