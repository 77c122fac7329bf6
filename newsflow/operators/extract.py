"""Config-driven page extraction.

One job serves every site: each crawl row carries its ``site`` and the
five-row configuration is shipped inside the task closure (fixed size).
Sites whose selectors are plain tags are read natively. For the others only
``site``/key/``html`` cross to Python (``mapInPandas``, Arrow batches);
everything after the parse (whitespace, case, dates, lineage, rejects) is
native Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow import sites as S
from newsflow.functions.dates import bind, parse_by_mode
from newsflow.functions.text import collapse_ws, lower, remove_phrase
from newsflow.operators import htmlwalk as H
from newsflow.operators import nativehtml as N

LINKS_SCHEMA = T.StructType([
    T.StructField("site", T.StringType()),
    T.StructField("page_no", T.LongType()),
    T.StructField("card_no", T.LongType()),
    T.StructField("href", T.StringType()),
    T.StructField("failed", T.BooleanType()),
])

FIELDS_SCHEMA = T.StructType([
    T.StructField("site", T.StringType()),
    T.StructField("art_url", T.StringType()),
    T.StructField("title_raw", T.StringType()),
    T.StructField("date_text", T.StringType()),
    T.StructField("body_raw", T.StringType()),
    T.StructField("type_raw", T.StringType()),
])


# --- per-page helpers (plain Python, run inside tasks) ---------------------------

def page_links(html: str | None, cfg: S.Site) -> list[tuple[int, str | None, bool]]:
    """X1 for one list page: [(card_no, href, failed)], ending at the first failure.

    A page without the container gives one failed row with card_no 0.
    """
    if html is None:
        return [(0, None, True)]
    root = H.parse(html)
    page = root.find(*cfg.container)
    if page is None:
        return [(0, None, True)]
    out = []
    for n, card in enumerate(page.find_all(*cfg.card), start=1):
        el = card.find(*cfg.link)
        a = el if (el is not None and el.tag == "a") else (el.find("a") if el is not None else None)
        if a is None:
            out.append((n, None, True))
            return out
        href = a.get("href")
        if cfg.link_prefix and href is None:      # str + None raises in the reference
            out.append((n, None, True))
            return out
        out.append((n, href, False))
    return out


def page_fields(html: str | None, cfg: S.Site) -> tuple:
    """X4-X7 for one article page: (title_raw, date_text, body_raw, type_raw); None = missing."""
    root = H.parse(html)
    t = root.find(*cfg.title)
    if t is not None and cfg.title_child:
        t = t.find(cfg.title_child)
    title = t.text() if t is not None else None
    d = root.find(*cfg.date)
    date_text = d.text().strip() if d is not None else None
    body = None
    if cfg.body_kind == "one":
        b = root.find(*cfg.body[0])
        body = b.text().strip() if b is not None else None
    elif cfg.body_kind == "two":
        parts = [root.find(*sel) for sel in cfg.body]
        if all(p is not None for p in parts):
            body = "".join(p.text().strip() for p in parts)
    elif cfg.body_kind == "paragraphs":
        b = root.find(*cfg.body[0])
        if b is not None:
            ps = b.find_all("p")
            if ps:                                  # pop() on an empty list raises
                body = " ".join(p.text_stripped() for p in ps[:-1])
    typ = None
    if cfg.type_sel:
        e = root.find(*cfg.type_sel)
        typ = e.text().strip() if e is not None else None
    return title, date_text, body, typ


# --- Spark operators --------------------------------------------------------------

def _native_profile(profiles: dict[str, S.Site]) -> S.Site | None:
    """One profile that stands for all where the sites differ in nothing that
    matters to extraction and no selector needs the element tree."""
    shapes = {(p.container, p.card, p.link, p.title, p.date, p.body_kind, p.body) for p in profiles.values()}
    one = next(iter(profiles.values()))
    return one if len(shapes) == 1 and all(map(N.is_plain, profiles.values())) else None


def extract_links(list_pages: DataFrame, profiles: dict[str, S.Site]) -> DataFrame:
    """List pages (site, page_no, html; html NULL = fetch failed) -> LINKS rows."""
    if cfg := _native_profile(profiles):
        import dataclasses
        strict, lax = (N.page_links(F.col("html"), dataclasses.replace(cfg, link_prefix=p)) for p in ("x", ""))
        prefixed = [s.site for s in profiles.values() if s.link_prefix]
        unknown = F.array(F.struct(F.lit(0).cast("bigint").alias("card_no"), F.lit(None).cast("string").alias("href"), F.lit(True).alias("failed")))
        rows = (F.when(F.col("site").isin(prefixed), strict).when(F.col("site").isin(list(profiles)), lax).otherwise(unknown))
        return list_pages.select("site", F.col("page_no").cast("bigint").alias("page_no"), F.inline(rows))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for site, page_no, html in zip(b["site"], b["page_no"], b["html"]):
                cfg = profiles.get(site)
                found = page_links(html, cfg) if cfg is not None else [(0, None, True)]
                for card_no, href, failed in found:
                    rows.append((site, int(page_no), card_no, href, failed))
            yield pd.DataFrame(rows, columns=[f.name for f in LINKS_SCHEMA.fields])
    src = list_pages.select("site", F.col("page_no").cast("bigint").alias("page_no"), "html")
    return src.mapInPandas(run, LINKS_SCHEMA)


def links_until_error(links: DataFrame, tolerant: bool = False, materialize_links: bool = True) -> DataFrame:
    """The reference stops listing a site at its first failure.

    The first failure per site is found by a partial aggregation (one small
    row per site; adaptive execution picks the join by its real size); rows
    before it are kept. ``tolerant`` only drops the failed rows.
    Both passes read the links, so they are first written once to the shared
    folder (small rows) instead of parsing the list pages twice.
    """
    if tolerant:
        return links.filter(~F.col("failed"))
    if materialize_links:
        from newsflow.session import materialize
        links = materialize(links, "links")
    ok = links.filter(~F.col("failed"))
    first = (links.filter("failed").groupBy("site")
                  .agg(F.min(F.struct("page_no", "card_no")).alias("first_failure")))
    pos = F.struct("page_no", "card_no")
    return (ok.join(first, "site", "left")
              .filter(F.col("first_failure").isNull() | (pos < F.col("first_failure")))
              .drop("first_failure"))


def absolute_links(links: DataFrame, profiles: dict[str, S.Site] | None = None) -> DataFrame:
    """Plain string prefix per site; a NULL href stays NULL."""
    profiles = profiles or S.BY_NAME
    m = F.create_map(*[x for s in profiles.values() for x in (F.lit(s.site), F.lit(s.link_prefix))])
    return links.withColumn("art_url", F.concat(F.coalesce(F.element_at(m, F.col("site")), F.lit("")),
                                                F.col("href")))


def extract_fields(pages: DataFrame, profiles: dict[str, S.Site], url_col: str = "url") -> DataFrame:
    """Article pages (site, url, html) -> raw field texts."""
    if cfg := _native_profile(profiles):
        known = F.col("site").isin(list(profiles))
        fields = N.page_fields(F.col("html"), cfg)
        return pages.select("site", F.col(url_col).alias("art_url"), *[F.when(known, v).alias(k) for k, v in fields.items()])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(site, url, *(page_fields(html, profiles[site]) if site in profiles else (None,) * 4))
                    for site, url, html in zip(b["site"], b[url_col], b["html"])]
            yield pd.DataFrame(rows, columns=[f.name for f in FIELDS_SCHEMA.fields])
    return pages.select("site", url_col, "html").mapInPandas(run, FIELDS_SCHEMA)


def clean_body(body: Column, site: Column, profiles: dict[str, S.Site] | None = None) -> Column:
    """T1 then the site's boilerplate phrase (T4), if it has one."""
    profiles = profiles or S.BY_NAME
    phrases = [(s.site, s.boilerplate) for s in profiles.values() if s.boilerplate]
    if not phrases:
        return collapse_ws(body)

    def strip_phrases(x):
        out = x
        for name, phrase in phrases:
            out = F.when(site == name, remove_phrase(x, phrase)).otherwise(out)
        return out
    return bind(collapse_ws(body), strip_phrases)      # collapse once, not per branch


def flag_fields(fields: DataFrame, profiles: dict[str, S.Site] | None = None) -> DataFrame:
    """X4 (T1+T3), X6 (T1/T4), X5+D*, X7: typed article columns plus
    ``reject_reason`` (X9: missing title or body; NULL = accepted)."""
    profiles = profiles or S.BY_NAME
    mode = F.create_map(*[x for s in profiles.values() for x in (F.lit(s.site), F.lit(s.date_mode))])
    typed = fields.select(
        "site", "art_url",
        lower(collapse_ws(F.col("title_raw"))).alias("art_title"),
        parse_by_mode(F.col("date_text"), F.element_at(mode, F.col("site"))).alias("art_published_at"),
        F.col("type_raw").alias("art_type"),
        clean_body(F.col("body_raw"), F.col("site"), profiles).alias("art_content"))
    reason = (F.when(~F.col("site").isin(list(profiles)), F.lit("unknown site"))
               .when(F.col("art_title").isNull(), F.lit("missing title"))
               .when(F.col("art_content").isNull(), F.lit("missing body")))
    return typed.withColumn("reject_reason", reason)


def fields_to_articles(fields: DataFrame, profiles: dict[str, S.Site] | None = None):
    """(accepted, rejects) from :func:`flag_fields`. Both read the same flagged
    frame; materialise it first (``session.materialize``) when both are used."""
    flagged = flag_fields(fields, profiles)
    accepted = flagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    rejects = flagged.filter(F.col("reject_reason").isNotNull())
    return accepted, rejects
