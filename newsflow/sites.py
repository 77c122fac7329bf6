"""The five site configurations: the five scrapers are one job
with five config rows.

A selector is ``(tag, class)``; ``class`` may be None (any element of that
tag). A class with spaces must equal the element's whole class attribute
(tokens joined by one space); a one-token class matches any element that
carries that token.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import functions as F


@dataclass(frozen=True)
class Site:
    site: str
    lang: str
    list_template: str          # '{i}' is replaced by the 1-based page number
    container: tuple            # list page: first container
    card: tuple                 # list page: all cards inside the container
    link: tuple                 # first link element inside a card; its first <a href>
    link_prefix: str            # plain string prefix (not URL resolution)
    title: tuple                # first title element
    title_child: str | None     # then its first child of this tag
    date: tuple                 # first date element
    date_mode: str              # 'free' | 'strict_dmy' | 'iso_or_free'
    body_kind: str              # 'one' | 'two' | 'paragraphs'
    body: tuple                 # tuple of selectors (two for 'two')
    boilerplate: str | None
    type_sel: tuple | None      # optional category element (webdo)
    art_source: str
    scrapped_by: str
    extra: dict = field(default_factory=dict)


# --- fixed values: must equal the reference's site constants -----------------
SITES: tuple[Site, ...] = (
    Site(site="ifm", lang="ar",
         list_template="https://www.ifm.tn/ar/articles/سياسة/2?page={i}",
         container=("div", "col-md-8 col-sm-7 dual-posts padding-bottom-30"),
         card=("div", "row"), link=("h4", None), link_prefix="",
         title=("div", "blog-single-head margin-top-25"), title_child="h2",
         date=("span", "date"), date_mode="free",
         body_kind="two", body=(("div", "intro"), ("div", "coprs")),
         boilerplate=None, type_sel=None,
         art_source="https://www.ifm.tn/ar", scrapped_by="ifm-ar.bot"),
    Site(site="nessma", lang="ar",
         list_template="https://www.nessma.tv/ar",
         container=("div", "site-content"),
         card=("div", "post"), link=("a", None), link_prefix="",
         title=("h1", "entry-title disabled_text"), title_child=None,
         date=("li", "publish-date"), date_mode="free",
         body_kind="one", body=(("div", "entry-content disabled_text"),),
         boilerplate="email facebook pinterest twitter print", type_sel=None,
         art_source="https://www.nessma.tv/ar", scrapped_by="nessma-ar.bot"),
    Site(site="jawhara", lang="fr",
         list_template="https://www.jawharafm.net/fr/articles/actualite/politique/44/{i}",
         container=("div", "article"),
         card=("div", "elem_ev"), link=("h2", "titr_ev"),
         link_prefix="https://www.jawharafm.net",
         title=("h1", "titr_page"), title_child=None,
         date=("span", "dat_ev"), date_mode="strict_dmy",
         body_kind="one", body=(("div", "article_text"),),
         boilerplate=None, type_sel=None,
         art_source="https://www.jawharafm.net/fr/", scrapped_by="jawharafm.bot"),
    Site(site="kapitalis", lang="fr",
         list_template="https://kapitalis.com/tunisie/category/politique/page/{i}/",
         container=("div", "cmsmasters_archive"),
         card=("article", None), link=("figure", "cmsmasters_img_wrap"), link_prefix="",
         title=("header", "cmsmasters_post_header entry-header"), title_child=None,
         date=("abbr", "published"), date_mode="iso_or_free",
         body_kind="paragraphs", body=(("div", "cmsmasters_post_content entry-content"),),
         boilerplate=None, type_sel=None,
         art_source="https://kapitalis.com/tunisie/", scrapped_by="kapitalis.bot"),
    Site(site="webdo", lang="fr",
         list_template="https://www.webdo.tn/fr/search?q=politique&page={i}",
         container=("div", "posts-listing"),
         card=("div", "col-xs-12 col-sm-6 col-md-3"), link=("h3", "post__title typescale-0"),
         link_prefix="",
         title=("h1", "entry-title"), title_child=None,
         date=("time", "entry-date published"), date_mode="iso_or_free",
         body_kind="one", body=(("div", "single-body entry-content typography-copy"),),
         boilerplate=None, type_sel=("a", "entry-cat cat-theme cat-5"),
         art_source="https://www.webdo.tn/fr", scrapped_by="webdo_tn.bot"),
)
# Order in which the combined file appends the per-site files.
UNION_ORDER = ("webdo", "nessma", "kapitalis", "jawhara", "ifm")
# Constant article fields.
ART_CATEGORY = "politics"
INACTIVE = False
COUNTRY_CODE = "TN"
PAGES_PER_RUN = 3
# -----------------------------------------------------------------------------

BY_NAME = {s.site: s for s in SITES}


def site_of(index_col, sites=SITES):
    """Column: site name for a 0-based index into ``sites``."""
    return F.element_at(F.array(*[F.lit(s.site) for s in sites]), (index_col % len(sites)).cast("int") + 1)
