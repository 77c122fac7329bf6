"""Constant and lineage columns and the article column set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow import sites as S
from newsflow.functions.dates import ingestion_ts

# Field order of an article record; art_type exists for webdo only.
ARTICLE_FIELDS = ["art_url", "art_title", "art_published_at", "art_type", "art_content",
                  "art_category", "inactive", "country_code", "scrapped_by", "art_source",
                  "art_creation_date"]


def add_constants(df: DataFrame) -> DataFrame:
    """Fixed category, inactive flag and country."""
    return df.withColumns({"art_category": F.lit(S.ART_CATEGORY),
                           "inactive": F.lit(S.INACTIVE),
                           "country_code": F.lit(S.COUNTRY_CODE)})


def add_lineage(df: DataFrame, site_col: str = "site", run_ts: str | None = None) -> DataFrame:
    """P2 + D5: bot name and base source from the site configuration, and
    the processing time. The configuration is a five-entry map literal."""
    def lookup(attr):
        m = F.create_map(*[x for s in S.SITES for x in (F.lit(s.site), F.lit(getattr(s, attr)))])
        return F.element_at(m, F.col(site_col))
    return df.withColumns({"scrapped_by": lookup("scrapped_by"),
                           "art_source": lookup("art_source"),
                           "art_creation_date": ingestion_ts(run_ts)})

