"""Scale properties of the physical plans (what the README claims)."""
import re

import pytest

from __spark_entry__ import queries
from tests.conftest import SF_SMALL


def plan(spark, name):
    return queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["person_context", "attach_metadata", "encrypt_roundtrip", "chunk_sentiment",
                                  "persons_gazetteer"])
def test_mention_path_has_no_key_shuffle(spark, name):
    p = plan(spark, name)
    assert "Exchange" not in p, p[:2000]


@pytest.mark.parametrize("name", ["attach_metadata", "encrypt_roundtrip"])
def test_chunks_are_scored_once(spark, name):
    p = plan(spark, name)
    assert len(re.findall(r"regexp_extract_all\(lower\(", p)) == 1, p[:3000]


@pytest.mark.parametrize("name", ["page_links", "page_title", "body_paragraphs", "articles_from_pages", "articles_from_links", "reject_split"])
def test_plain_pages_stay_in_the_jvm(spark, name):
    assert "MapInPandas" not in plan(spark, name)


@pytest.mark.parametrize("name", ["link_counts", "links_until_error"])
def test_list_pages_parsed_once(spark, name):
    p = plan(spark, name)
    assert p.count("MapInPandas") <= 1


def test_scans_are_pruned_and_filters_pushed(spark):
    p = plan(spark, "translate_misses")
    assert re.search(r"PushedFilters: \[[^]]*Not\(EqualTo\(lang,en\)\)", p)
    assert "ReadSchema: struct<text:string,lang:string>" in p
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan(spark, "person_context")


def test_site_aggregates_are_partial(spark):
    p = plan(spark, "article_counts")
    assert "partial_count" in p
