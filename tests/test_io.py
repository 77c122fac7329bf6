import datetime as dt
import glob
import json
import os

from pyspark.sql import functions as F

from newsflow import sites as S
from newsflow.operators.combine import union_sites
from newsflow.sinks.tables import append_mentions
from newsflow.sources import jsonio as J


def _article(site, **kw):
    row = {"art_url": f"https://x/{site}", "art_title": "t", "art_published_at": "2023-09-01 10:30:00",
           "art_content": "é ü ش", "art_category": "politics", "inactive": False, "country_code": "TN",
           "scrapped_by": S.BY_NAME[site].scrapped_by, "art_source": S.BY_NAME[site].art_source,
           "art_creation_date": "2024-06-01 12:00:00.123000"}
    row.update(kw)
    return row


def test_reads_reference_array_files(spark, tmp_out):
    os.makedirs(tmp_out)
    with open(f"{tmp_out}/ascii.json", "w") as f:            # ensure_ascii=True sites
        f.write(json.dumps([_article("jawhara"), _article("kapitalis")]))
    with open(f"{tmp_out}/utf8.json", "w", encoding="utf-8") as f:   # ensure_ascii=False, pretty
        f.write(json.dumps([_article("ifm")], ensure_ascii=False, indent=2))
    with open(f"{tmp_out}/empty.json", "w") as f:
        f.write("[]")
    df = J.read_articles_json(spark, tmp_out, multiline=True)
    rows = df.collect()
    assert len(rows) == 3 and {r["art_content"] for r in rows} == {"é ü ش"}
    assert all(r["art_type"] is None for r in rows)


def test_json_sink_writes_nulls_and_python_time(spark, tmp_out):
    df = spark.createDataFrame(
        [("webdo", "u", None, dt.datetime(2023, 9, 1, 10, 30), dt.datetime(2023, 9, 1, 10, 30, 0, 123000))],
        "site string, art_url string, art_type string, art_published_at timestamp_ntz, "
        "art_creation_date timestamp_ntz")
    other = df.withColumn("site", F.lit("ifm"))
    J.write_articles_json(df.unionByName(other), tmp_out, partition_by="site")
    text = "".join(open(p, encoding="utf-8").read() for p in glob.glob(f"{tmp_out}/site=webdo/part-*"))
    rec = json.loads(text)
    assert rec == {"art_url": "u", "art_type": None, "art_published_at": "2023-09-01 10:30:00",
                   "art_creation_date": "2023-09-01 10:30:00.123000"}
    text = "".join(open(p, encoding="utf-8").read() for p in glob.glob(f"{tmp_out}/site=ifm/part-*"))
    assert "art_type" not in json.loads(text)               # only webdo files carry the key


def test_union_order_and_missing_columns(spark):
    frames = {}
    for s in S.SITES:
        row = _article(s.site, art_type="Politique") if s.type_sel else _article(s.site)
        schema = J.ARTICLE_JSON if s.type_sel else J.T.StructType(
            [f for f in J.ARTICLE_JSON.fields if f.name != "art_type"])
        frames[s.site] = spark.createDataFrame([tuple(row.get(f.name) for f in schema.fields)], schema)
    out = union_sites(frames).orderBy("source_ord").collect()
    assert [r["scrapped_by"] for r in out] == [S.BY_NAME[s].scrapped_by for s in S.UNION_ORDER]
    assert [r["art_type"] for r in out] == ["Politique", None, None, None, None]
    assert sum(f.count() for f in frames.values()) == len(out)


def test_rows_without_a_known_site_are_written(spark, tmp_out):
    df = spark.createDataFrame([("webdo", "u1", "t"), (None, "u2", "t"), ("other", "u3", "t")], "site string, art_url string, art_type string")
    J.write_articles_json(df, tmp_out, partition_by="site")
    J.write_articles_json(df, tmp_out, partition_by="site", mode="append")
    assert sorted(r["art_url"] for r in J.read_site_json(spark, tmp_out).collect()) == ["u1", "u1", "u2", "u2", "u3", "u3"]


def test_order_over_one_scan_with_an_absent_site(spark, tmp_out):
    from newsflow.operators.combine import append_order
    rows = [(s.site, _article(s.site)["art_url"], "x") for s in S.SITES if s.site != "kapitalis"]
    J.write_articles_json(spark.createDataFrame(rows, "site string, art_url string, art_type string"), tmp_out, partition_by="site")
    got = append_order(J.read_site_json(spark, tmp_out)).orderBy("source_ord").collect()
    assert [r["site"] for r in got] == [s for s in S.UNION_ORDER if s != "kapitalis"]
    assert [r["art_type"] for r in got] == ["x", None, None, None]


def test_append_sink_twice(spark, tmp_out):
    df = spark.createDataFrame([("a", "p", "c", "s", "https://src")],
                               "art_url string, Persons string, Context string, Sentiment string, art_source string")
    append_mentions(df, tmp_out)
    append_mentions(df, tmp_out)
    assert spark.read.parquet(tmp_out).count() == 2


def test_sample_is_first_by_key(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, v string")
    assert J.sample(df, ["k"]).collect()[0]["v"] == "a"
