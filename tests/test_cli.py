import json

from newsflow.__main__ import main
from newsflow.session import scratch_path
from tests.test_extract import ARTICLES

KEY = "cw_0x689RpI-jtRR7oE8h_eQsKImvJapLeSbXpwF4e4="


def loader():
    return lambda texts, lang: [f"en:{t}" for t in texts]


def _links(spark):
    path = scratch_path(spark, "links")
    rows = [("ifm", 1, 1, "u/ifm"), ("ifm", 2, 1, "u/ifm"), ("webdo", 1, 1, "u/webdo")]
    spark.createDataFrame(rows, "site string, page_no long, card_no long, art_url string").write.parquet(path)
    return path


def test_cli_end_to_end(spark, tmp_path, capsys):
    crawl, arts, js, comb, store = (scratch_path(spark, n) for n in ("c", "a", "j", "cmb", "st"))
    rows = [(s, f"u/{s}", 200, h) for s, h in ARTICLES.items()]
    body = {"ifm": ("<div class=\"coprs\"> B. </div>", "<div class=\"coprs\"> Ann Bo met Cy Dee. Then the rest. </div>")}
    rows = [(s, u, c, h.replace(*body[s]) if s in body else h) for s, u, c, h in rows]
    spark.createDataFrame(rows, "site string, url string, status_code int, html string").write.parquet(crawl)
    (tmp_path / "key").write_text(KEY)
    (tmp_path / "lex.json").write_text(json.dumps({"rest": 1}))
    assert main(["articles", "--crawl", crawl, "--out", arts, "--json-out", js, "--run-ts", "2024-06-01 12:00:00"]) == 0
    assert spark.read.parquet(arts).count() == 5
    assert main(["articles", "--crawl", crawl, "--out", arts + "2", "--links", _links(spark), "--provider", "tests.test_cli:loader"]) == 0
    again = spark.read.parquet(arts + "2").orderBy("art_url").collect()
    assert [r["art_url"] for r in again] == ["u/ifm", "u/ifm", "u/webdo"]      # only the listed ones, repeats kept
    assert all(r["art_content"].startswith("en:") for r in again)
    assert main(["concat", "--json-in", js, "--out", comb]) == 0
    assert spark.read.json(comb).count() == 5
    assert main(["mentions", "--articles", arts, "--key-file", str(tmp_path / "key"),
                 "--lexicon", str(tmp_path / "lex.json"), "--out", store]) == 0
    assert spark.read.parquet(store).count() == 1
    assert main(["sample", "--store", store, "--key-file", str(tmp_path / "key")]) == 0
    out = capsys.readouterr().out
    # context "Ann Bo met Cy Dee. Then the rest." has one hit of weight +1 -> 5 stars
    assert "Decrypted Persons: Ann Bo,Cy Dee" in out, out
    assert "Decrypted Sentiment: highly positive" in out, out
