from pyspark.sql import Window
from pyspark.sql import functions as F

from newsflow.functions.text import strip_ws
from newsflow.operators import mentions as M
from newsflow.operators.sentiment import LexiconScorer, add_sentiment
from newsflow.operators.tagging import GazetteerTagger, ModelTagger, RuleTagger, split_sentences
from newsflow.plans.mentions_job import mention_rows
from tests.conftest import SF_SMALL


class ListTagger:
    """Test provider: fixed sentences and persons per article."""
    name = "fixed"

    def __init__(self, sents, persons):
        self.sents, self.persons = sents, persons

    def tag(self, df, text_col):
        return (df.withColumn("sents", F.array(*[F.lit(s) for s in self.sents]))
                  .withColumn("persons", F.array(*[F.array(*[F.lit(p) for p in ps]).cast("array<string>")
                                                   for ps in self.persons])))


def _ctx(spark, sents, persons):
    df = spark.createDataFrame([(1, "ignored")], "doc_id long, text string")
    out = M.person_context(df, "text", ["doc_id"], tagger=ListTagger(sents, persons))
    return [(r["sentence_no"], r["chunk"]) for r in out.orderBy("sentence_no", "chunk_no").collect()]


def test_context_edges(spark):
    assert _ctx(spark, ["s0", "s1", "s2", "s3"], [["P"], [], [], ["Q"]]) == [(0, "s0 s1"), (3, "s2 s3")]


def test_context_newline_and_blank_neighbours(spark):
    assert _ctx(spark, ["x\ny", " ", "s2"], [[], ["P"], []]) == [(1, "xy  s2")]


def test_persons_joined_and_no_person(spark):
    df = spark.createDataFrame([(1, "Ann Bo met Cy Dee and Ann Bo here. nothing"), (2, "no persons at all.")],
                               "doc_id long, text string")
    out = M.person_context(df, "text", ["doc_id"], tagger=RuleTagger())
    got = out.select("doc_id", M.persons_string(F.col("persons")).alias("p")).collect()
    assert [(r["doc_id"], r["p"]) for r in got] == [(1, "Ann Bo,Cy Dee,Ann Bo")]


def test_chunks_of_long_context(spark):
    long = "Ab Cd " + "x" * 1094
    got = _ctx(spark, [long], [["Ab Cd"]])
    assert [len(c) for _, c in got] == [512, 512, 76] and "".join(c for _, c in got) == long


def test_rule_segmentation(spark):
    df = spark.createDataFrame([("Hello there.  Next one!\nLast? ",)], "t string")
    assert df.select(split_sentences(F.col("t"))).first()[0] == ["Hello there.", "Next one!", "Last?", ""]


def test_array_window_equals_lag_lead(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    tagged = RuleTagger().tag(docs, "text")
    a = M.sentences_with_persons(tagged, ["doc_id"]).select("doc_id", "sentence_no", "context")
    s = docs.select("doc_id", F.posexplode(split_sentences(F.col("text"))).alias("i", "s"))
    w = Window.partitionBy("doc_id").orderBy("i")
    b = (s.withColumn("prv", F.lag(strip_ws("s")).over(w)).withColumn("nxt", F.lead(strip_ws("s")).over(w))
          .filter(F.size(F.regexp_extract_all("s", F.lit(r"\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)+"), 0)) > 0)
          .select("doc_id", F.col("i").cast("bigint").alias("sentence_no"),
                  F.replace(F.concat_ws(" ", "prv", strip_ws("s"), "nxt"), F.lit("\n"), F.lit("")).alias("context")))
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_flagship_has_no_exchange(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "source")
    rows, _ = mention_rows(docs.withColumnRenamed("text", "art_content"), LexiconScorer({"the": 1}))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_gazetteer_leftmost_longest(spark):
    from newsflow.operators.tagging import GazetteerTableTagger
    names = ["Stteen Erachtz", "Stteen", "Erachtz", "Ab Cd Ef", "Cd Ef Gh"]
    df = spark.createDataFrame([(1, "x Stteen Erachtz y stteen and Erachtz. Ab Cd Ef Gh Ab Cd")],
                               "doc_id long, t string")
    want = [["Stteen Erachtz", "stteen", "Erachtz"], ["Ab Cd Ef"]]
    assert GazetteerTagger(names).tag(df, "t").select("persons").first()[0] == want
    table = spark.createDataFrame([(n,) for n in names], "name string")
    assert GazetteerTableTagger(table).tag(df, "t").select("persons").first()[0] == want


def test_long_and_hyphenated_names(spark):
    from newsflow.operators.tagging import GazetteerTableTagger
    names = ["Zine El Abidine Ben", "Jean-Luc Martin", "d'Arc"]
    df = spark.createDataFrame([(1, "Then zine el abidine ben met Jean-Luc Martin and Jeanne d'Arc here")], "doc_id long, t string")
    want = [["zine el abidine ben", "Jean Luc Martin", "d Arc"]]
    assert GazetteerTagger(names).tag(df, "t").select("persons").first()[0] == want
    table = spark.createDataFrame([(n,) for n in names], "name string")
    assert GazetteerTableTagger(table).tag(df, "t").select("persons").first()[0] == want


def test_long_sentence_is_linear(spark):
    import time
    df = spark.createDataFrame([(1, "Jean-Luc Martin " * 10_000)], "doc_id long, t string")
    tagger = GazetteerTagger(["Jean-Luc Martin", "Nobody"])
    t = time.time()
    assert len(tagger.tag(df, "t").select("persons").first()[0][0]) == 10_000
    assert time.time() - t < 60


def test_label_filter(spark):
    from newsflow.operators.tagging import ModelEntityTagger, RuleEntityTagger
    df = spark.createDataFrame([(1, "Ann Bo saw 12 cats. Cy Dee saw 3.")], "doc_id long, text string")
    out = RuleEntityTagger().tag(df, "text").first()
    assert out["persons"] == [["Ann Bo"], ["Cy Dee"]]
    assert [[tuple(e) for e in s] for s in out["entities"]] == [[("Ann Bo", "PERSON", 0), ("12", "CARDINAL", 11)], [("Cy Dee", "PERSON", 0), ("3", "CARDINAL", 11)]]
    assert RuleEntityTagger("CARDINAL").tag(df, "text").first()["persons"] == [["12"], ["3"]]

    def load():
        return lambda text: ([text], [[("Ann Bo", "PERSON", 0), ("Rome", "LOC", 9), ("Cy", "PERSON", 20)]])
    got = M.person_context(df, "text", ["doc_id"], tagger=ModelEntityTagger(load)).first()
    assert list(got["persons"]) == ["Ann Bo", "Cy"]


def test_two_loaders_of_one_factory_do_not_share_a_model(spark):
    from newsflow.operators.sentiment import ModelScorer

    def factory(label):
        def load():
            return lambda chunks: [label for _ in chunks]
        return load
    df = spark.createDataFrame([(1, "x")], "i int, chunk string").coalesce(1)
    got = [ModelScorer(factory(x)).score(df).first()["stars"] for x in ("5 stars", "1 star")]
    assert got == [5, 1]


def test_unknown_labels_are_rejected(spark):
    from newsflow.operators.sentiment import ModelScorer
    from newsflow.plans.mentions_job import mentions_job

    def load():
        return lambda chunks: ["6 stars" if "bad" in c else "good" if "odd" in c else "4 stars" for c in chunks]
    arts = spark.createDataFrame([("a", "Ann Bo is bad."), ("b", "Cy Dee is ok."), ("c", "Ed Fo is odd.")], "art_url string, art_content string")
    good, rejects = mentions_job(arts, "cw_0x689RpI-jtRR7oE8h_eQsKImvJapLeSbXpwF4e4=", ModelScorer(load))
    assert [r["art_url"] for r in good.collect()] == ["b"]
    assert sorted((r["art_url"], r["reason"]) for r in rejects.collect()) == [(u, "unknown sentiment label") for u in "ac"]


def _fake_ner():
    def run(text):
        sents = text.split(". ")
        return sents, [[w for w in s.split() if w.istitle()] for s in sents]
    return run


def test_model_tagger_plugin(spark):
    df = spark.createDataFrame([(1, "Alice met bob. Then Carol left")], "doc_id long, text string")
    out = M.person_context(df, "text", ["doc_id"], tagger=ModelTagger(_fake_ner))
    got = [(r["sentence_no"], list(r["persons"])) for r in out.orderBy("sentence_no").collect()]
    assert got == [(0, ["Alice"]), (1, ["Then", "Carol"])]


def test_sentiment_buckets_and_labels(spark):
    df = spark.createDataFrame([(1, "good good"), (2, "bad"), (3, "meh"), (4, "good bad"), (5, "fine ok")],
                               "i int, chunk string")
    out = add_sentiment(df, LexiconScorer({"good": 2, "bad": -2, "ok": 0, "fine": 1}))
    got = {r["i"]: (r["stars"], r["sentiment"]) for r in out.collect()}
    assert got == {1: (5, "highly positive"), 2: (1, "highly negative"), 3: (3, "neutral"),
                   4: (3, "neutral"), 5: (4, "positive")}


def _fake_stars():
    def run(chunks):
        return ["5 stars" if "good" in c else "1 star" for c in chunks]
    return run


def test_model_scorer_plugin(spark):
    from newsflow.operators.sentiment import ModelScorer
    df = spark.createDataFrame([(1, "good day"), (2, "bad day")], "i int, chunk string")
    got = {r["i"]: r["sentiment"] for r in add_sentiment(df, ModelScorer(_fake_stars)).collect()}
    assert got == {1: "highly positive", 2: "highly negative"}


def test_gazetteer_table_equals_inline(spark):
    from newsflow.operators.tagging import GazetteerTableTagger
    from newsflow.plans.catalog import FIXTURE_NAMES
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    names = spark.createDataFrame([(n,) for n in FIXTURE_NAMES], "name string")
    a = M.sentences_with_persons(GazetteerTagger(FIXTURE_NAMES).tag(docs, "text"), ["doc_id"])
    b = M.sentences_with_persons(GazetteerTableTagger(names).tag(docs, "text"), ["doc_id"])
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_lexicon_table_equals_inline(spark):
    from newsflow.operators.sentiment import LexiconTableScorer
    from newsflow.plans.catalog import FIXTURE_LEXICON
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    pc = M.person_context(docs, "text", ["doc_id"])
    lex = spark.createDataFrame(list(FIXTURE_LEXICON.items()), "word string, weight int")
    cols = ["doc_id", "sentence_no", "chunk_no", "hits", "stars"]
    a = LexiconScorer(FIXTURE_LEXICON).score(pc).select(*cols)
    for t in [LexiconTableScorer(lex, ["doc_id", "sentence_no", "chunk_no"]).score(pc).select(*cols)]:
        assert a.count() == t.count() and a.exceptAll(t).count() == 0
