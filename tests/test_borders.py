"""Learnt sentence borders."""
import random

import pytest
from pyspark.sql import functions as F

from newsflow.operators.borders import Borders, LearnedTagger, association
from newsflow.operators.tagging import rule_persons
from newsflow.plans import catalog
from tests.conftest import SF_SMALL

WORDS = "river house green walk stone paper light common market winter garden slowly".split()


def corpus():
    """Prose with abbreviations before names and numbers, and, for "etc.", before
    sentence starts too."""
    draw = random.Random(7)
    rows = []
    for i in range(300):
        out = []
        for _ in range(8):
            s = [draw.choice(WORDS) for _ in range(draw.randrange(4, 9))]
            kind = draw.randrange(5)
            if kind == 0:
                s[2] = draw.choice(["Dr. Salah", "Dr. Amira", "Mme. Amira"])
            elif kind == 1:
                s[1] = f"no. {draw.randrange(90)}"
            elif kind == 2:
                s[-1] = "etc"
            elif kind == 3:
                s[1] = "e.g. stone"
            out.append(("The " if draw.random() < 0.6 else draw.choice(WORDS).capitalize() + " ") + " ".join(s) + ("." if kind == 2 else draw.choice("...!?")))
        rows.append((i, " ".join(out)))
    return rows


CASES = [
    ("She met Dr. Salah. The river was green.", ["She met Dr. Salah.", "The river was green."]),
    ("See no. 5 of the market! Dr. Salah walked.", ["See no. 5 of the market!", "Dr. Salah walked."]),
    ("A stone, paper etc. The house was green.", ["A stone, paper etc.", "The house was green."]),
    ("Trees, e.g. stone pines, grow.\n Mme. Amira saw them?  Yes.", ["Trees, e.g. stone pines, grow.", "Mme. Amira saw them?", "Yes."]),
    ("Mr. M. Salah and J. Amira met.", None),          # initials never end a sentence before a name
    ("no mark", ["no mark"]), ("", [""]), (None, None), (" . a. ", [" .", "a.", ""]), ("paper. light.", ["paper.", "light."]),
]


@pytest.fixture(scope="module")
def learnt(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string").repartition(4)
    return docs, Borders.learn(docs)


def test_abbreviations_are_learnt(learnt):
    known = {r.a for r in learnt[1].abbreviated.collect()}
    assert {"dr", "no", "mme", "e.g", "etc"} <= known and not known & set(WORDS)
    parted = {(r.a, r.b) for r in learnt[1].parted.collect()}
    assert ("etc", "the") in parted and ("dr", "salah") not in parted and ("mme", "amira") not in parted


def test_cases(spark, learnt):
    texts = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "doc_id long, text string")
    for limit in (20_000, 0):                           # in the plan, and joined
        borders = Borders(learnt[1].abbreviated, learnt[1].parted, limit)
        got = {r.doc_id: r.sents for r in borders.split(texts).collect()}
        for i, (text, want) in enumerate(CASES):
            if i != 4:
                assert got[i] == want, text
        assert got[4][-1].endswith("M. Salah and J. Amira met.")


def test_both_forms_agree_and_nothing_is_lost(learnt):
    docs, borders = learnt
    a = {r.doc_id: r.sents for r in borders.split(docs).collect()}
    b = {r.doc_id: r.sents for r in Borders(borders.abbreviated, borders.parted, 0).split(docs).collect()}
    assert a == b
    text = {r.doc_id: r.text for r in docs.collect()}
    assert all(" ".join(s).split() == text[i].split() for i, s in a.items())


def test_association_is_the_likelihood_ratio(spark):
    import math
    def brute(k, n1, n2, n):
        def likely(k, n, p):
            return (k * math.log(p) if k else 0) + ((n - k) * math.log(1 - p) if n > k else 0)
        p, p1, p2 = n2 / n, k / n1, (n2 - k) / (n - n1)
        return 2 * (likely(k, n1, p1) + likely(n2 - k, n - n1, p2) - likely(k, n1, p) - likely(n2 - k, n - n1, p)) if p1 > p else 0
    rows = [(5, 10, 20, 1000), (1, 10, 500, 1000), (10, 10, 10, 1000), (0, 10, 20, 1000)]
    df = spark.createDataFrame(rows, "k long, n1 long, n2 long, n long")
    got = [r[0] for r in df.select(association(F.col("k"), F.col("n1"), F.col("n2"), F.col("n"))).collect()]
    assert got == pytest.approx([brute(*r) for r in rows])


def test_empty_corpus_and_tagger(spark, learnt):
    none = Borders.learn(spark.createDataFrame([(1, None)], "doc_id long, text string"))
    assert none.abbreviated.isEmpty() and none.parted.isEmpty()
    df = spark.createDataFrame([(1, "Dr. Salah Ben met Amira Ben. Yes.")], "doc_id long, text string")
    got = LearnedTagger(learnt[1], rule_persons).tag(df, "text").first()
    assert got.sents == ["Dr. Salah Ben met Amira Ben.", "Yes."] and got.persons == [["Salah Ben", "Amira Ben"], []]


def test_query_learns_the_put_in_abbreviations(spark):
    known = {r.a for r in Borders.learn(catalog._abbreviated(spark, SF_SMALL)).abbreviated.collect()}
    assert {"cf", "dr", "nr", "etc", "e.g"} <= known
