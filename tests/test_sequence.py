"""Hidden Markov model for persons: counts by hand, paths against brute force."""
import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from newsflow.operators import sequence as SQ
from newsflow.operators.automaton import AutomatonTagger


def brute(costs, steps):
    """The cheapest path; of equal ones that with the smallest tags from the end."""
    def price(path):
        way = (SQ.EDGE, *path, SQ.EDGE)
        return sum(steps[a, b] for a, b in itertools.pairwise(way)) + sum(c[t] for c, t in zip(costs, path, strict=True))
    return min(itertools.product(range(SQ.TAGS), repeat=len(costs)), key=lambda p: (price(p), p[::-1]))


def test_path_equals_brute_force():
    draw = random.Random(3)
    for trial in range(200):
        high = draw.choice([1, 3, 2000])                 # few values: many equal paths
        steps = np.array([[draw.randrange(high) for _ in range(4)] for _ in range(4)], np.int64)
        if trial % 2:
            steps[[SQ.OUTSIDE, SQ.EDGE], SQ.LATER] = SQ.NEVER
        sizes = [draw.randrange(0, 8) for _ in range(draw.randrange(0, 6))]
        costs = np.array([[draw.randrange(high) for _ in range(3)] for _ in range(sum(sizes))], np.int64).reshape(-1, 3)
        bounds = np.r_[0, np.cumsum(sizes)].astype(np.int64)
        got = SQ.cheapest(costs, bounds, steps)
        for lo, hi in itertools.pairwise(bounds.tolist()):
            assert tuple(got[lo:hi].tolist()) == brute(costs[lo:hi].tolist(), steps)


def test_counts_tags_and_costs(spark):
    rows = [(["Al", "Bo", "saw", "Al"], [(0, 2), (3, 1)]), (["saw", "X", "YZ"], []), ([], []), (["Al"], [(0, 1)])]
    df = (spark.createDataFrame(rows, "words array<string>, m array<struct<i:int,k:int>>")
          .select("words", SQ.tags(F.col("words"), F.col("m")).alias("tags")))
    assert [r.tags for r in df.collect()] == [[1, 2, 0, 1], [0, 0, 0], [], [1]]
    steps = {}
    for r in SQ.tag_counts(df).collect():
        steps[r.before, r.tag] = steps.get((r.before, r.tag), 0) + r.n
    assert steps == {(3, 1): 2, (1, 2): 1, (2, 0): 1, (0, 1): 1, (1, 3): 2, (3, 0): 1, (0, 0): 2, (0, 3): 1}
    model = SQ.SequenceModel.learn(df, rare=2)
    assert len(model.known) == 2 and model.steps[SQ.OUTSIDE, SQ.LATER] == SQ.NEVER
    want = -1000 * np.log((np.array([0, 3, 0]) + 0.5) / (np.array([4, 3, 1]) + 0.5 * 10))      # Al: B three times
    assert any(np.abs(w - want).max() <= 0.5 for w in model.words)
    shapes = spark.range(1).select(SQ.codes(F.array(*map(F.lit, ["Al", "x", "X", "XY", "Éa", "9"]))).alias("c")).first().c
    assert [c % SQ.SHAPES for c in shapes] == [6, 3, 0, 1, 2, 3]


def test_finds_names_that_the_table_lacks(spark):
    """Names of the table teach the words around a name; others are found there."""
    draw = random.Random(8)
    first, last = [f"F{'abcdefghij'[i]}n" for i in range(10)], [f"L{'abcdefghijklmnopqrst'[i]}m" for i in range(20)]
    people = [f"{a} {b}" for a in first for b in last]
    draw.shuffle(people)
    fill = ["the", "Old", "House", "was", "sold", "near", "Green", "Park"]

    def sentence(p):
        return f"{' '.join(draw.choices(fill, k=5))} said {p} and {' '.join(draw.choices(fill, k=4))}."
    learn = [" ".join(sentence(p) for p in people[k::10]) for k in range(5)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(learn)], "doc_id long, text string")
    known = spark.createDataFrame([(p,) for k in range(5) for p in people[k::10]], "name string")
    model = SQ.SequenceModel.learn(SQ.tagged_sentences(AutomatonTagger(known).spans(docs, "text")))
    unseen = [p for k in range(5, 10) for p in people[k::10]] + ["Zoe Quist"]
    held = spark.createDataFrame([(i, sentence(p)) for i, p in enumerate(unseen)], "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.persons for r in SQ.SequenceTagger(model).tag(held, "text").collect()}
    assert sum(got[i] == [[p]] for i, p in enumerate(unseen)) / len(unseen) >= 0.98
    assert got[len(unseen) - 1] == [["Zoe Quist"]]       # words that no text had: by shape and place


def test_edges(spark):
    texts = [None, "", "...", "Al Bo. " * 3, "one " * 200_000 + "Al Bo", "Al Bo"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, persons string")
    none = SQ.SequenceModel.learn(spark.createDataFrame([], "words array<string>, tags array<int>"))
    assert all(not any(r.persons or []) for r in SQ.SequenceTagger(none).tag(docs, "text").collect())
    names = spark.createDataFrame([("Al Bo",)], "name string")
    model = SQ.SequenceModel.learn(SQ.tagged_sentences(AutomatonTagger(names).spans(docs, "text")), rare=1)
    got = {r.doc_id: r.persons for r in SQ.SequenceTagger(model).tag(docs, "text").collect()}
    assert got[0] is None and not any(got[1]) and not any(got[2])
    assert got[3] == [["Al Bo"]] * 3 + [[]] and got[4] == [["Al Bo"]] and got[5] == [["Al Bo"]]
    plan = SQ.SequenceTagger(model).tag(docs.coalesce(1), "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert SQ.SequenceTagger(model).tag(docs.where("false"), "text").collect() == []


def test_counts_from_names_too_many_for_an_automaton(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["Al Bo met Cy. Al Bo went", "Cy Di. no", None])], "doc_id long, text string")
    names = spark.createDataFrame([("Al Bo",), ("Cy Di",), ("Cy",)], "name string")
    rows = lambda m: sorted(map(repr, SQ.tag_counts(SQ.tagged_sentences(AutomatonTagger(names, max_words=m).spans(docs, "text"))).collect()))
    assert rows(2) == rows(100)


def test_counts_in_parts_and_codes_by_expression(spark, monkeypatch):
    """Tasks sum their counts, in parts where they are many; a word's code is that of Spark's own functions."""
    draw = random.Random(5)
    words = ["Al", "x", "X", "XY", "Éa", "ÉÀ", "𝒜b", "𐐀", "ǅa", "ⅷ", "ß", "", "名", "aB"]
    rows = [([w for w in draw.choices(words, k=draw.randrange(0, 9))],) for _ in range(300)]
    rows = [(w, [draw.randrange(SQ.TAGS) for _ in w]) for w, in rows]
    df = spark.createDataFrame(rows, "words array<string>, tags array<int>").coalesce(1)
    want = {}
    for w, t in rows:
        for i, (a, b) in enumerate(zip([SQ.EDGE, *t], [*t, SQ.EDGE], strict=True)):
            key = (a, b, SQ.word_code(w[i]) + 4 * (i == 0) if i < len(w) else None)
            want[key] = want.get(key, 0) + (len(w) > 0)
    want = sorted((a, b, *((None, None) if c is None else divmod(c, SQ.SHAPES)), n) for (a, b, c), n in want.items() if n)
    assert sorted(map(tuple, SQ.tag_counts(df).collect()), key=str) == sorted(want, key=str)
    batches = [spark.createDataFrame(rows[k:k + 50], df.schema).where("size(words) > 0").toArrow().combine_chunks().to_batches()[0] for k in range(0, 300, 50)]
    monkeypatch.setattr(SQ, "HELD", 8)
    parts = [r for b in SQ._summed(iter(batches)) for r in b.to_pylist()]
    assert len(parts) > len(want) and sum(r["n"] for r in parts) == sum(n for *_, n in want)
    kind = (F.when(F.col("w").rlike(r"^\p{Lu}$"), 0).when(F.col("w").rlike(r"^\p{Lu}+$"), 1).when(F.col("w").rlike(r"^\p{Lu}"), 2).otherwise(3))
    by_spark = spark.createDataFrame([(w,) for w in words], "w string").select(
        "w", (F.conv(F.substring(F.md5(F.col("w").cast("binary")), 1, SQ.HEX), 16, 10).cast("int") * SQ.SHAPES + kind).alias("c")).collect()
    assert [r.c for r in by_spark] == [SQ.word_code(r.w) for r in by_spark]


def test_paths_in_groups_and_one_by_one():
    """Sentences of unlike lengths, whatever the number followed at once."""
    draw = np.random.default_rng(4)
    for trial in range(60):
        high = (1, 3, 2000)[trial % 3]
        steps = draw.integers(0, high, (4, 4))
        if trial % 2:
            steps[[SQ.OUTSIDE, SQ.EDGE], SQ.LATER] = SQ.NEVER
        sizes = draw.integers(0, 7, draw.integers(0, 40))
        costs, bounds = draw.integers(0, high, (sizes.sum(), SQ.TAGS)), np.r_[0, np.cumsum(sizes)]
        symbol = draw.permutation(len(costs))
        want = [t for lo, hi in itertools.pairwise(bounds.tolist()) for t in brute(costs[symbol[lo:hi]].tolist(), steps)]
        for few, at_once in ((0, 1000), (2, 3), (5, 16), (100, 1000)):
            assert SQ.cheapest_paths(costs, symbol, bounds, steps, few, at_once).tolist() == want


def test_counts_and_decoding_cut_no_words_in_the_plan(spark):
    """Names too many for an automaton: no shuffle, no join, no word as a string of its own."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["Al Bo met Cy. Al Bo went", "Cy Di. no", None, "", "AL BO. al bo cy di"])], "doc_id long, text string")
    names = spark.createDataFrame([("Al Bo",), ("Cy Di",), ("Cy",)], "name string")
    rows = lambda t: sorted(map(repr, SQ.tag_counts(SQ.tagged_sentences(t.spans(docs, "text"))).collect()))
    listed, joined = AutomatonTagger(names, max_words=2), AutomatonTagger(names, max_words=2, max_listed=1)
    assert listed.dealt.listed and not joined.dealt.listed
    assert rows(listed) == rows(joined) == rows(AutomatonTagger(names))
    model = SQ.SequenceModel.learn(SQ.tagged_sentences(listed.spans(docs, "text")), rare=1)
    for df in (SQ.tagged_sentences(listed.spans(docs, "text")), SQ.SequenceTagger(model).tag(docs, "text")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan and "regexp_extract_all" not in plan
