"""Token automaton: against brute force and the other gazetteer forms."""
import random

import numpy as np
from pyspark.sql import functions as F

from newsflow.operators import automaton as A
from newsflow.operators.automaton import AutomatonTagger, Matcher, TokenAutomaton
from newsflow.operators.tagging import GazetteerTagger


def brute(words, names):
    out, i = [], 0
    longest = max(map(len, names), default=0)
    while i < len(words):
        k = next((k for k in range(longest, 0, -1) if tuple(words[i:i + k]) in names and i + k <= len(words)), 0)
        if k:
            out.append((i, k))
        i += k or 1
    return out


def test_spans_equal_brute_force():
    draw = random.Random(5)
    for _ in range(400):
        letters = "abcd"[:draw.randrange(1, 5)]
        names = {tuple(draw.choice(letters) for _ in range(draw.randrange(1, 6))) for _ in range(draw.randrange(0, 12))}
        m = Matcher(TokenAutomaton([list(n) for n in names]))
        sentences = [[draw.choice(letters + "x") for _ in range(draw.randrange(0, 25))] for _ in range(4)]
        ids = m.a.word_ids([w for s in sentences for w in s])
        bounds = np.r_[0, np.cumsum([len(s) for s in sentences])]
        assert m.spans(ids, bounds) == [brute(s, names) for s in sentences]


def test_failure_links_lead_to_the_longest_suffix():
    names = [list("abcd"), list("bce"), list("cd"), list("d")]
    a = TokenAutomaton(names)
    paths = {0: ()}
    for key, child in zip(a.keys.tolist(), a.child.tolist(), strict=True):
        paths.setdefault(child, (key // len(a.words), key % len(a.words)))
    spell = lambda s: () if not s else (*spell(paths[s][0]), paths[s][1])
    known = {spell(s): s for s in paths}
    for path, s in known.items():
        assert a.fail[s] == max((known[path[k:]] for k in range(1, len(path) + 1) if path[k:] in known), key=lambda t: len(spell(t)), default=0)


def test_tagger_equals_the_other_forms(spark):
    names = ["Jean Dupont", "jean", "Dupont  Martin", "Martin de la Tour", None, "", "12", "Élise", "élise", "de la"]
    texts = ["Jean Dupont Martin de la Tour. ÉLISE? Jean de la Tour!", None, "", "no one here", "JEAN-DUPONT Martin. de la. de  la",
             "Dupont Martin Dupont. " * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    table = spark.createDataFrame([(n,) for n in names], "name string")
    rows = lambda df: sorted((r.doc_id, r.sents, r.persons) for r in df.select("doc_id", "sents", "persons").collect())
    want = rows(GazetteerTagger([n for n in names if n]).tag(docs, "text"))
    one = AutomatonTagger(table)
    assert one.dealt is None and rows(one.tag(docs, "text")) == want
    assert "Exchange" not in one.tag(docs.coalesce(1), "text")._jdf.queryExecution().optimizedPlan().toString()
    dealt = AutomatonTagger(table, max_words=3)
    assert dealt.dealt is not None
    found = lambda rs: [(i, s, [p or [] for p in ps or []]) for i, s, ps in rs if s]
    assert found(rows(dealt.tag(docs, "text"))) == found(want)


def test_no_names_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, "A b. C", "x")], "doc_id long, text string, persons string")
    got = AutomatonTagger(spark.createDataFrame([], "name string")).tag(docs, "text").first()
    assert got.persons == [[], []] and got.doc_id == 1
    empty = AutomatonTagger(docs.select(F.col("text").alias("name"))).tag(docs.where("false"), "text")
    assert empty.collect() == []


def test_dealt_names_give_the_same_places(spark):
    draw = random.Random(8)
    say = lambda n: " ".join(draw.choice(["Ab", "cd", "É", "x", "no"]) for _ in range(n))
    texts = [say(draw.randrange(0, 30)).replace("no", "no. ") for _ in range(40)] + [None, "", "...", "Ab cd. " * 30]
    keys = [None if i % 7 == 0 else i % 5 for i in range(len(texts))]                    # repeated and null
    docs = spark.createDataFrame(list(zip(keys, texts, strict=True)) * 2, "doc_id long, text string").repartition(3)
    names = spark.createDataFrame([(say(draw.randrange(1, 5)),) for _ in range(12)] + [("Ab cd Ab",), (None,)], "name string")
    rows = lambda t: sorted(repr((r.doc_id, r.sents, r._toks, r._spans)) for r in t.spans(docs, "text").collect())
    dealt = AutomatonTagger(names, max_words=3)
    assert dealt.dealt and rows(dealt) == rows(AutomatonTagger(names))
    persons = lambda t: sorted(repr((r.doc_id, r.persons)) for r in t.tag(docs, "text").collect())
    assert persons(dealt) == persons(AutomatonTagger(names))


def test_few_places_but_the_names_pass_the_bitmap(spark):
    listed = spark.createDataFrame([([f"a{i}", f"b{i}"],) for i in range(3000)], "w array<string>")
    dealt = A.DealtNames(listed)
    told = A._may_be_names(dealt.shared)
    count = lambda words: sum(len(s) for t in told(A.pa.array([[words]])).to_pylist() for s in t)
    assert all(count([f"a{i}", f"b{i}"]) == 1 for i in range(0, 3000, 100))
    assert count([f"{c}{i}" for i in range(10_000) for c in "cd"]) < 1000      # of 19,999 pairs
    full = A.DealtNames(listed, max_bits=15)                                   # a smaller bitmap lets more pass, the join drops them
    docs = spark.createDataFrame([(1, "Aa bb." * 3)], "doc_id long, text string")
    assert full.spans(docs, "text").first()._spans == [[]]


def test_names_told_by_hashes_and_joined_names_give_the_same_places(spark):
    draw = random.Random(9)
    say = lambda n: " ".join(draw.choice(["Ab", "cd", "É", "é", "x", "ΟΔΟΣ", "no", "a-b"]) for _ in range(n))
    texts = [say(draw.randrange(0, 30)).replace("no", "no. ") for _ in range(40)] + [None, "", "...", "Ab cd. " * 30]
    docs = spark.createDataFrame([(i % 5, t) for i, t in enumerate(texts)] * 2, "doc_id long, text string").repartition(3)
    names = spark.createDataFrame([(say(draw.randrange(1, 5)),) for _ in range(12)] + [("Ab cd Ab",), (None,)], "name string")
    rows = lambda t: sorted(repr((r.doc_id, r.sents, r._toks, r._spans)) for r in t.spans(docs, "text").collect())
    listed, joined = AutomatonTagger(names, max_words=3), AutomatonTagger(names, max_words=3, max_listed=0)
    assert listed.dealt.listed and not joined.dealt.listed
    assert rows(listed) == rows(joined) == rows(AutomatonTagger(names))
    plan = listed.spans(docs.coalesce(1), "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_a_hash_alone_is_no_name(spark):
    """Where the first 64 bits agree, the check decides."""
    dealt = A.DealtNames(spark.createDataFrame([(["al", "bo"],), (["cy", "di"],)], "w array<string>"))
    bitmap, n_bits, sizes, hashes, checks = dealt.shared.value
    words, bounds = A.string_hashes(A.pa.array(["al", "bo", "cy", "di"])), np.array([0, 4])
    assert A.places(words, bounds, dealt.shared.value)[1].tolist() == [0, 2]
    wrong = checks.copy()
    wrong[hashes == A.gram_hashes(words, np.array([0]), 2)[0]] += 1
    assert A.places(words, bounds, (bitmap, n_bits, sizes, hashes, wrong))[1].tolist() == [2]
