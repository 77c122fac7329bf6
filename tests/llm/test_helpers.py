"""Brute-force checks of the parts that SQL cannot express."""
import math
import random
import time

import numpy as np
import pytest

from newsflow.llm import decontaminate, html_blocks, labels, licenses, minhash, mixing, quality_classifier, quality_rules, toxicity


def brute_repeats(words):
    seen, hit = {}, set()
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            hit.update(i + k for i in at for k in range(5))
    return len(hit)


def test_repeated_words():
    draw = random.Random(1)
    for n in (0, 4, 5, 6, 30, 300):
        for letters in ("ab", "abc", "abcdefgh"):
            words = [draw.choice(letters).encode() for _ in range(n)]
            assert quality_rules.repeated_words(words) == brute_repeats(words)


def test_measures():
    assert quality_rules.measure_text("a  b\x0bc é\n#1\n\n#1\n x") == (7, 9, 2, 1, 0)
    assert quality_rules.measure_text("a\u00a0b") == (1, 3, 0, 0, 0)      # no-break space is part of a word


def test_flight_keeps_totals():
    draws = np.random.default_rng(5)
    for n in (0, 1, 2, 3, 50, 400):
        size = np.sort(draws.integers(0, 4000, n))[::-1].copy()
        p = draws.random(n)
        end = mixing.flight(size, p, np.random.default_rng(1), land=False)
        open_ = (end > 0) & (end < 1)
        assert open_.sum() <= mixing.LEFT
        if n > 10:
            assert math.isclose(end.sum(), p.sum(), abs_tol=1e-6) and math.isclose(end @ size, p @ size, abs_tol=1e-3)
        landed = mixing.flight(size, p, np.random.default_rng(1), land=True)
        assert set(landed.tolist()) <= {0.0, 1.0}
        if n >= 50:
            assert abs(landed @ size - p @ size) <= max(60, 0.05 * (p @ size))


def test_flight_has_the_right_inclusion_rates():
    size = np.array([900, 500, 400, 300, 120, 80, 40, 10, 5, 3])
    p = np.array([.3, .5, .7, .2, .6, .4, .5, .5, .8, .1])
    mean = np.mean([mixing.flight(size, p, np.random.default_rng(s), land=True) for s in range(4000)], axis=0)
    assert np.abs(mean - p).max() < 0.04


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = {s: w for s, w in weight.items() if s not in full}
        share = total - sum(full.values())
        got = {s: share * w / sum(rest.values()) for s, w in rest.items()}
        over = [s for s, t in got.items() if t > 3 * sizes[s]]
        if not over:
            return {**full, **got}
        full.update({s: 3 * sizes[s] for s in over})


def test_targets(spark):
    draw = random.Random(3)
    for n in (1, 2, 7, 30):
        sizes = {f"s{draw.random()}": draw.choice([0, 1, 5, 100, 1000, 20000]) for _ in range(n)} | {None: 50, "é": 3}
        df = spark.createDataFrame([(s, v) for s, v in sizes.items()], "source string, size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
        want = brute_targets(sizes)
        assert all(math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-9) for s in sizes)


def test_mix_meets_targets_and_reruns_agree(spark):
    from newsflow.llm.common import table
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    a = sorted(map(tuple, mixing.mix(docs).collect()))
    assert a == sorted(map(tuple, mixing.mix(docs.repartition(5)).collect()))
    cols = ("id", "text_hash", "source", "size", "source_size", "target", "repeats")
    taken, target = {}, {}
    for r in (dict(zip(cols, x, strict=True)) for x in a):
        taken[r["source"]] = taken.get(r["source"], 0) + r["repeats"] * r["size"]
        target[r["source"]] = r["target"]
        assert 0 <= r["repeats"] <= 3
    assert all(abs(taken[s] - target[s]) < 0.03 * target[s] for s in target)


def test_small_blocks_agree_with_targets(spark):
    from newsflow.llm.common import table
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = mixing.mix(docs, block=20).collect()     # two levels
    taken, target = {}, {}
    for r in rows:
        taken[r["source"]] = taken.get(r["source"], 0) + r["repeats"] * r["size"]
        target[r["source"]] = r["target"]
    assert len(rows) == 1000 and all(abs(taken[s] - target[s]) < 0.2 * target[s] for s in target)


def near_texts(n=60, seed=2):
    draw, texts = random.Random(seed), []
    words = [f"w{i}" for i in range(4000)]
    for _ in range(n):
        if texts and draw.random() < 0.7:
            w = draw.choice(texts).split()
            for _ in range(draw.choice([0, 1, 2, 4, 8])):
                w[draw.randrange(len(w))] = draw.choice(words)
        else:
            w = [draw.choice(words) for _ in range(draw.choice([3, 12, 80, 200]))]
        texts.append(" ".join(w))
    return texts


def brute_components(texts):
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    up = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    up[i] = up[j] = min(up[i], up[j])
    return up, [len(s) for s in sets]


def test_minhash_components(spark):
    texts = near_texts(90)
    df = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r["id"]: (r["component"] - 100, r["n_shingles"]) for r in minhash.near_duplicates(df).collect()}
    up, n = brute_components(texts)
    assert [got[100 + i] for i in range(len(texts))] == list(zip(up, n, strict=True))


def test_cells_find_every_link():
    texts = near_texts(80, 5)
    sets = [minhash.shingles(t) for t in texts]
    import pandas as pd
    cell = pd.DataFrame({"node": range(len(texts)), "label": range(len(texts)), "shingles": [s.tobytes() for s in sets]})
    up = minhash.Forest(len(texts))
    for a, b in minhash._confirm_cell(cell).itertuples(index=False):
        up.join(a, b)
    assert [up.find(i) for i in range(len(texts))] == brute_components(texts)[0]


def test_estimates_are_close_and_cut_nothing():
    texts = near_texts(60, 9)
    sets = [minhash.shingles(t) for t in texts]
    sig = minhash.packed(minhash.minima(sets)).view(np.uint64)
    error = []
    for i in range(len(texts)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            s = both / (len(sets[i]) + len(sets[j]) - both)
            d = sig[i] ^ sig[j]
            far = int(np.bitwise_count((d | (d >> np.uint64(1))) & np.uint64(minhash._LANES)).sum())
            estimate = 1 - far / minhash.HASHES / (1 - 2.0 ** -minhash.BITS)
            error.append(estimate - s)
            assert s < 0.75 or far <= minhash.MAX_DIFFERENT
    assert abs(np.mean(error)) < 0.02 and np.std(error) < 0.08


def test_cells_bring_all_pairs_together(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(31)], "node long, grp long")
    cells = {}
    for r in minhash.in_cells(df, "grp", cell=4).collect():
        cells.setdefault(r["cell"], set()).add(r["node"])
    met = {(a, b) for c in cells.values() for a in c for b in c}
    assert all((a, b) in met for a in range(31) for b in range(31) if a % 2 == b % 2)


def test_connected(spark):
    from newsflow.llm.components import connected
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 50), (50, 70), (7, 7)]
    got = dict(map(tuple, connected(spark.createDataFrame(links, "x long, y long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, 100: 50, 50: 50, 70: 50}


def brute_hits(text, items):
    words = [w.decode() for w in decontaminate.words_of(text)]
    hit, found = set(), set()
    for item, t in items:
        for w in decontaminate.item_windows(decontaminate.words_of(t)):
            w = [x.decode() for x in w]
            for i in range(len(words) - len(w) + 1):
                if words[i:i + len(w)] == w:
                    hit.update(range(i, i + len(w)))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("slice_", [4_000_000, 5])
def test_decontamination(spark, monkeypatch, slice_):
    monkeypatch.setattr(decontaminate, "SLICE", slice_)
    draw = random.Random(4)
    text = lambda n, k=4: " ".join(draw.choice("abcdefghij"[:k]) for _ in range(n))
    items = [(1, text(14)), (2, text(3)), (3, "A b, a"), (4, text(10)), (5, ""), (6, text(30, 10))]
    docs = [(i, text(draw.choice([0, 2, 9, 60]))) for i in range(25)] + [(90, "x " + items[5][1] + " y"), (91, items[0][1].upper())]
    got = decontaminate.contaminated_words(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r["id"]: (r["n_words"], r["n_hit"], r["items"]) for r in got.collect()} == {i: brute_hits(t, items) for i, t in docs}


def test_block_max_search_is_exact():
    draws = np.random.default_rng(8)
    vectors = []
    for _ in range(400):
        t = draws.choice(40, draws.integers(1, 8), replace=False)
        w = draws.random(len(t)) ** 3
        vectors.append({int(a): float(b) for a, b in zip(t, w / np.linalg.norm(w), strict=True)})
    index = toxicity.BlockMaxIndex(vectors, 40, block=16)
    for q in vectors[:60]:
        all_ = sorted((-sum(w * v.get(t, 0.0) for t, w in q.items()), i) for i, v in enumerate(vectors))
        want = [(-s, i) for s, i in all_[:7] if s < 0]
        got = index.search(q, 7)
        assert np.allclose([s for s, _ in got], [s for s, _ in want]) and len(got) == len(want)


@pytest.mark.parametrize("dense", [5, 2048])
def test_dense_and_rare_terms_together_are_exact(monkeypatch, dense):
    monkeypatch.setattr(toxicity, "DENSE", dense)
    draws = np.random.default_rng(9)
    share = 1 / np.arange(1, 301)
    vectors = []
    for i in range(500):
        t = np.sort(draws.choice(300, draws.integers(1, 30), replace=False, p=share / share.sum()))
        w = draws.random(len(t)) ** 2 + 0.01
        vectors.append({int(a): float(b) for a, b in zip(t, (w / np.linalg.norm(w)).astype(np.float32), strict=True)})
    vectors[100:110] = [vectors[7]] * 10      # equal examples tie
    index = toxicity.BlockMaxIndex(vectors, 300, block=32)
    asked = [5, 7, *range(100, 160)]
    pairs = [(np.array(list(vectors[i])), np.array(list(vectors[i].values()), float)) for i in asked]
    for i, got in zip(asked, index.search_many(pairs, 6, asked), strict=True):
        all_ = sorted((-sum(w * v.get(t, 0.0) for t, w in vectors[i].items()), e) for e, v in enumerate(vectors) if e != i)
        assert np.allclose([s for s, _ in got], [-s for s, _ in all_[:6] if s < 0], atol=1e-12)
        assert {e for _, e in got} <= {e for s, e in all_ if -s >= got[-1][0] - 1e-9} and got == sorted(got, key=lambda x: (-x[0], x[1]))
    alike = [7, *range(100, 110)]
    assert [e for _, e in index.search(vectors[7], 11)] == alike


def test_terms_are_hashed_together(monkeypatch):
    from collections import Counter

    import xxhash
    from newsflow.llm.decontaminate import words_of
    texts = ["", None, " \n\t ", "ab abcd abcde abcdef ABCDEF abcd1", "İx Über straße naïveté 中文字符 中文字符很 中文字符很多", "x" * 31 + " " + "y" * 32 + ", " + "é" * 40, "q " * 5,
             " ".join("w" * i + " " + "é" * i for i in range(1, 32)), " ".join(f"word{i % 700}" for i in range(3000))]
    monkeypatch.setattr(toxicity, "TOGETHER", 300)
    want = []
    for text in texts:
        bag = Counter()
        for word in words_of((text or "").lower()):
            letters = word.decode()
            bag.update([word, *(letters[:k].encode() + b"*" for k in toxicity.STEMS if len(letters) > k)])
        want.append(sorted((xxhash.xxh64_intdigest(t), n) for t, n in bag.items()))
    one_by_one = []
    monkeypatch.setattr(toxicity.xxhash, "xxh64_intdigest", lambda w, plain=xxhash.xxh64_intdigest: one_by_one.append(w) or plain(w))
    got = [list(zip(t.tolist(), n.tolist(), strict=True)) for t, n in toxicity.counted(texts)]
    assert got == want
    assert all(len(w) >= toxicity.WIDTH for w in one_by_one)      # only long words one by one
    some = np.unique(np.array([h for bag in want for h, _ in bag[::2]], np.uint64))
    known = set(some.tolist())
    got = [[(int(some[t]), n) for t, n in zip(*pair, strict=True)] for pair in toxicity.counted(texts, some)]
    assert got == [[(h, n) for h, n in bag if h in known] for bag in want]
    assert [len(t) for t, _ in toxicity.counted(texts, some[:0])] == [0] * len(texts)


def test_copies_of_toxic_texts_are_found_by_all_their_words(spark):
    draw = random.Random(7)
    text = lambda: " ".join(f"w{draw.randrange(3000)}" for _ in range(40))
    docs = [(i, text()) for i in range(200)]
    rows = [(i, int(i % 8 == 0)) for i in range(200)]
    train = [i for i, y in rows if y and __import__("zlib").crc32(str(i).encode()) % 5]
    copies = {1000 + i: i for i in train[:5]}
    docs += [(c, dict(docs)[i] + " tail") for c, i in copies.items()]
    got = {r["id"]: r for r in toxicity.score_documents(spark.createDataFrame(docs, "doc_id long, text string"),
                                                        spark.createDataFrame(rows, "doc_id long, toxic int")).collect()}
    assert all(got[c]["evidence"][0] == str(i) for c, i in copies.items())
    assert all(len(r["evidence"]) == toxicity.EVIDENCE for r in got.values())


def test_isotonic():
    draws = np.random.default_rng(3)
    v, y = draws.random(200), draws.integers(0, 2, 200)
    f = labels.Isotonic(v, y, np.ones(200))
    out = f(np.sort(v))
    assert (np.diff(out) >= -1e-12).all() and 0 <= out.min() and out.max() <= 1
    assert labels.Isotonic([0.2, 0.4], [0, 1], [1, 1]).y.tolist() == [0.0, 1.0]


def test_random_features_approximate_the_kernel():
    m = quality_classifier.Model(np.zeros(quality_classifier.STATISTICS), np.ones(quality_classifier.STATISTICS))
    x = np.random.default_rng(1).normal(size=(40, quality_classifier.STATISTICS))
    z = m.features(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * quality_classifier.WIDTH ** 2))
    assert np.abs(z @ z.T - exact).mean() < 0.06


def test_ridge_sums_equal_direct_fit(spark):
    draws = np.random.default_rng(6)
    rows = [(draws.normal(size=quality_classifier.STATISTICS).tolist(), int(i % 3 > 0), 1 + i % 4) for i in range(80)]
    model = quality_classifier.fit(spark.createDataFrame(rows, "x array<double>, y int, fold int").repartition(3))
    z, y = model.features(np.array([r[0] for r in rows])), np.array([r[1] for r in rows])
    ridge = np.full(z.shape[1], quality_classifier.RIDGE * len(rows))
    ridge[-1] = 1e-9
    assert np.allclose(np.linalg.solve(z.T @ z + np.diag(ridge), z.T @ y), model.weights[0], atol=1e-6)


@pytest.mark.parametrize("query,label,least", [("op7_quality_classifier", "quality", 0.97), ("op5_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, query, label, least):
    from newsflow.llm.common import table
    from newsflow.llm.queries import QUERIES
    scored = QUERIES[query](spark, "/root/testdata/sf0.01")
    rows = scored.join(table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r[label] for r in rows) >= least * len(rows) and len(rows) > 50
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_labels_of_the_held_out_fold_are_never_used(spark):
    rows = [(i, i % 2) for i in range(100)] + [(None, 1), (3, None)]
    got = {r["lid"] for r in labels.training_labels(spark.createDataFrame(rows, "doc_id long, toxic int"), "toxic").collect()}
    from zlib import crc32
    assert got == {i for i in range(100) if crc32(str(i).encode()) % 5}


def test_html_time_is_linear():
    for html in ("<p>ok</p><a " + "n" * 200_000, "<a href=\"http" * 20_000, "<" * 100_000, "<p" * 50_000, "&am" * 100_000, "<div>" * 50_000 + "x", "<!--" * 50_000,
                 "<a b='" * 50_000 + ">", "<p " * 50_000 + ">", "<a \"" * 50_000 + "'>"):
        t = time.time()
        html_blocks.main_text(html)
        assert time.time() - t < 10


def test_html_furniture_goes():
    html = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li><a href=/>A</a></li></ul></nav>
    <div class="cookie-notice">Long notice text that says a lot about cookies and other things on this page.</div>
    <article><h1>Head</h1><p>a&nbsp;b  &lt;c&gt;<br>d</p><script>x()</script><p>Ok.</p><div class="ad">Buy now</div></article>
    <aside>Side</aside><div id="comments"><p>A reader wrote this quite long comment on the article above, and liked it.</p></div><form>Mail <input></form><footer>F</footer>"""
    assert html_blocks.main_text(html) == "Head\na b <c> d\nOk."


def test_tree_separates_its_table():
    x, y = html_blocks.labelled_table()
    assert (html_blocks.classify(x, html_blocks.tree()) == y).mean() > 0.98


def test_licence_scores_match_python(spark):
    weights, bias = licenses.trained()
    texts = ["Licensed under the Apache License, Version 2.0.\nfoo", "We asked for permission to go.", "Copyright 2001 X. All rights reserved.",
             "GNU GENERAL PUBLIC LICENSE version 3", "licence", "strange license of nobody knows what kind at all", "Released under the MIT License.", "All rights\nreserved"]
    got = licenses.scan(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    for r in got:
        want = []
        for i, p in enumerate(r["text"].lower().split("\n")):
            if __import__("re").search(licenses.ANCHORS, p):
                w = licenses.words_of(p)
                z = np.array(bias) + sum((np.array(weights[g]) for g in licenses.grams_of(w) if g in weights), np.zeros(len(bias)))
                prob = 1 / np.exp(z - z.max()).sum()
                f = licenses.FAMILIES[z.argmax()]
                sim = max([len(set(t) & set(licenses.pairs_of(w))) / len(t) for t in licenses.templates().get(f, [])], default=0.0)
                if f != licenses.NONE:
                    want.append((i, f if prob >= licenses.MIN_PROBABILITY else "unknown", round(prob, 6), round(sim, 6)))
        assert [(x["paragraph"], x["family"], round(x["probability"], 6), round(x["similarity"], 6)) for x in r["licences"]] == want
    assert [x["family"] for r in got for x in r["licences"] if x["confirmed"]][:2] == ["apache", "reserved"]


def test_notices_without_the_word_licence_are_found(spark):
    want = {"CC BY-SA 4.0": "creative-commons", "GNU GPL v3": "gpl", "Distributed under GPLv2 or later": "gpl", "Apache-2.0": "apache",
            "BSD 3-Clause": "bsd", "Dedicated under CC0 1.0": "public-domain", "MPL 2.0": "mozilla", "MIT License": "mit"}
    got = licenses.scan(spark.createDataFrame([(t,) for t in want], "text string")).collect()
    assert {r["text"]: [x["family"] for x in r["licences"]] for r in got} == {t: [f] for t, f in want.items()}
    prose = ["Er kam mit dem Rad und ging mit ihr unter die Brücke", "It is or has been under this", "The following day"]
    assert all(not r["licences"] for r in licenses.scan(spark.createDataFrame([(t,) for t in prose], "text string")).collect())


def test_no_paragraph_without_an_anchor_could_be_a_finding():
    weights, bias = licenses.trained()
    draw, grams = random.Random(3), sorted(weights)
    for _ in range(3000):
        p = " ".join(draw.choice([*grams, "word", "é"]) for _ in range(draw.randrange(6)))
        z = np.array(bias) + sum((np.array(weights[g]) for g in licenses.grams_of(licenses.words_of(p)) if g in weights), np.zeros(len(bias)))
        assert __import__("re").search(licenses.ANCHORS, p) or licenses.FAMILIES[z.argmax()] == licenses.NONE


def test_bloom_filter_has_no_false_negatives_and_few_positives(spark):
    from pyspark.sql import functions as F
    from newsflow.llm import url_filter
    keys = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"))
    blocks = 512
    bloom = url_filter.bloom_blocks(keys, blocks)
    assert url_filter.passing(keys, bloom, blocks).count() == 2000
    others = spark.range(2000, 22000).select(F.concat(F.lit("k"), "id").alias("key"))
    assert url_filter.passing(others, bloom, blocks).count() < 600


def test_url_rules_match_brute_force(spark):
    from newsflow.llm import queries, url_filter
    urls = [f"{s}{h}{p}" for s in ("http://", "HTTPS://", "") for h in ("net", "Example.NET", "a.example.net", "xexample.net", "example.com", "org", "b.org", "net.org", "example.net.")
            for p in ("", "/", "/en/", "/en", "/en/x?/de/", "/de/#y", "?/en/", "#/", "/fr/", "/EN/")]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id int, url string")
    got = {r["url"]: r["filter"] for r in url_filter.judge(df, queries.URL_RULES, spark.createDataFrame([("b.org/en",)], "c string")).collect()}
    for u in urls:
        host, path = "", ""
        if "://" in u:
            rest = u.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host, rest = rest[:cut].lower(), rest[cut:]
            path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
        fits = [(len(h + p), len(h), h + p, v) for v, h, p in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits)[2:] if fits else (None, "block" if f"{host}{path.rstrip('/')}" == "b.org/en" else "allow")
        assert (got[u]["host"], got[u]["path"], got[u]["rule"], got[u]["verdict"]) == (host, path, rule, verdict), u


def test_token_counts_match_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    from newsflow.llm import token_counts
    from newsflow.llm.queries import TOKENIZER
    path = public_tokenizers.path(TOKENIZER)
    tok = Tokenizer.from_file(path)
    odd = ["", "It's we'LL 'tis ..'t a''s", "<|endoftext|> x <|startoftext|>", "İSTANBUL Σίσυφος ΑΣ", "e\u0301 \u0301a ½²3४", "a\u00a0b\x1cc\x85d\u2003e", "中文字 한국어 عربى", "x" * 5000, "1234 5.6", "ÉÈ ß ſ", "\u0000 a", "👍🏽"]
    rows = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()] + odd + [None]
    df = spark.createDataFrame([(t,) for t in rows], "text string")
    for r in token_counts.count_tokens(df, path).collect():
        t = r["text"] or ""
        assert (r["tokens"]["n_tokens"], r["tokens"]["n_bytes"]) == (len(tok.encode(t, add_special_tokens=False).ids), len(t.encode()))
    empty_table = token_counts.count_tokens(df, path, table={}).collect()
    assert sum(r["tokens"]["n_tokens"] for r in empty_table) == sum(len(tok.encode(t or "", add_special_tokens=False).ids) for t in rows)


def test_own_header_names_are_no_furniture():
    html = """<div class="site-header">Paper</div><div class="content no-sidebar"><div class="entry-header"><h2>Head of it</h2></div>
    <p>The story goes on for a while and then it ends.</p></div><div class="left-sidebar">Links of the week and of all the weeks before</div>"""
    assert html_blocks.main_text(html) == "Head of it\nThe story goes on for a while and then it ends."
