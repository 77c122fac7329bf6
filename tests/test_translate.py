from pyspark.sql import functions as F

from newsflow.operators import translate as TR


def _provider():
    def run(texts, lang):
        return [None if "fail" in t else f"EN[{lang}]({t})" for t in texts]
    return run


def test_memory_hits_misses_and_provider(spark, tmp_out):
    docs = spark.createDataFrame([(1, "fr", "bonjour"), (2, "fr", "bonjour"), (3, "ar", "salam"),
                                  (4, "en", "hello"), (5, "fr", "fail here")], "id int, lang string, text string")
    tm = spark.createDataFrame([], TR.TM_SCHEMA).unionByName(
        docs.filter("id = 1").select(TR.tm_key(F.col("lang"), F.col("text")).alias("key"),
                                     F.lit("good morning").alias("text_en")))
    misses = TR.memory_misses(docs, tm, "text", "lang").collect()
    assert sorted((m["lang"], m["n_rows"]) for m in misses) == [("ar", 1), ("fr", 1)]
    tm.write.parquet(tmp_out)
    ok, rejects = TR.translate_with_memory(docs, spark.read.parquet(tmp_out), "text", "lang",
                                           load=_provider, tm_path=tmp_out)
    got = {r["id"]: r["text_en"] for r in ok.collect()}
    assert got == {1: "good morning", 2: "good morning", 3: "EN[ar](salam)", 4: "hello"}
    assert [r["id"] for r in rejects.collect()] == [5]
    assert spark.read.parquet(tmp_out).count() == 2          # memory grew by the new translation


def test_salted_memory_join_equals_plain(spark):
    from tests.conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang")
    # one text copied 3000 times: a key holding most of the rows
    hot = spark.range(3000).select((F.col("id") + 10**6).alias("doc_id"), F.lit("même texte").alias("text"),
                                   F.lit("fr").alias("lang"))
    d = docs.unionByName(hot)
    tm = d.filter("lang <> 'en'").select(TR.tm_key(F.col("lang"), F.col("text")).alias("key"),
                                         F.upper("text").alias("text_en")).dropDuplicates(["key"])
    plain = TR.apply_memory(d, tm, "text", "lang")
    salted = TR.apply_memory(d, tm, "text", "lang", hot_rows=100)
    assert salted.count() == d.count()
    assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0
    from newsflow.operators.skew import hot_keys
    keyed = d.select(TR.tm_key(F.col("lang"), F.col("text")).alias("k"))
    assert [r["_salts"] for r in hot_keys(keyed, "k", 100).collect()] == [30]


def test_salted_join_with_several_hot_keys(spark):
    from newsflow.operators.skew import salted_left_join
    left = spark.range(4000).select((F.col("id") % 3).alias("k"), F.col("id"))     # three hot keys
    right = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "k long, v string")
    plain = left.join(right, "k", "left")
    capped = salted_left_join(left, right, "k", hot_rows=100)
    assert capped.count() == 4000
    assert plain.exceptAll(capped).count() == 0 and capped.exceptAll(plain).count() == 0


def _mark():
    return lambda texts, lang: [None if t == "fails" else f"{lang}:{t}" for t in texts]


def test_given_memory_and_written_rows_are_both_used(spark, tmp_out):
    df = spark.createDataFrame([(1, "a", "fr"), (2, "b", "fr"), (3, "c", "en"), (4, "fails", "fr"), (5, "b", "fr"), (6, "x", None)],
                               "id int, t string, lang string")
    key = [r[0] for r in spark.range(1).select(TR.tm_key(F.lit("fr"), F.lit("a"))).collect()][0]
    tm = spark.createDataFrame([(key, "known"), (key, "known"), (None, "n")], TR.TM_SCHEMA)      # a repeated key
    ok, rejects = TR.translate_with_memory(df, tm, "t", "lang", _mark, tmp_out)
    assert {r["id"]: r["text_en"] for r in ok.collect()} == {1: "known", 2: "fr:b", 3: "c", 5: "fr:b"} and ok.count() == 4
    assert sorted(r["id"] for r in rejects.collect()) == [4, 6]
    assert spark.read.parquet(tmp_out).count() == 1


def test_no_null_key_and_no_text_in_the_anti_join(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(old, ("-1", "false")):
            spark.conf.set(k, v)
        df = spark.range(1000).select("id", F.lit("t").alias("t"), F.when(F.col("id") % 3 > 0, "en").otherwise("fr").alias("lang"))
        tm = spark.createDataFrame([("k", "x")], TR.TM_SCHEMA)
        plan = TR.apply_memory(df, tm, "t", "lang")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Union" in plan
        misses = TR.memory_misses(df, tm, "t", "lang")._jdf.queryExecution().executedPlan().toString()
        anti = misses[misses.index("LeftAnti"):]
        assert "partial_count" in anti                       # distinct keys come first
        sizes = [len(p) for p in TR.apply_memory(df, tm, "t", "lang").rdd.glom().collect()]
        assert sum(sizes) == 1000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
