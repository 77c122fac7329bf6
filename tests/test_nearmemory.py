"""Near matches in the memory against all pairs."""
import random

from pyspark.sql import functions as F

from newsflow.operators import nearmemory as NM
from newsflow.plans import catalog
from tests.conftest import SF_SMALL

ROWS, MEMORY = "id int, lang string, t string", "lang string, text string, text_en string"


def edits(a, b, limit):
    """Edit distance by the whole table's band; above the limit: limit + 1."""
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    far = limit + 1
    row = {j: j for j in range(min(len(b), limit) + 1)}
    for i in range(1, len(a) + 1):
        now = {}
        for j in range(max(0, i - limit), min(len(b), i + limit) + 1):
            now[j] = i if j == 0 else min(row.get(j, far) + 1, now.get(j - 1, far) + 1, row.get(j - 1, far) + (a[i - 1] != b[j - 1]))
        row = now
    return min(row.get(len(b), far), far)


def brute(rows, memory, limit):
    out = {}
    for i, lang, t in rows:
        if lang == "en":
            out[i] = (t, None)
            continue
        near = [(edits(t, m, limit), m, e) for g, m, e in memory if None not in (g, m, e) and g == lang and t is not None]
        best = min((x for x in near if x[0] <= limit), default=None)
        out[i] = (best[2], best[0]) if best else (None, None)
    return out


def test_equals_all_pairs(spark):
    draw = random.Random(6)
    for limit, letters in ((1, "ab"), (2, "abé"), (3, "ab"), (0, "a")):
        def text():
            return "".join(draw.choices(letters, k=draw.randrange(0, 12)))
        memory = [(draw.choice(["fr", "ar"]), t := text(), f"<{t}>") for _ in range(60)] + [(None, "a", "x"), ("fr", None, "x"), ("fr", "aab", None)]
        rows = [(i, draw.choice(["fr", "ar", "de", "en", None]), draw.choice([text(), text(), text(), None])) for i in range(250)]
        rows = [(i, g, t) for i, g, t in rows if not (g == "en" and t is None)]
        df = spark.createDataFrame(rows, ROWS).repartition(3)
        got = {r.id: (r.text_en, r.distance) for r in NM.apply_near_memory(df, spark.createDataFrame(memory, MEMORY), "t", "lang", limit).collect()}
        assert got == brute(rows, memory, limit)


def test_edges(spark):
    long = "é" * 100_000
    memory = spark.createDataFrame([("fr", long, "long"), ("fr", "", "nothing"), ("fr", "bon", "b"), ("fr", "bon", "a")], MEMORY)
    rows = [(1, "fr", long[:50_000] + "x" + long[:50_000]), (2, "fr", "ab"), (3, "fr", "abc"), (4, "fr", "bon"), (4, "fr", "bom"), (4, "fr", "bom"), (5, None, "bon")]
    df = spark.createDataFrame(rows, ROWS).withColumn("near_text", F.lit("clash"))
    got = sorted((r.id, r.text_en, r.distance) for r in NM.apply_near_memory(df, memory, "t", "lang").where("id < 5").collect() if r.id != 3)
    assert got == [(1, "long", 1), (2, "nothing", 2), (4, "a", 0), (4, "a", 1), (4, "a", 1)]
    assert NM.apply_near_memory(df.where("false"), memory, "t", "lang").collect() == []
    assert all(r.text_en is None for r in NM.apply_near_memory(df, memory.where("false"), "t", "lang").collect())


def test_query_equals_all_pairs(spark):
    docs = [(r.doc_id, r.lang, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    seen = {r.doc_id for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    memory = [(g, t, f"[{g}->en] {t}") for i, g, t in docs if i in seen and g != "en"]
    asked = spark.createDataFrame(docs, "doc_id long, lang string, text string").withColumn("text", catalog._retyped(F.col("text")))
    want = brute([(r.doc_id, r.lang, r.text) for r in asked.collect()], memory, NM.DISTANCE)
    got = {r.doc_id: (r.text_en, r.distance) for r in catalog.QUERIES["translate_near"](spark, SF_SMALL).collect()}
    assert got == want and {d for _, d in got.values()} >= {None, 0, 1, 2}
