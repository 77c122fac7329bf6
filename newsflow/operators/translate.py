"""Translation through a translation memory.

The reference calls a remote translator once per article. Here a
translation memory table ``tm(key, text_en)`` is joined to the articles;
``key = sha2(lang || U+0001 || text, 256)``. Only keys missing from the
memory are translated, each distinct key once, by a provider running in
``mapInPandas``; the results are appended to the memory. English passes
through unchanged. A text still without translation is rejected (the
reference drops the article when translation fails).

Scale notes: English rows go around the join, so no NULL key gathers them in
one partition. A key is unique in the memory (repeats are collapsed on read),
so Spark may broadcast it, and adaptive execution can split hot article keys;
with ``hot_rows`` an explicit salted join spreads them
(``skew.salted_left_join``). Misses are found on keys alone: distinct keys
(partial aggregation), anti-join of keys with keys, and only then the texts of
the missing keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.operators.skew import salted_left_join
from newsflow.operators.tagging import model_key, worker_model
from newsflow.session import materialize

TARGET = "en"
TM_SCHEMA = T.StructType([T.StructField("key", T.StringType()), T.StructField("text_en", T.StringType())])


def tm_key(lang: Column, text: Column) -> Column:
    return F.sha2(F.concat(lang, F.lit("\u0001"), text), 256)


def unique_memory(tm: DataFrame) -> DataFrame:
    """One row for each key that has a translation (the smallest text of
    several), whatever was appended."""
    return tm.where(F.col("key").isNotNull() & F.col("text_en").isNotNull()).groupBy("key").agg(F.min("text_en").alias("text_en"))


def _needs_memory(lang: Column) -> Column:
    """Rows that are not known to be English (a NULL language included)."""
    return ~F.coalesce(lang == TARGET, F.lit(False))


def apply_memory(df: DataFrame, tm: DataFrame, text_col: str, lang_col: str,
                 out_col: str = "text_en", hot_rows: int | None = None) -> DataFrame:
    """Adds ``out_col`` (NULL = not in memory) and ``from_memory``.

    ``hot_rows``: keys with more rows than this (copies of one text) are
    spread over salt buckets (``skew.salted_left_join``); otherwise AQE's
    skew-join split handles hot partitions at run time.
    """
    foreign = _needs_memory(F.col(lang_col))
    keyed = df.where(foreign).withColumn("_tm_key", tm_key(F.col(lang_col), F.col(text_col)))
    side = unique_memory(tm).select(F.col("key").alias("_tm_key"), F.col("text_en").alias("_tm_text"))
    if hot_rows is not None:
        j = salted_left_join(keyed, side, "_tm_key", hot_rows)
    else:
        j = keyed.join(side, "_tm_key", "left")
    joined = j.withColumn(out_col, F.col("_tm_text")).withColumn("from_memory", F.col("_tm_text").isNotNull()).drop("_tm_key", "_tm_text")
    english = df.where(~foreign).withColumn(out_col, F.col(text_col)).withColumn("from_memory", F.lit(False))
    return english.unionByName(joined)


def memory_misses(df: DataFrame, tm: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """Distinct (key, lang, text) not yet in the memory, with how many rows
    need it. Keys are counted first (partial aggregation), cut to the missing
    ones against the memory's keys, and the texts join only those. Rows without
    a language or a text have no key and are no misses."""
    rows = df.where(F.col(lang_col) != TARGET).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("text is not null")
    key = tm_key(F.col("lang"), F.col("text"))
    counts = rows.select(key.alias("key")).groupBy("key").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
    known = tm.where("text_en is not null").select("key")
    missing = counts.join(known, "key", "left_anti")
    texts = rows.withColumn("key", key).join(missing, "key")
    return texts.groupBy("key").agg(F.first("lang").alias("lang"), F.first("text").alias("text"), F.first("n_rows").alias("n_rows"))


def translate_misses(misses: DataFrame, load: Callable[[], Callable[[list[str], str], list[str | None]]]
                     ) -> DataFrame:
    """Provider step: ``load()`` (once per worker) returns ``(texts, src_lang) -> texts``.
    Returns new memory rows; failed translations come back as NULL text_en."""
    key = model_key(load)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = worker_model(key, load)
        for b in batches:
            out = []
            for lang, grp in b.groupby("lang", sort=False):
                res = fn(list(grp["text"]), lang)
                out.append(pd.DataFrame({"key": grp["key"].values, "text_en": res}))
            yield pd.concat(out) if out else pd.DataFrame({"key": [], "text_en": []})

    return misses.select("key", "lang", "text").mapInPandas(run, TM_SCHEMA)


def translate_with_memory(df: DataFrame, tm: DataFrame, text_col: str, lang_col: str, load=None,
                          tm_path: str | None = None, hot_rows: int | None = None):
    """Full N7 step -> (translated rows, rejects). With a provider the misses
    are translated once, written (appended to ``tm_path`` if given, else to the
    shared folder) and joined together with the given memory, so both outputs
    read the same translations."""
    if load is not None:
        spark = df.sparkSession
        new = materialize(translate_misses(memory_misses(df, tm, text_col, lang_col), load).where("text_en is not null"), "translations")
        if tm_path:
            new.write.mode("append").parquet(tm_path)
            new = spark.read.schema(TM_SCHEMA).parquet(tm_path)
        tm = tm.select("key", "text_en").unionByName(new)
    out = apply_memory(df, tm, text_col, lang_col, hot_rows=hot_rows)
    rejects = out.filter(F.col("text_en").isNull()).withColumn("reject_reason", F.lit("translation failed"))
    return out.filter(F.col("text_en").isNotNull()), rejects
