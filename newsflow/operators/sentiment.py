"""Chunk sentiment and the star -> label lookup.

Providers return ``stars`` (1..5) per chunk:

* :class:`LexiconScorer` - word weights compiled into the plan as hashed
  literal sets, one per weight, for lexicons that a plan can hold
  (:class:`LexiconTableScorer` takes a table of any size); tokens are scored inside the
  row with higher-order functions, so there is no explode, no join and no
  shuffle. Integer weights keep the bucket thresholds exact.
* :class:`ModelScorer` - any classifier returning labels like ``'4 stars'``,
  via ``mapInPandas``; the model is loaded once per Python worker.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.functions.dates import bind
from newsflow.operators.tagging import WORD, model_key, worker_model

# --- fixed values: the reference's star-label mapping --------------------------
STAR_LABELS = {
    "1 star": "highly negative",
    "2 stars": "negative",
    "3 stars": "neutral",
    "4 stars": "positive",
    "5 stars": "highly positive",
}
# -----------------------------------------------------------------------------


def star_key(stars: Column) -> Column:
    """1 -> '1 star', n -> 'n stars' (the classifier's label text)."""
    return F.concat(stars.cast("string"), F.when(stars == 1, F.lit(" star")).otherwise(F.lit(" stars")))


def star_label(label: Column) -> Column:
    """Label text -> sentiment word; an unknown label gives null (-> rejects)."""
    m = F.create_map(*[x for k, v in STAR_LABELS.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, label)


def bucket(total: Column, hits: Column) -> Column:
    """Average weight per hit mapped to 1..5 stars; no hit is neutral (3).

    Thresholds at -0.6, -0.2, 0.2, 0.6 of the average, in integer form.
    """
    s5 = total * 5
    return (F.when(hits == 0, F.lit(3))
             .when(s5 < -3 * hits, F.lit(1))
             .when(s5 < -hits, F.lit(2))
             .when(s5 <= hits, F.lit(3))
             .when(s5 <= 3 * hits, F.lit(4))
             .otherwise(F.lit(5)))


class LexiconScorer:
    name = "lexicon"

    def __init__(self, weights: dict[str, int]):
        self.weights = {k.lower(): int(v) for k, v in weights.items()}

    def hits(self, chunk: Column) -> Column:
        """Weights of the lexicon words in the chunk. One hashed set (``isin``
        -> InSet) per distinct weight, so a lookup costs a few hash probes
        whatever the lexicon size (a map literal is scanned linearly)."""
        by_weight: dict[int, list[str]] = {}
        for w, v in sorted(self.weights.items()):
            by_weight.setdefault(v, []).append(w)

        def weight(t):
            out = F.lit(None).cast("bigint")
            for v, words in sorted(by_weight.items(), reverse=True):
                out = F.when(t.isin(words), F.lit(v).cast("bigint")).otherwise(out)
            return out

        toks = F.regexp_extract_all(F.lower(chunk), F.lit(WORD), 0)
        return F.filter(F.transform(toks, weight), lambda w: w.isNotNull())

    def score(self, df: DataFrame, chunk_col: str = "chunk") -> DataFrame:
        """The hit weights are bound once per row (a lambda variable): columns
        derived from them, and filters pushed below, never repeat the
        tokenizer (a generator; the outer form, for which no filter on the
        array is inferred)."""
        def scored(w):
            total = F.aggregate(w, F.lit(0).cast("bigint"), lambda a, x: a + x)
            return bind(F.size(w).cast("bigint"),
                        lambda n: F.struct(n.alias("hits"), bucket(total, n).cast("bigint").alias("stars")))
        rows = df.withColumn("_s", F.array(bind(self.hits(F.col(chunk_col)), scored)))
        return rows.select(*df.columns, F.inline_outer("_s"))


class LexiconTableScorer:
    """The lexicon scorer for a weight table of any size (``word``,
    ``weight`` integer): chunk tokens are exploded (carrying only the chunk
    key), joined to the table (Spark broadcasts it if its statistics allow),
    summed per chunk by a partial aggregation and joined back on the key."""

    name = "lexicon-table"

    def __init__(self, lexicon: DataFrame, key_cols: list[str]):
        self.lexicon = lexicon.select(F.lower("word").alias("_w"), F.col("weight").cast("bigint").alias("_v"))
        self.key_cols = list(key_cols)

    def score(self, df: DataFrame, chunk_col: str = "chunk") -> DataFrame:
        keys = self.key_cols
        toks = df.select(*keys, F.explode(F.regexp_extract_all(F.lower(chunk_col), F.lit(WORD), 0)).alias("_w"))
        agg = toks.join(self.lexicon, "_w").groupBy(*keys).agg(F.sum("_v").alias("_s"), F.count(F.lit(1)).alias("_n"))
        out = df.join(agg, keys, "left")
        hits = F.coalesce(F.col("_n"), F.lit(0)).cast("bigint")
        return (out.withColumn("hits", hits)
                   .withColumn("stars", bucket(F.coalesce(F.col("_s"), F.lit(0)), F.col("hits")).cast("bigint"))
                   .drop("_s", "_n"))


def _stars(label) -> int:
    """'4 stars' -> 4; any other text -> 0, which has no sentiment word."""
    m = re.fullmatch(r"([1-5]) stars?", str(label))
    return int(m[1]) if m else 0


class ModelScorer:
    """``load()`` returns ``list[str] -> list[str]`` of labels such as '4 stars'."""

    name = "model"

    def __init__(self, load: Callable[[], Callable[[list[str]], list[str]]]):
        self.load = load

    def score(self, df: DataFrame, chunk_col: str = "chunk") -> DataFrame:
        load, key = self.load, model_key(self.load)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            fn = worker_model(key, load)
            for b in batches:
                labels = fn([c or "" for c in b[chunk_col]])
                b = b.copy()
                b["stars"] = [_stars(x) for x in labels]
                b["hits"] = -1
                yield b

        schema = T.StructType(list(df.schema.fields) + [T.StructField("stars", T.LongType()),
                                                        T.StructField("hits", T.LongType())])
        return df.mapInPandas(run, schema)


def add_sentiment(df: DataFrame, scorer, chunk_col: str = "chunk") -> DataFrame:
    """N4 + N5: adds ``stars`` and ``sentiment`` (label text)."""
    return scorer.score(df, chunk_col).withColumn("sentiment", star_label(star_key(F.col("stars"))))
