"""Salted equi-join for hot keys.

Used where one key can hold a large share of the rows on the streamed side
(e.g. exact copies of one text in the translation-memory join). The right
side must be unique per key.

1. Key counts on the left by a partial aggregation (hot keys cost one
   partial row per task, no skew in this step).
2. Every key above ``hot_rows`` gets ``ceil(count / hot_rows)`` salt buckets,
   as many as it needs. There are at most (rows / hot_rows) such keys; Spark
   picks the joins with this table by its size.
3. Left rows of a hot key get a salt from a hash of ``spread_col``; right
   rows of a hot key are replicated once per salt. Join on (key, salt).

Spark's AQE skew-join split does the same at run time when a shuffle
partition is found skewed; this makes it explicit and independent of the
partition-size thresholds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(left: DataFrame, key: str, hot_rows: int) -> DataFrame:
    counts = left.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > hot_rows).select(key, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts"))


def salted_left_join(left: DataFrame, right: DataFrame, key: str, hot_rows: int,
                     spread_col: str | None = None) -> DataFrame:
    """``left`` LEFT JOIN ``right`` USING (key), with hot keys spread over salts.

    The salt of a left row only chooses which replica of its right row it
    meets, so any value is correct; without ``spread_col`` a random one is
    used (a retried task may pick other salts and still gets the same rows).
    """
    hot = hot_keys(left, key, hot_rows)
    spread = (F.pmod(F.xxhash64(F.col(spread_col)), F.col("_salts")) if spread_col
              else F.floor(F.rand() * F.col("_salts")))
    l = (left.join(hot, key, "left")
             .withColumn("_salt", F.when(F.col("_salts").isNotNull(), spread).otherwise(F.lit(0)).cast("int"))
             .drop("_salts"))
    r = (right.join(hot, key, "left")
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
              .drop("_salts"))
    return l.join(r, [key, "_salt"], "left").drop("_salt")
