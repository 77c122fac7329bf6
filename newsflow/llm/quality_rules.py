"""Quality rules with host verdicts.

Every document is measured on its whole text and checked against the base
rules. Rule failures are then aggregated by host, the hosts' failure rates are
shrunk with an empirical beta prior (method of moments over all hosts), and
hosts whose shrunk rate is too high are rejected with all their documents.

Defined results: a null or empty text has no words and fails the base rules;
documents without a host (null) are judged by the base rules only; repeated
rows count and are judged one by one; ties cannot occur (no ranking); empty
tables give empty results; other columns, whatever their names, pass through.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import SPACES, fresh, if_small, window_hashes, word_hashes
from newsflow.session import materialize

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10            # fewer words fail
MAX_REPEAT_PERCENT = 20   # a larger share of words in repeated windows fails
WINDOW = 5
MAX_HOST_RATE = 0.5       # hosts whose shrunk failure rate is above are rejected
PRIOR_STRENGTH = (1.0, 1000.0)   # bounds of alpha + beta, for degenerate variances

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words inside windows that occur at least twice in the text."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    _, inverse, counts = np.unique(window_hashes(word_hashes(words), size), return_inverse=True, return_counts=True)
    if len(counts) == n:
        return 0
    starts = np.flatnonzero(counts[inverse] > 1)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + size, -1)
    return int(np.count_nonzero(np.cumsum(cover)[:-1]))


def measure_text(text: str | None) -> tuple[int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode()
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words))


def _measure(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure_text(t) for t in texts], columns=MEASURES, dtype="int64")


def measure(docs: DataFrame, text: str = "text", out: str = "measures") -> DataFrame:
    """``docs`` with the struct column ``out``: the measures and ``base_failed``."""
    raw = fresh(docs, "_raw")
    m = F.col(raw)
    measured = F.pandas_udf(_measure, ", ".join(f"{c} long" for c in MEASURES))
    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
    return (docs.withColumn(raw, measured(F.col(text)))
            .withColumn(out, F.struct(f"{raw}.*", failed.alias("base_failed"))).drop(raw))


def rate_hosts(measured: DataFrame, host: str = "source", measures: str = "measures",
               max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per host: ``host, docs, failures, rate`` (shrunk) and
    ``rejected``. Two small aggregations with map-side partial sums: by host,
    then one row of moments over the hosts."""
    hosts = materialize(measured.where(F.col(host).isNotNull())
                        .groupBy(F.col(host).alias("host"))
                        .agg(F.count(F.lit(1)).alias("docs"),
                             F.sum(F.col(measures)["base_failed"].cast("long")).alias("failures")), "hosts")
    alpha, beta = beta_prior(hosts)
    rate = (F.col("failures") + F.lit(alpha)) / (F.col("docs") + F.lit(alpha + beta))
    return materialize(hosts.withColumn("rate", rate).withColumn("rejected", F.col("rate") > max_rate), "host_rates")


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """Alpha and beta by moments: the pooled rate, and the variance between
    hosts left after the binomial part of each host's own documents."""
    r = hosts.agg(F.count(F.lit(1)).alias("k"), F.sum("docs").alias("n"), F.sum("failures").alias("f"),
                  F.sum(F.col("docs").cast("double") * F.col("docs")).alias("n2"),
                  F.sum(F.col("failures").cast("double") * F.col("failures") / F.col("docs")).alias("ff")).first()
    lo, hi = PRIOR_STRENGTH
    if not r["k"] or not r["n"]:
        return 0.5 * lo, 0.5 * lo
    n, mean = float(r["n"]), float(r["f"]) / float(r["n"])
    spread = mean * (1 - mean)
    strength = hi
    if r["k"] > 1 and spread > 0:
        # sum n_i (p_i - mean)^2 expects spread * (k - 1) + var * (n - n2 / n) for rates that vary by var + own noise
        ss = float(r["ff"]) - n * mean * mean
        var = (ss - (r["k"] - 1) * spread) / max(n - float(r["n2"]) / n, 1e-9)
        if var > 0:
            strength = spread / var - 1
    strength = min(max(strength, lo), hi)
    mean = min(max(mean, 0.5 / (n + 1)), 1 - 0.5 / (n + 1))
    return mean * strength, (1 - mean) * strength


def judge(measured: DataFrame, hosts: DataFrame, host: str = "source", measures: str = "measures",
          out: str = "quality") -> DataFrame:
    """``measured`` with the struct column ``out``: ``host_rate`` (null without
    a host) and ``kept``. The hosts' table is a written one, so its size is
    known: it is broadcast up to a byte limit, else joined by a shuffle in
    which adaptive execution splits the hot hosts."""
    key, h = fresh(measured, "_host"), fresh(measured, "_rate")
    side = hosts.select(F.col("host").alias(key), F.struct("rate", "rejected").alias(h))
    kept = ~F.col(measures)["base_failed"] & ~F.coalesce(F.col(h)["rejected"], F.lit(False))
    return (measured.join(if_small(side), F.col(host) == F.col(key), "left")
            .withColumn(out, F.struct(F.col(h)["rate"].alias("host_rate"), kept.alias("kept"))).drop(key, h))
