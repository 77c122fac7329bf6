"""Periodic runs: stretches of words that repeat with a smallest period.

A diagonal of lag q is a stretch of words that equal the words q before them.
Words are read in order; each takes its earlier occurrence, and if that is at
the active lag, the diagonal's match length grows by one. A diagonal that ends
with sufficient length is a run at once, with its first period before it.

Counting every earlier occurrence of every word would be quadratic in a frequent
word, so the table of diagonals is kept sparse, at no loss. Lags are taken by
scales s = 1, 2, 4, ..: scale s has the lags q with s/2 < q <= s and compares
windows of s words instead of single words. Inside a run of smallest period
q <= s, of at least four periods, a window of s words cannot recur at a distance
below q (it holds a whole period, which would then equal one of its own
rotations and have a smaller period). So only the nearest earlier occurrence of
a window can continue a run, and one lag is active at a time; a window that does
not recur in the text cannot start one either and leaves all larger scales.
Each scale is one sort of the windows left.

Words are compared by 64-bit hashes, windows by hashes of those.

Defined results: null texts and texts without a word have no runs and collapse
to the empty string; rows are judged one by one; an empty table gives an empty
table; other columns, whatever their names, pass through.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import fresh, mix64, word_hashes

LEAST, TIMES = 6, 4        # words, and periods, that a run has at least
_STEP = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]


def diagonals(at: np.ndarray, windows: np.ndarray, least: int, most: int) -> list[tuple[int, int, int]]:
    """(first, last, lag) of the stretches of consecutive positions whose nearest
    equal window is ``lag`` before, with least <= lag <= most."""
    order = np.argsort(windows, kind="stable")       # equal windows in text order
    same = np.flatnonzero(windows[order[1:]] == windows[order[:-1]])
    here = at[order[same + 1]]
    lag = here - at[order[same]]
    fits = (lag >= least) & (lag <= most)
    here, lag = here[fits], lag[fits]
    if not len(here):
        return []
    text_order = np.argsort(here)
    here, lag = here[text_order], lag[text_order]
    ends = np.flatnonzero((np.diff(here) != 1) | (np.diff(lag) != 0))
    first, last = np.r_[0, ends + 1], np.r_[ends, len(here) - 1]
    return list(zip(here[first].tolist(), here[last].tolist(), lag[first].tolist(), strict=True))


def runs_of(h: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[Run]:
    """(start, length, period) of all runs among words of hashes ``h``, by start
    and period. ``times`` is 4 or more."""
    n, s, found = len(h), 1, []
    at, window = np.arange(n), h
    while times * (s // 2 + 1) <= n:
        for first, last, q in diagonals(at, window, s // 2 + 1, s):
            length = last + s - first + q
            if length >= max(least, times * q):
                found.append((first - q, length, q))
        _, which, counts = np.unique(window, return_inverse=True, return_counts=True)
        again = np.zeros(n + s, bool)
        again[at[counts[which] > 1]] = True
        full = np.zeros(n, np.uint64)
        full[at] = window
        at = np.flatnonzero(again[:n] & again[s:n + s])
        if not len(at):
            break
        window = mix64(full[at] * _STEP + full[at + s])
        s *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """False where a run holds the word after its first period."""
    cover = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        cover[start + q] += 1
        cover[start + length] -= 1
    return np.cumsum(cover[:-1]) == 0


Edit = Callable[[list[bytes], "int | None"], list[bytes]]


def _find(edit: Edit | None):
    def run(texts: pd.Series, keys: pd.Series) -> pd.DataFrame:
        out = []
        for text, key in zip(texts, keys, strict=True):
            words = text.encode().split() if text else []
            if edit:
                words = edit(words, None if pd.isna(key) else int(key))
            runs = runs_of(word_hashes(words)) if len(words) >= LEAST else []
            if runs:
                keep = kept_words(len(words), runs)
                words = [words[i] for i in np.flatnonzero(keep).tolist()]
            out.append(([{"start": a, "length": b, "period": q} for a, b, q in runs], b" ".join(words).decode()))
        return pd.DataFrame(out, columns=["runs", "collapsed"])
    return run


def find_runs(docs: DataFrame, text: str = "text", out: str = "periodic", edit: Edit | None = None, key: Column | None = None) -> DataFrame:
    """``docs`` with the struct column ``out``: ``runs`` (start, length, period;
    by start and period) and ``collapsed``, the text's words without the
    repetitions, joined by one space. ``edit`` may change a text's words first,
    given the value of ``key``."""
    found = F.pandas_udf(_find(edit), "runs array<struct<start:long,length:long,period:long>>, collapsed string")
    name = fresh(docs, "_key")
    keyed = docs.withColumn(name, (F.lit(None) if key is None else key).cast("long"))
    return keyed.withColumn(out, found(F.col(text), F.col(name))).drop(name)


def strongest(runs: Column) -> Column:
    """The run of the greatest length / period, compared exactly; ties go to the
    smaller start, then period. Null without a run."""
    better = lambda r, b: (r["length"] * b["period"] > b["length"] * r["period"]) | (
        (r["length"] * b["period"] == b["length"] * r["period"]) & ((r["start"] < b["start"]) | ((r["start"] == b["start"]) & (r["period"] < b["period"]))))
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, lambda b, r: F.when(b.isNull() | better(r, b), r).otherwise(b))
