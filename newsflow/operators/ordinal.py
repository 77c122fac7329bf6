"""Sentiment stars by a cumulative-link model.

Stars are ordered, so one line is fitted with thresholds on it: the probability of
at most k stars is ``1 / (1 + exp(score - threshold_k))`` with growing thresholds. The
score is the sum of the weights of a text's one- and two-word pieces (runs of letters
or of marks, case kept) over the square root of their number. Pieces are hashed to
``BUCKETS`` weights, so the model has a fixed size.

Fitting climbs the likelihood of all labelled rows by the whole gradient (AdaGrad
steps, an L2 penalty). In a round each partition sums its rows' gradients (a row adds
its residual to its pieces' buckets and to the thresholds); the partitions' sums are
added by an aggregation, of which at most ``BUCKETS`` and a few rows reach the driver.
Contributions are rounded to multiples of ``2 ** -24`` and added as integers, so
reruns give the same model whatever the order of the sums.
Thresholds are kept apart by fitting the logarithms of their distances.

Scoring is a projection in the JVM: hashed pieces, one look into an array of weights
each, no Python and no shuffle. A text has as many stars as the median says: one more
than the thresholds below its score.

Defined results: a text without a piece (or null) has score 0; labels outside 1 to
``levels`` and null labels are ignored; without labelled rows all weights are 0 and
thresholds are evenly spread around 0, which gives the middle level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions.dates import bind
from newsflow.session import materialize

BUCKETS = 1 << 14
PIECE = r"\p{L}+|[^\p{L}\s]+"
ROUNDS = 30
RATE = 0.5                # of the first steps
CALM = 1e-3               # added to AdaGrad's root: buckets with tiny gradients move little
PENALTY = 1e-5
UNIT = float(1 << 24)
LEAST = 1e-12


def pieces(text: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of a text's one- and two-word pieces, in text order."""
    def both(words):
        pairs = F.transform(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.concat_ws(" ", F.get(words, i), w))
        return F.transform(F.concat(words, pairs), lambda g: F.pmod(F.xxhash64(g), F.lit(buckets)).cast("int"))
    return bind(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PIECE), 0), both)


def doubles(values: np.ndarray) -> Column:
    """An array literal: folded once, then read by place."""
    return F.split(F.lit(",".join(map(repr, values.tolist()))), ",").cast("array<double>")


def total(found: Column, weights: Column) -> Column:
    """The score of a text's pieces."""
    n = F.greatest(F.size(found), F.lit(1)).cast("double")
    return F.aggregate(found, F.lit(0.0), lambda a, b: a + F.get(weights, b)) / F.sqrt(n)


def _sums(weights: np.ndarray, edges: np.ndarray):
    """What the rows of a partition add, in units: to the buckets, from place
    ``size`` on to the thresholds (the outer two have slope 0), then to the
    likelihood and the number of rows."""
    size = len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size + len(edges) + 2, np.int64)
        for batch in batches:
            n = batch.column("b").value_lengths().to_numpy()
            at, y = batch.column("b").flatten().to_numpy(), batch.column("y").to_numpy()
            row, root = np.repeat(np.arange(len(n)), n), np.sqrt(np.maximum(n, 1))
            s = np.bincount(row, weights[at], len(n)) / root
            upper, lower = (1 / (1 + np.exp(np.clip(s - edges[y - j], -700, 700))) for j in (0, 1))
            upper, lower = np.where(y == len(edges) - 1, 1.0, upper), np.where(y == 1, 0.0, lower)
            chance = np.maximum(upper - lower, LEAST)

            def add(places, values):
                units = np.rint(values * UNIT).astype(np.int64)
                out[:] += np.bincount(places, units, len(out)).astype(np.int64)      # sums below 2 ** 53: exact
            add(at, ((upper + lower - 1) / root)[row])
            add(size + y, upper * (1 - upper) / chance)
            add(size + y - 1, -lower * (1 - lower) / chance)
            out[-2] += np.rint(np.log(chance) * UNIT).astype(np.int64).sum()
            out[-1] += len(n)
        place = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(out[place])], names=["at", "v"])
    return run


@dataclass
class OrdinalModel:
    levels: int = 5
    buckets: int = BUCKETS
    weights: np.ndarray = field(default=None)
    gaps: np.ndarray = field(default=None)        # first threshold, then logarithms of the distances

    def __post_init__(self):
        if self.weights is None:
            self.weights = np.zeros(self.buckets)
        if self.gaps is None:
            self.gaps = np.zeros(self.levels - 1)
            self.gaps[0] = (2 - self.levels) / 2

    @property
    def thresholds(self) -> np.ndarray:
        return np.cumsum(np.r_[self.gaps[0], np.exp(self.gaps[1:])])

    def gradient(self, rows: DataFrame) -> tuple[np.ndarray, np.ndarray, float, int]:
        """Of rows ``b`` (pieces) and ``y`` (stars): what each bucket and each
        threshold adds to the log likelihood, the likelihood, and the rows."""
        k, size = self.levels - 1, self.buckets
        run = _sums(self.weights, np.r_[-np.inf, self.thresholds, np.inf])
        got = rows.select("b", "y").mapInArrow(run, "at int, v long").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
        out = np.zeros(size + k + 4)
        out[got.column("at").to_numpy()] = got.column("v").to_numpy() / UNIT
        return out[:size], out[size + 1:size + 1 + k], out[size + k + 2], round(out[size + k + 3] * UNIT)

    @classmethod
    def fit(cls, labelled: DataFrame, text: str = "text", stars: str = "stars", levels: int = 5, buckets: int = BUCKETS,
            rounds: int = ROUNDS) -> OrdinalModel:
        rows = materialize(labelled.where(F.col(stars).between(1, levels))
                           .select(pieces(F.col(text), buckets).alias("b"), F.col(stars).cast("int").alias("y")), "ordinal")
        model, seen = cls(levels, buckets), 0.0
        for _ in range(rounds):
            by_bucket, by_threshold, _, n = model.gradient(rows)
            if not n:
                return model
            seen = model.climb(by_bucket / n, by_threshold / n, seen)
        return model

    def climb(self, by_bucket: np.ndarray, by_threshold: np.ndarray, seen: np.ndarray | float) -> np.ndarray:
        """One step; ``seen`` are the squared gradients so far."""
        tail = np.cumsum(by_threshold[::-1])[::-1]          # a distance moves all thresholds above it
        g = np.r_[by_bucket - PENALTY * self.weights, tail * np.r_[1.0, np.exp(self.gaps[1:])]]
        seen = seen + g ** 2
        step = RATE * g / (np.sqrt(seen) + CALM)
        self.weights, self.gaps = self.weights + step[:self.buckets], self.gaps + step[self.buckets:]
        return seen


class OrdinalScorer:
    """N4 provider: ``hits`` (pieces) and ``stars`` of a chunk."""

    name = "ordinal"

    def __init__(self, model: OrdinalModel):
        self.model = model

    def score(self, df: DataFrame, chunk_col: str = "chunk") -> DataFrame:
        weights, thresholds = doubles(self.model.weights), doubles(self.model.thresholds)

        def scored(b):
            above = lambda s: 1 + F.size(F.filter(thresholds, lambda t: t < s))
            return F.struct(F.size(b).cast("bigint").alias("hits"), bind(total(b, weights), above).cast("bigint").alias("stars"))
        rows = df.withColumn("_s", F.array(bind(pieces(F.col(chunk_col), self.model.buckets), scored)))
        return rows.select(*df.columns, F.inline_outer("_s"))
