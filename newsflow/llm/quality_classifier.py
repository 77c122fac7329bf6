"""Quality scores by random Fourier features and ridge regression.

A text becomes a few statistics (lengths, character classes, repetition). They
are standardised, random Fourier features approximate a Gaussian kernel over
them, and ridge regression fits the labels: every partition sums its own
normal equations, the sums are added up by row, and only the final matrices
(of fixed size) are solved on the driver. Scores of rows outside the fold that
a model was fitted on are calibrated by isotonic regression over bins.

All labelled rows outside the held-out fold are used; there is no sample.

Defined results: null and empty texts have all statistics zero and get a score
like any other; repeated rows are scored one by one and count one by one in
the fit; a label whose document is missing, or a null label, is ignored;
without any labelled rows every score is 0.5; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.labels import FOLDS, Isotonic
from newsflow.llm.quality_rules import repeated_words
from newsflow.session import materialize

FEATURES = 256            # random Fourier features
WIDTH = 3.0               # of the Gaussian kernel, in standard deviations
RIDGE = 1e-4              # per row
CLIP = 6.0                # standardised statistics are cut there
BINS = 2000               # of raw scores in [-0.5, 1.5], for the calibration
SEED = 7

_CLASS = np.zeros(256, np.int64)
for _i, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>", b"|", b"!?", b".,;:", b"()[]{}\"'-_/\\=+@~^`", b" \t\n\r\x0b\x0c"), 1):
    _CLASS[list(_chars)] = _i
STATISTICS = 19


def statistics(text: str | None) -> list[float]:
    if not text:
        return [0.0] * STATISTICS
    raw = text.encode()
    words = raw.split()
    n, chars = max(len(words), 1), len(raw)
    kinds = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=9)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    m = max(len(lines), 1)
    lengths = list(map(len, words)) or [0]
    same = sum(map(bytes.__eq__, words, words[1:])) if len(words) > 1 else 0
    return [float(np.log1p(len(words))), float(np.log1p(n / m)), sum(lengths) / n, float(np.log1p(max(lengths))),
            *(float(np.sqrt(k / chars)) for k in kinds[1:8]), kinds[8] / chars,
            (len(set(words)) / n) if words else 0.0, same / n, repeated_words(words) / n, 1 - len(set(lines)) / m if lines else 0.0,
            sum(1 for x in lines if x[-1:] in b".!?") / m, sum(1 for k in lengths if k == 1) / n,
            float(np.log1p(len(lines)))]


def _statistics(texts: pd.Series) -> pd.Series:
    return pd.Series([statistics(t) for t in texts], dtype=object)


def statistics_column(text: str = "text"):
    return F.pandas_udf(_statistics, "array<double>")(F.col(text))


class Model:
    """Fixed-size: two vectors, the random frequencies, the weights, and the
    calibration's steps."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        draws = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        self.freq = draws.normal(size=(len(mean), FEATURES)) / WIDTH
        self.phase = draws.uniform(0, 2 * np.pi, FEATURES)
        self.weights: dict[int, np.ndarray] = {}
        self.calibrated: Isotonic | None = None

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -CLIP, CLIP)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ self.freq + self.phase), np.ones((len(x), 1))])

    def solve(self, sums: dict[int, np.ndarray]) -> None:
        """Weights of fold 0 use all rows, those of fold k all but fold k."""
        total = sum(sums.values())
        for fold in (0, *sums):
            a = total - sums[fold] if fold else total
            if a[-2, -2] < 1:    # nothing outside this fold
                a = total
            left, right = a[:-1, :-1], a[:-1, -1]
            ridge = np.full(len(left), RIDGE * max(left[-1, -1], 1))
            ridge[-1] = 1e-9
            self.weights[fold] = np.linalg.solve(left + np.diag(ridge), right)

    def raw(self, x: np.ndarray, fold: int = 0) -> np.ndarray:
        return self.features(x) @ self.weights.get(fold, self.weights[0])

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.calibrated(self.raw(x)) if self.calibrated is not None else np.full(len(x), 0.5)


def _matrix(arrays: pd.Series) -> np.ndarray:
    return np.array(arrays.tolist(), float).reshape(len(arrays), STATISTICS)


def fit(rows: DataFrame) -> Model:
    """``rows``: the statistics ``x`` of labelled documents, ``y`` and ``fold``."""
    rows = materialize(rows.select("x", "y", "fold"), "statistics")
    moments = (rows.select(F.posexplode("x").alias("i", "v")).groupBy("i")
               .agg(F.count("v").alias("n"), F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).collect())
    mean, scale = np.zeros(STATISTICS), np.ones(STATISTICS)
    for r in moments:
        mean[r["i"]], scale[r["i"]] = r["m"], r["s"] if r["s"] and r["s"] > 1e-9 else 1.0
    model = Model(mean, scale)
    if not moments:
        return model

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            z = np.hstack([model.features(_matrix(b["x"])), b["y"].to_numpy(float)[:, None]])
            for f in np.unique(fold := b["fold"].to_numpy()):
                part = z[fold == f]
                total[int(f)] = total.get(int(f), 0) + part.T @ part
        for f, a in total.items():
            yield pd.DataFrame({"fold": f, "i": np.arange(len(a), dtype="int32"), "v": list(a)})

    def add(rows_: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"fold": rows_["fold"].iloc[:1], "i": rows_["i"].iloc[:1], "v": [np.sum(rows_["v"].tolist(), axis=0)]})

    schema = "fold int, i int, v array<double>"
    total = {f: np.zeros((FEATURES + 2, FEATURES + 2)) for f in range(1, FOLDS)}
    for r in rows.mapInPandas(sums, schema).groupBy("fold", "i").applyInPandas(add, schema).collect():
        total[r["fold"]][r["i"]] = r["v"]
    model.solve({f: a for f, a in total.items() if a[-2, -2]})

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x, fold = _matrix(b["x"]), b["fold"].to_numpy()
            s = np.empty(len(b))
            for f in np.unique(fold):
                s[fold == f] = model.raw(x[fold == f], int(f))
            yield pd.DataFrame({"bin": np.clip((s + 0.5) / 2 * BINS, 0, BINS - 1).astype("int32"), "s": s, "y": b["y"].astype("int64")})

    bins = (rows.mapInPandas(binned, "bin int, s double, y long").groupBy("bin")
            .agg(F.avg("s").alias("s"), F.sum("y").alias("p"), F.count(F.lit(1)).alias("n")).collect())
    model.calibrated = Isotonic([r["s"] for r in bins], [r["p"] for r in bins], [r["n"] for r in bins])
    return model


def score_column(model: Model, x: str):
    def score(arrays: pd.Series) -> pd.Series:
        return pd.Series(model.score(_matrix(arrays)))
    return F.pandas_udf(score, "double")(F.col(x))
