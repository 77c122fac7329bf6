"""The labelled rows that may be learnt from, and isotonic calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def fold_of(id: Column) -> Column:
    """crc32 of the id as text, modulo 5. Fold 0 is held out; a null id has no
    fold (null)."""
    return F.pmod(F.crc32(id.cast("string").cast("binary")), F.lit(FOLDS))


def held_out(id: Column) -> Column:
    return F.coalesce(fold_of(id) == 0, F.lit(False))


def training_labels(labels: DataFrame, label: str, id: str = "doc_id") -> DataFrame:
    """``lid, y, fold``, one row for each id outside the held-out fold with a
    label of 0 or 1; of contradicting labels the larger stands."""
    return (labels.where(F.col(id).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(id).alias("lid"))
            .agg(F.max(label).cast("int").alias("y")).withColumn("fold", fold_of(F.col("lid")).cast("int")).where("fold <> 0"))


class Isotonic:
    """Pool-adjacent-violators over (value, positives, rows), interpolated
    between the centres of the pools; ties inside a pool are ordered by the raw
    value, in the last thousandth of the scale."""

    def __init__(self, value, positives, rows):
        pools: list[list[float]] = []
        for v, p, n in sorted(zip(value, positives, rows, strict=True)):
            pools.append([v * n, p, n])
            while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
                last = pools.pop()
                pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
        self.x = np.array([p[0] / p[2] for p in pools]) if pools else np.zeros(1)
        self.y = np.array([p[1] / p[2] for p in pools]) if pools else np.full(1, 0.5)
        self.x, first = np.unique(self.x, return_index=True)
        self.y = self.y[first]

    def __call__(self, value: np.ndarray) -> np.ndarray:
        return np.clip(0.999 * np.interp(value, self.x, self.y) + 0.001 * np.clip(value, 0, 1), 0, 1)
