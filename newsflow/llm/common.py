"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Words of the quality, mixing and near-duplicate operators: maximal runs of
# anything but space and the five ASCII control spaces. ``bytes.split()``
# splits UTF-8 at exactly these six bytes, so Python code uses that.
WORD_RE = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"

# Tables that are handed to every task are broadcast only up to this many
# bytes on disk; beyond it the same join runs as a shuffle join.
BROADCAST_BYTES = 16 << 20

# Words whose hashes a Python worker remembers at a time.
HASH_CACHE = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (names compare case-blind)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (a table read back from storage, so its size is known) with a
    broadcast hint if its files hold at most ``limit`` bytes."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= limit else df


def discard(*tables: DataFrame) -> None:
    """Deletes intermediate tables (as ``materialize`` returns them) that nothing
    needs any more."""
    for t in tables:
        sc = t.sparkSession.sparkContext
        for folder in {f.rpartition("/")[0] for f in t.inputFiles()}:
            if f"/newsflow/{sc.applicationId}/" in folder:
                path = sc._jvm.org.apache.hadoop.fs.Path(sc._jvm.java.net.URI(folder))
                path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


class WordHash(dict):
    """64-bit hash of a word (bytes), remembered for up to HASH_CACHE words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= HASH_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_WORD_HASH = WordHash()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return _WORD_HASH.of(words)


def mix64(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over the word (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_multipliers(n: int, seed: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


_POSITION = odd_multipliers(64, 7)


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all windows of ``size`` consecutive words (none if the
    text is shorter). Equal windows have equal hashes; different ones differ
    but for one chance in about 2^64 a pair."""
    n = len(h) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    s = np.full(n, size, np.uint64)
    for j in range(size):
        s += h[j:j + n] * _POSITION[j % 64]
        if j % 64 == 63:
            s = mix64(s)
    return mix64(s)
