"""Near-duplicate groups by b-bit MinHash.

1. Sketch: one pass over the texts hashes the distinct 5-word shingles, takes
   128 minima, folds them into 32 band keys of 4 minima, and packs the low 2
   bits of each minimum into four longs.
2. Texts with equal shingle sets collapse into one node (partial aggregation,
   so a group of any size costs one row per task). From here on only nodes
   are compared.
3. Every member of a band bucket is paired with the bucket's smallest node.
   Bit counts of the packed signatures estimate the similarity, corrected for
   chance collisions; pairs far below the threshold go, the others are
   confirmed on the full shingle sets. This is linear in the bucket.
4. Buckets whose members are not all under one label then are looked at again.
   Buckets of the same members (a pair meets in many bands) count once. Cells
   of bounded size estimate all their pairs by bit counts and report
   which labels may touch (a spanning forest, never the pairs); the groups of
   labels that may touch are confirmed on the full sets, in cells of bounded
   size as well. So no candidate is left out however large a bucket is, and a
   large group costs (members x members outside its main label) at worst.
5. Components of the confirmed links.

Two texts with similarity s share no band with probability (1 - s^4)^32, 5e-6
at 0.75. Estimates are cut five standard deviations below the threshold.

Defined results: null and empty texts, and texts without a word, have no
shingles and are linked with nothing; rows are told apart by an internal row
number, so repeated rows and null ids are separate rows: equal texts are
linked, ``component`` is the smallest non-null id of the group (null only if
the whole group has none); empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import if_small, mix64, odd_multipliers, window_hashes, word_hashes
from newsflow.llm.components import connected
from newsflow.session import materialize

SHINGLE = 5
THRESHOLD = 75            # per cent
HASHES, BANDS, ROWS = 128, 32, 4
BITS = 2                  # low bits kept of each minimum
LONGS = HASHES * BITS // 64
SIGMAS = 5.0
CELL = 512                # nodes on one side of a comparison cell
CHUNK_WORDS = 100_000     # words sketched at a time in one task (fits a core's cache)

_CHANCE = 2.0 ** -BITS
_P = THRESHOLD / 100 + (1 - THRESHOLD / 100) * _CHANCE
#: Estimates below are not confirmed: five standard deviations under the threshold.
MIN_ESTIMATE = THRESHOLD / 100 - SIGMAS * (_P * (1 - _P) / HASHES) ** 0.5 / (1 - _CHANCE)
#: The same in lanes (of HASHES) that may differ.
MAX_DIFFERENT = int(HASHES * (1 - _CHANCE) * (1 - MIN_ESTIMATE))

_MUL = odd_multipliers(HASHES, 11)
_ADD = odd_multipliers(HASHES, 13)
_LANES = 0x5555555555555555


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles: windows of 5 words, or
    the whole sequence if it is shorter. ``bytes.lower`` changes A-Z only."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(word_hashes(words), min(SHINGLE, len(words))))


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share."""
    with np.errstate(over="ignore"):
        a = mix64(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
        b = mix64(s + np.uint64(0x1234567887654321)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Rows of HASHES minima, for non-empty sets."""
    x = np.concatenate(sets)
    at = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), HASHES), np.uint64)
    for j in range(HASHES):
        out[:, j] = np.minimum.reduceat(x * _MUL[j] + _ADD[j], at)
    return out


def band_keys(m: np.ndarray) -> np.ndarray:
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(m), BANDS))
    for r in range(ROWS):
        key = mix64(key + m[:, r::ROWS])
    return key.view(np.int64)


def packed(m: np.ndarray) -> np.ndarray:
    """The low bits of all minima (mixed first, since multiplication leaves
    little in low bits), packed into LONGS longs a row."""
    low = (mix64(m) & np.uint64((1 << BITS) - 1)).reshape(len(m), LONGS, 64 // BITS)
    return np.bitwise_or.reduce(low << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)), axis=2).view(np.int64)


SKETCH = "n long, f1 long, f2 long, sig array<long>, bands array<long>"


def _sketch(texts: pd.Series) -> pd.DataFrame:
    out, start = [], 0
    while start < len(texts):
        words, sets = 0, []
        while start < len(texts) and words < CHUNK_WORDS:
            sets.append(shingles(texts.iat[start]))
            words += len(sets[-1])
            start += 1
        full = [s for s in sets if len(s)]
        m = minima(full) if full else np.empty((0, HASHES), np.uint64)
        keys, sigs = iter(band_keys(m)), iter(packed(m))
        out += [(len(s), *fingerprint(s), next(sigs), next(keys)) if len(s) else (0, 0, 0, None, None) for s in sets]
    return pd.DataFrame(out, columns=["n", "f1", "f2", "sig", "bands"])


def different(a: Column, b: Column) -> Column:
    """Lanes in which two packed signatures differ."""
    out = F.lit(0)
    for i in range(LONGS):
        x = a[i].bitwiseXOR(b[i])
        out = out + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(_LANES)))
    return out


def _sizes_fit(a: str, b: str) -> Column:
    return (100 * F.col(a) >= THRESHOLD * F.col(b)) & (100 * F.col(b) >= THRESHOLD * F.col(a))


class Forest:
    """Union-find over a cell's few labels."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _may_touch(cell: pd.DataFrame) -> pd.DataFrame:
    """Links between labels with a pair above the estimate; a spanning forest."""
    cell = cell.drop_duplicates("node")
    names, label = np.unique(cell["label"].to_numpy(), return_inverse=True)
    sig = np.array(cell["sig"].tolist(), np.int64).view(np.uint64).reshape(len(cell), LONGS)
    n = cell["n"].to_numpy()
    main = np.bincount(label).argmax()
    forest, out = Forest(len(names)), []
    for x in np.flatnonzero(label != main):
        d = sig ^ sig[x]
        far = np.bitwise_count((d | (d >> np.uint64(1))) & np.uint64(_LANES)).sum(axis=1, dtype=np.int64)
        near = (far <= MAX_DIFFERENT) & (100 * n >= THRESHOLD * n[x]) & (100 * n[x] >= THRESHOLD * n)
        for y in np.unique(label[near]):
            if forest.join(label[x], y):
                out.append((names[label[x]], names[y]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _confirm_cell(cell: pd.DataFrame) -> pd.DataFrame:
    """Confirmed links between different labels; a spanning forest of them.
    Intersections are counted through the cell's sorted shingles."""
    cell = cell.drop_duplicates("node")
    _, label = np.unique(cell["label"].to_numpy(), return_inverse=True)
    node = cell["node"].to_numpy()
    sets = [np.frombuffer(s, np.uint64) for s in cell["shingles"]]
    n = np.array([len(s) for s in sets])
    values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    main = np.bincount(label).argmax()
    forest, out = Forest(label.max() + 1), []
    for x in np.flatnonzero(label != main):
        lo, hi = np.searchsorted(values, sets[x], "left"), np.searchsorted(values, sets[x], "right")
        k = hi - lo
        at = np.repeat(lo - np.concatenate(([0], np.cumsum(k)[:-1])), k) + np.arange(k.sum())
        both = np.bincount(owner[at], minlength=len(sets))
        for y in np.flatnonzero((100 * both >= THRESHOLD * (n + n[x] - both)) & (label != label[x])):
            if forest.join(label[x], label[y]):
                out.append((node[x], node[y]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _confirm_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        ok = []
        for s, t in zip(b["sa"], b["sb"], strict=True):
            s, t = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
            both = len(np.intersect1d(s, t, assume_unique=True))
            ok.append(100 * both >= THRESHOLD * (len(s) + len(t) - both))
        yield b.loc[ok, ["a", "b"]]


def in_cells(members: DataFrame, group: str, cell: int = CELL) -> DataFrame:
    """Deals each group's members to cells of two blocks, so that every two
    members meet in a cell and no cell grows with the group."""
    sizes = members.groupBy(F.col(group).alias("_g")).agg(F.ceil(F.count(F.lit(1)) / cell).cast("int").alias("_k"))
    blocks = members.join(sizes, F.col(group) == F.col("_g")).withColumn("_i", F.pmod(F.xxhash64("node"), F.col("_k")).cast("int"))
    return (blocks.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
            .withColumn("cell", F.xxhash64("_g", F.least("_i", "_j"), F.greatest("_i", "_j"))).drop("_g", "_k", "_i", "_j"))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``row, id, text_hash, n_shingles, component, keeper``: one row per
    document; rows of one group of near-duplicates share ``component``, its
    smallest id, and ``keeper``, the row that has it (of several the first)."""
    docs = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    sketch = F.pandas_udf(_sketch, SKETCH)
    sketches = materialize(docs.select(F.monotonically_increasing_id().alias("row"), "id", F.xxhash64("text").alias("text_hash"), sketch("text").alias("s"))
                           .select("row", "id", "text_hash", "s.*"), "sketches")

    # 2. one node for each set: its smallest (id, row); null ids come last
    nodes = materialize(
        sketches.where("n > 0").groupBy("f1", "f2")
        .agg(F.min(F.struct(F.isnull("id").alias("no_id"), "id", "row", "n", "sig", "bands")).alias("s"))
        .select("f1", "f2", F.col("s.row").alias("node"), F.col("s.id").alias("id"), "s.n", "s.sig", "s.bands"), "nodes")

    # 3. bucket members against the bucket's smallest node
    banded = nodes.select("node", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("node").alias("pivot")).where("m > 1")
    shared = materialize(banded.join(buckets.drop("m").withColumnRenamed("key", "k"), F.col("key") == F.col("k"))
                         .select("key", "node", "pivot"), "shared")
    needed = materialize(shared.select("node").distinct()
                         .join(nodes.select(F.col("node").alias("v"), "id", "f1", "f2"), F.col("node") == F.col("v")).drop("v"), "needed")
    sets = shingle_sets(docs, needed, sketches)
    light = nodes.select("node", "n", "sig")
    pairs = (shared.where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
             .join(light.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sig").alias("ga")), "a")
             .join(light.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("gb")), "b")
             .where(_sizes_fit("na", "nb")).where(different(F.col("ga"), F.col("gb")) <= MAX_DIFFERENT).select("a", "b"))
    stars = materialize(pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
                        .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
                        .mapInPandas(_confirm_pairs, "a long, b long"), "stars")

    # 4. buckets that are not under one label yet
    labels = stars.groupBy("a").agg(F.min("b").alias("to"))
    labelled = materialize(needed.select("node").join(labels, F.col("node") == F.col("a"), "left")
                           .select("node", F.coalesce("to", "node").alias("label")), "labels")
    members = materialize(shared.select("key", "node").join(labelled, "node"), "members")
    open_ = (members.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("m"),
                                        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
             .where("lo <> hi").groupBy("m", "x", "y").agg(F.min("key").alias("k")).select("k"))   # equal buckets once
    touching = (in_cells(members.join(open_, F.col("key") == F.col("k")).drop("k"), "key").join(light, "node")
                .groupBy("cell").applyInPandas(_may_touch, "a long, b long"))
    groups = connected(touching)
    unclear = labelled.join(groups.select(F.col("node").alias("label"), F.col("root").alias("grp")), "label")
    late = in_cells(unclear, "grp").join(sets, "node").groupBy("cell").applyInPandas(_confirm_cell, "a long, b long")

    # 5. components, then back to all rows; ``k`` orders null ids last
    roots = materialize(connected(stars.union(late)), "roots")
    own = F.struct(F.isnull("id").alias("no_id"), "id", F.col("node").alias("row"))
    ids = nodes.select(F.col("node").alias("v"), own.alias("k"))
    best = roots.join(ids, F.col("node") == F.col("v")).groupBy(F.col("root").alias("r")).agg(F.min("k").alias("k"))
    moved = roots.join(best, F.col("root") == F.col("r")).select(F.col("node").alias("v"), "k")
    final = materialize(nodes.select("node", "f1", "f2", own.alias("own")).join(moved, F.col("node") == F.col("v"), "left")
                        .select(F.col("f1").alias("g1"), F.col("f2").alias("g2"), F.coalesce("k", "own").alias("k")), "final")
    alone = F.col("n") == 0
    return (sketches.select("row", "id", "text_hash", "n", "f1", "f2")
            .join(final, ~alone & (F.col("f1") == F.col("g1")) & (F.col("f2") == F.col("g2")), "left")
            .select("row", "id", "text_hash", F.col("n").alias("n_shingles"),
                    F.when(alone, F.col("id")).otherwise(F.col("k.id")).alias("component"),
                    F.when(alone, F.col("row")).otherwise(F.col("k.row")).alias("keeper")))


def shingle_sets(docs: DataFrame, needed: DataFrame, sketches: DataFrame) -> DataFrame:
    """The full sets of the nodes that share a bucket with another. Rows are
    found by id and then by their set's fingerprint, so repeated ids do no
    harm; where ids repeat, equal sets are collapsed."""
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [(v, s.tobytes()) for v, t, f1, f2 in zip(b["node"], b["text"], b["f1"], b["f2"], strict=True)
                     if fingerprint(s := shingles(t)) == (f1, f2)]
            yield pd.DataFrame(found, columns=["node", "shingles"]).astype({"node": "int64"})

    side = if_small(needed.withColumnRenamed("id", "nid"))
    out = docs.join(side, F.col("id").eqNullSafe(F.col("nid"))).select("node", "text", "f1", "f2").mapInPandas(sets, "node long, shingles binary")
    if sketches.groupBy("id").count().where("count > 1").isEmpty():
        return materialize(out, "sets")
    return materialize(out.groupBy("node").agg(F.max("shingles").alias("shingles")), "sets")
