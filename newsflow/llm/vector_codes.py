"""Vector codes by integer product quantisation with exact matrix products.

Components become integers floor(scale * x); vectors are cut into equal parts,
and each part position has a codebook that starts from the first vectors and is
moved for a few rounds. All arithmetic is exact, so codes do not depend on how
rows are dealt to tasks or on the order of sums.

Distances are |x|^2 - 2 x.c + |c|^2. The dot products run as float64 matrix
products of limbs: integers are split into balanced limbs so small that no
partial sum of a product reaches 2^53, and the products are recombined in
int64. The first smallest distance wins. Sums for the moved entries are made in
each task and leave it as limbs of 30 bits, which Spark adds up; the driver
only sees one number for each codebook component.

Bounds: with vectors of ``width`` components, integers up to
isqrt((2^61 - 1) / width) in size ("near") keep every distance inside int64. Rows or
entries beyond are compared with Python's integers instead, by the same rules.

Defined results: vectors that are null or hold a null or non-finite component
go. Shorter vectors count as padded with zeros on the right, up to the widest
kept one and a whole number of components a part. The first entries are those
of the smallest ids (null ids last), ties by the vectors themselves; fewer rows
than entries give shorter codebooks. Repeated rows count each. Rows whose error
leaves the range of a long have a null error, and so has their label. No kept
vector gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import if_small
from newsflow.session import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
SUM_BITS = 30            # bits of the limbs in which sums leave a task
LONG = 2 ** 63


def limb_bits(width: int) -> int:
    """The most bits of balanced limbs whose dot products stay below 2^53."""
    return (54 - max(width, 1).bit_length()) // 2


def limbs(a: np.ndarray, bits: int) -> list[np.ndarray]:
    """Limbs in [-2^(bits-1), 2^(bits-1)), lowest first, as float64; their sum
    times powers of 2^bits is ``a``."""
    half, out = np.int64(1 << (bits - 1)), []
    while True:
        low = ((a + half) & np.int64((1 << bits) - 1)) - half
        out.append(low.astype(np.float64))
        a = (a - low) >> bits
        if not a.any():
            return out


def exact_dot(x: np.ndarray, c: np.ndarray, bits: int | None = None) -> np.ndarray:
    """``x @ c.T`` of int64 matrices, exact if the result fits int64."""
    bits = bits or limb_bits(x.shape[1])
    total = np.zeros((len(x), len(c)), np.int64)
    right = limbs(c, bits)
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(right):
            if bits * (i + j) < 64:
                total += (a @ b.T).astype(np.int64) << np.int64(bits * (i + j))
    return total


def near_limit(width: int) -> int:
    return math.isqrt((2 ** 61 - 1) // max(width, 1))


def to_integers(values: np.ndarray, scale: int, limit: int) -> tuple[np.ndarray, dict[int, list[int]]]:
    """floor(scale * x) of a float64 matrix as int64, and the rows that hold an
    integer beyond ``limit`` as Python integers (zeros in the matrix)."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)
    far = np.flatnonzero(~(np.abs(scaled) <= limit).all(axis=1))
    rows = {}
    for i in far.tolist():
        # a double beyond 2^53 is an integer: scaling it as one cannot overflow
        rows[i] = [math.floor(v * scale) if abs(v) < 2 ** 53 else int(v) * scale for v in values[i].tolist()]
        scaled[i] = 0
    return scaled.astype(np.int64), rows


@dataclass
class Codebook:
    """Entries by part: ``entries[part][entry]`` is a list of integers."""
    entries: list[list[list[int]]]
    width: int
    scale: int

    def __post_init__(self):
        self.limit = near_limit(self.width)
        self.near, self.far = [], []       # by part: (indexes, matrix), indexes
        for part in self.entries:
            ok = [i for i, e in enumerate(part) if all(abs(v) <= self.limit for v in e)]
            self.near.append((np.array(ok, np.int64), np.array([part[i] for i in ok], np.int64).reshape(len(ok), -1)))
            self.far.append([i for i in range(len(part)) if i not in set(ok)])

    @property
    def size(self) -> int:
        return len(self.entries[0])

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(v) for part in self.entries for e in part for v in e).encode()).hexdigest()

    def assign(self, x: np.ndarray, far: dict[int, list[int]]) -> tuple[np.ndarray, list[int] | np.ndarray]:
        """Entry indexes (rows by parts) and each row's squared distance."""
        parts, step = len(self.entries), self.width // len(self.entries)
        code = np.zeros((len(x), parts), np.int64)
        error = np.zeros(len(x), np.int64)
        extra: dict[int, int] = {}         # errors that int64 may not hold
        for p in range(parts):
            index, c = self.near[p]
            part = x[:, p * step:(p + 1) * step]
            if len(index):
                d = (part * part).sum(1)[:, None] - 2 * exact_dot(part, c) + (c * c).sum(1)
                first = d.argmin(1)
                code[:, p], best = index[first], d[np.arange(len(x)), first]
            else:
                code[:, p], best = self.size, np.zeros(len(x), np.int64)
            slow = range(len(x)) if self.far[p] else far
            for i in slow:
                row = far[i][p * step:(p + 1) * step] if i in far else part[i].tolist()
                tried = range(self.size) if i in far or not len(index) else self.far[p]
                e, k = min((sum((a - b) ** 2 for a, b in zip(row, self.entries[p][k], strict=True)), k) for k in tried)
                if i in far or not len(index) or (e, k) < (int(best[i]), int(code[i, p])):
                    code[i, p], best[i] = k, 0
                    extra[i] = extra.get(i, 0) + e
            error += best
        if not extra:
            return code, error
        return code, [int(v) + extra.get(i, 0) for i, v in enumerate(error.tolist())]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as a float64 matrix, shorter rows padded with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _limb_rows(part: int, entry: int, sums: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
    for pos, v in enumerate(sums):
        limb = 0
        while v:
            low = ((v + (1 << (SUM_BITS - 1))) & ((1 << SUM_BITS) - 1)) - (1 << (SUM_BITS - 1))
            if low:
                yield part, entry, pos, limb, low
            v, limb = (v - low) >> SUM_BITS, limb + 1


def _partial_sums(book, parts: int):
    """Per task and entry, the count (position ``step``) and component sums of
    the parts assigned to it, in limbs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b: Codebook = book.value
        step = b.width // parts
        sums = np.zeros((parts, b.size, step + 1), np.int64)
        more: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            x, far = to_integers(_matrix(batch.column(0), b.width), b.scale, b.limit)
            code, _ = b.assign(x, far)
            for p in range(parts):
                for j in range(step):      # below 2^53: at most a batch of near integers
                    sums[p, :, j] += np.bincount(code[:, p], x[:, p * step + j], b.size).astype(np.int64)
                sums[p, :, step] += np.bincount(code[:, p], minlength=b.size)
            for i, row in far.items():
                for p in range(parts):
                    s = more.setdefault((p, int(code[i, p])), [0] * step)
                    more[p, int(code[i, p])] = [a + v for a, v in zip(s, row[p * step:(p + 1) * step], strict=True)]
        rows = []
        for p in range(parts):
            for k in np.flatnonzero(sums[p, :, step]).tolist():
                s = sums[p, k].tolist()
                if (p, k) in more:
                    s = [a + v for a, v in zip(s, [*more[p, k], 0], strict=True)]
                rows += _limb_rows(p, k, s)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, (pa.int32(),) * 4 + (pa.int64(),), strict=True)],
                                         names=["part", "entry", "pos", "limb", "s"])
    return run


def _codes(book):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b: Codebook = book.value
        for batch in batches:
            x, far = to_integers(_matrix(batch.column("vec"), b.width), b.scale, b.limit)
            code, error = b.assign(x, far)
            text = code.astype(np.uint8).tobytes().hex()
            n = 2 * code.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array([text[i * n:(i + 1) * n] for i in range(len(code))], pa.string()),
                 pa.array([int(v) if v < LONG else None for v in error], pa.int64())], names=["id", "label", "code", "error"])
    return run


def kept_vectors(vectors: DataFrame, id: str = "vec_id", vec: str = "embedding", label: str = "label") -> DataFrame:
    """``id, vec, label`` of the rows with whole, finite vectors."""
    v = F.col(vec).cast("array<double>")
    inf = F.lit(float("inf"))
    sound = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (x < inf) & (x > -inf))
    return vectors.where(sound).select(F.col(id).alias("id"), v.alias("vec"), F.col(label).alias("label"))


def fit(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebook | None:
    """The codebooks after ``rounds`` moves; None without a vector."""
    if entries > 256:
        raise ValueError("codes have two hexadecimal digits: at most 256 entries")
    widest = kept.agg(F.max(F.size("vec"))).first()[0]
    if widest is None:
        return None
    width = max(1, -(-widest // parts)) * parts
    first = [r["vec"] for r in kept.select("id", "vec").orderBy(F.col("id").asc_nulls_last(), "vec").limit(entries).collect()]
    limit = near_limit(width)
    x, far = to_integers(np.array([list(v) + [0.0] * (width - len(v)) for v in first]), scale, limit)
    rows = [far.get(i) or v for i, v in enumerate(x.tolist())]
    step = width // parts
    book = Codebook([[r[p * step:(p + 1) * step] for r in rows] for p in range(parts)], width, scale)
    spark = kept.sparkSession
    for _ in range(rounds):
        partial = kept.select("vec").mapInArrow(_partial_sums(spark.sparkContext.broadcast(book), parts), "part int, entry int, pos int, limb int, s long")
        total: dict[tuple[int, int], list[int]] = {}
        for r in partial.groupBy("part", "entry", "pos", "limb").agg(F.sum("s").alias("s")).toLocalIterator():
            t = total.setdefault((r["part"], r["entry"]), [0] * (step + 1))
            t[r["pos"]] += r["s"] << (SUM_BITS * r["limb"])
        book = Codebook([[[s // total[p, k][step] for s in total[p, k][:step]] if (p, k) in total else e
                          for k, e in enumerate(part)] for p, part in enumerate(book.entries)], width, scale)
    return book


def encode(kept: DataFrame, book: Codebook) -> DataFrame:
    """``id, label, code, error`` for each row of ``kept``."""
    types = dict(kept.dtypes)
    shared = kept.sparkSession.sparkContext.broadcast(book)
    return kept.select("id", "label", "vec").mapInArrow(_codes(shared), f"id {types['id']}, label {types['label']}, code string, error long")


def compress(vectors: DataFrame, id: str = "vec_id", vec: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """``id, label, code, error, label_error, codebooks_sha256``. Errors by label
    are partial sums in each task and join back as a small table."""
    kept = kept_vectors(vectors, id, vec, label)
    book = fit(kept, parts, entries, rounds, scale)
    if book is None:
        none = F.lit(None).cast("long")
        return kept.where("false").select("id", "label", F.lit("").alias("code"), none.alias("error"), none.alias("label_error"), F.lit("").alias("codebooks_sha256"))
    codes = materialize(encode(kept, book), "vector_codes")
    whole = F.count("error") == F.count(F.lit(1))
    by_label = materialize(codes.groupBy(F.col("label").alias("of")).agg(F.when(whole, F.try_sum("error")).alias("label_error")), "label_errors")
    return (codes.join(if_small(by_label), F.col("label").eqNullSafe(F.col("of")), "left")
            .select("id", "label", "code", "error", "label_error", F.lit(book.sha256()).alias("codebooks_sha256")))
