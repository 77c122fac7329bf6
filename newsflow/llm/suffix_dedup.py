"""Bytes covered by long strings that occur more than once, found by a
logarithmic family of sparse suffix arrays.

A suffix matters here by its first ``window`` bytes only. A window's anchor is
the leftmost smallest hash of the short strings in it, so equal windows have
equal anchors at equal places. Windows of one anchor whose distances to it fall
into the same block form a piece; the bytes that all possible windows of such a
block share are the piece's core. Equal windows therefore lie in pieces of equal
core, and a suffix array needs one entry a piece, not one a byte.

1. Equal texts become one, with the number of its copies, in a table bucketed by
   text: the only time texts are shuffled. One pass over it writes the pieces:
   core, hull (all bytes that its windows cover), place.
2. Documents come in batches. Each batch gets its suffix array: the cores in
   fingerprint order, one entry each with the number of its places (map-side
   sums, so a core of any frequency is one entry). The array is merge-scanned
   against the levels that exist: equal entries are long matches. It then
   becomes a level; equal-sized levels merge into one of twice the size, so an
   entry is rewritten once for each doubling. A lost task costs that task, since
   every array is a written table.
3. Pieces whose core occurs once are done: nothing of them repeats. Pieces whose
   whole hull occurs again are done as well: all of their windows repeat.
4. What is left are the borders of matches. Their hulls, and one piece for each
   other hull of the same core, are dealt by core; the windows of a deal are
   sorted and neighbours compared. A core with more than ``HOT`` hulls does not
   go to one task: its windows are dealt by themselves and counted with map-side
   sums.

Order is by 64-bit fingerprints, not by bytes: only equality of whole windows is
asked for, and any order brings equal ones together. Two different windows are
taken for equal only if they share a core and collide on a second fingerprint
(2^-64 for each pair of windows of one core).

Defined results: null texts, empty texts and texts shorter than the window have
nothing removed (null: no bytes); repeated rows, and rows of one id with
different texts, are documents of their own; matches never cross documents;
equal texts are judged alike; an empty table gives an empty one. Long texts are
read in chunks of windows, at no loss.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import discard, mix64, odd_multipliers
from newsflow.session import materialize, scratch_path

WINDOW = 400
BATCHES = 4
CHUNK = 1 << 20          # windows looked at together
HOT = 2000               # hulls of one core that a task compares by itself
DEAL = 4 << 20           # bytes of hulls in a deal, about

_BYTE = odd_multipliers(256, 17)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_BACK = np.uint64(pow(int(_BASE), -1, 2 ** 64))
_LENGTH = np.uint64(0xD6E8FEB86659FD93)
_LOW = np.uint64(0xFFFFFFFF)


class Powers:
    """Powers of the base and of its inverse (mod 2^64), as far as needed."""
    up = down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            n = max(n, 2 * len(cls.up))
            cls.up, cls.down = (np.r_[np.uint64(1), np.cumprod(np.full(n - 1, b, np.uint64))] for b in (_BASE, _BACK))
        return cls.up, cls.down


class Fingerprints:
    """Fingerprints of any substrings of ``raw`` from one array of prefix sums."""

    def __init__(self, raw: bytes):
        up, self.down = Powers.to(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE[np.frombuffer(raw, np.uint8)] * up[:len(raw)], out=self.sums[1:])

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return mix64((self.sums[start + length] - self.sums[start]) * self.down[start] + np.asarray(length).astype(np.uint64) * _LENGTH)

    def all(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return mix64((self.sums[length:] - self.sums[:n]) * self.down[:n] + np.uint64(length * int(_LENGTH) % 2 ** 64))


def smallest(values: np.ndarray, size: int) -> np.ndarray:
    """The minimum of each ``size`` consecutive values, in linear time."""
    rows = np.r_[values, np.full(-len(values) % size, np.iinfo(values.dtype).max, values.dtype)].reshape(-1, size)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - size + 1
    return np.minimum(behind[:n], ahead[size - 1:size - 1 + n])


def pieces_of(raw: bytes, window: int = WINDOW, chunk: int = CHUNK) -> Iterator[tuple[np.ndarray, ...]]:
    """(start, count, core, hull) arrays of the text's pieces: ``count`` windows
    from byte ``start`` on."""
    gram, block = max(1, min(32, window // 4)), max(1, -(-window // 3))
    inside = window - gram + 1
    for low in range(0, len(raw) - window + 1, chunk):
        part = raw[low:low + chunk + window - 1]
        fp = Fingerprints(part)
        g = fp.all(gram)
        at = np.arange(len(g), dtype=np.uint64)
        anchor = (smallest((g & ~_LOW) | at, inside) & _LOW).astype(np.int64)
        place = (anchor - np.arange(len(anchor))) // block
        cut = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(place) != 0))
        first, last = np.r_[0, cut + 1], np.r_[cut, len(anchor) - 1]
        a, b = anchor[first], place[first]
        spread = np.minimum(block - 1, inside - 1 - b * block)     # between the outer windows of the block
        core = mix64(fp.of(a - b * block, window - spread) + b.astype(np.uint64))
        hull = fp.of(first, last - first + window)
        yield first + low, last - first + 1, core.view(np.int64), hull.view(np.int64)


_PIECES = pa.schema([("h", pa.int64()), ("n", pa.int32()), ("copies", pa.int64()), ("start", pa.int32()), ("count", pa.int32()), ("core", pa.int64()), ("hull", pa.int64())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _pieces(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for h, copies, raw in zip(batch.column("h").to_pylist(), batch.column("copies").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                for start, count, core, hull in pieces_of(raw, window):
                    found.append((*(np.full(len(start), v) for v in (h, len(raw), copies)), start, count, core, hull))
            for k in range(0, len(found), 1000):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(zip(*found[k:k + 1000], strict=True), _PIECES, strict=True)], schema=_PIECES)
    return run


_HULLS = pa.schema([("core", pa.int64()), ("places", pa.int64()), ("h", pa.int64()), ("n", pa.int32()), ("start", pa.int32()), ("bytes", pa.binary())])


def _hull_bytes(window: int):
    """The bytes of the pieces asked for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, raw, wanted in zip(batch.column("h").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), batch.column("wanted").to_pylist(), strict=True):
                rows = [(p["core"], p["places"], h, len(raw), p["start"], raw[p["start"]:p["start"] + p["count"] + window - 1]) for p in wanted]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _HULLS, strict=True)], schema=_HULLS)
    return run


def _windows_of(hulls: pd.DataFrame, window: int) -> pd.DataFrame:
    """A row for each window: the hull's row number, position in the text, and
    fingerprint."""
    fps = [Fingerprints(raw).all(window).view(np.int64) for raw in hulls["bytes"]]
    sizes = np.array([len(f) for f in fps], np.int64)
    row = np.repeat(np.arange(len(hulls)), sizes)
    step = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return pd.DataFrame({"row": row, "pos": hulls["start"].to_numpy()[row] + step, "win": np.concatenate(fps)})


def _compare(window: int):
    """Spans of the repeated windows among the hulls of a deal: windows sorted by
    core and fingerprint, equal neighbours summed."""
    def run(hulls: pd.DataFrame) -> pd.DataFrame:
        w = _windows_of(hulls, window)
        core, places = hulls["core"].to_numpy()[w["row"]], hulls["places"].to_numpy()
        order = np.lexsort((w["win"], core))
        win, core = w["win"].to_numpy()[order], core[order]
        group = np.cumsum(np.r_[0, (win[1:] != win[:-1]) | (core[1:] != core[:-1])]) if len(order) else np.empty(0, np.int64)
        total = np.bincount(group, places[w["row"].to_numpy()[order]])
        again = np.zeros(len(order), bool)
        again[order] = total[group] > 1
        found = w[again & (places[w["row"]] == 1)]
        row, pos = found["row"].to_numpy(), found["pos"].to_numpy()
        cut = np.flatnonzero((np.diff(row) != 0) | (np.diff(pos) != 1))
        first, last = (np.r_[0, cut + 1], np.r_[cut, len(pos) - 1]) if len(pos) else (cut, cut)
        return pd.DataFrame({"h": hulls["h"].to_numpy()[row[first]], "n": hulls["n"].to_numpy()[row[first]], "start": pos[first], "end": pos[last] + window})
    return run


def _single_windows(window: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for hulls in batches:
            w = _windows_of(hulls, window)
            of = hulls.iloc[w["row"]].reset_index(drop=True)
            yield pd.DataFrame({"core": of["core"], "places": of["places"], "h": of["h"], "n": of["n"], "pos": w["pos"], "win": w["win"]})
    return run


class Family:
    """Suffix arrays of the batches so far, in levels of geometric size."""

    def __init__(self):
        self.levels: list[tuple[int, DataFrame]] = []     # doublings, (core, places)
        self.matches: list[DataFrame] = []

    def add(self, entries: DataFrame) -> None:
        """A batch of ``core, places``: its array, the scan of all levels, the
        merges due."""
        array = materialize(_sorted(entries), "suffix_array")
        found = array.where("places > 1").select("core")
        for _, level in self.levels:
            found = found.union(array.join(level, "core", "left_semi").select("core"))
        self.matches.append(materialize(found, "suffix_matches"))
        size = 0
        while self.levels and self.levels[-1][0] == size:
            _, level = self.levels.pop()
            both = materialize(_sorted(level.union(array)), "suffix_level")
            discard(level, array)
            array, size = both, size + 1
        self.levels.append((size, array))

    def repeated(self) -> DataFrame:
        """``core`` of all entries that have two places or more."""
        found = self.matches[0]
        for m in self.matches[1:]:
            found = found.union(m)
        return materialize(found.distinct(), "repeated_cores")

    def close(self) -> None:
        discard(*self.matches, *(level for _, level in self.levels))


def _sorted(entries: DataFrame) -> DataFrame:
    return entries.groupBy("core").agg(F.sum("places").alias("places")).sortWithinPartitions("core")


def distinct_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``h, n, text, copies``: each text once (null ones not), in a table bucketed
    by hash and bytes, so that later joins on these move no text."""
    spark = docs.sparkSession
    keyed = docs.where(F.col(text).isNotNull()).select(F.xxhash64(text).alias("h"), F.octet_length(F.col(text)).alias("n"), F.col(text).alias("text"))
    name = f"newsflow_texts_{uuid.uuid4().hex}"
    (keyed.groupBy("h", "n").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
     .write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "h", "n").option("path", scratch_path(spark, "texts")).saveAsTable(name))
    return spark.table(name)


def repeated_spans(texts: DataFrame, window: int = WINDOW, batches: int = BATCHES, hot: int = HOT) -> DataFrame:
    """``h, n, spans``: for the distinct texts with repeated windows, the places
    (start, end) that these cover, not merged."""
    long = texts.where(F.col("n") >= window)
    pieces = materialize(long.select("h", "copies", "text").mapInArrow(_pieces(window), _ddl(_PIECES)), "pieces")
    family = Family()
    for b in range(batches):
        family.add(pieces.where(F.pmod("h", F.lit(batches)) == b).select("core", F.col("copies").alias("places")))
    known = family.repeated()
    family.close()
    near = materialize(pieces.join(known, "core", "left_semi"), "matched_pieces")
    discard(pieces, known)

    hulls = materialize(near.groupBy("core", "hull").agg(F.sum("copies").alias("places"), F.min(F.struct("h", "n", "start", "count")).alias("one")), "hulls")
    unsure = materialize(hulls.groupBy("core").agg(F.min("places").alias("least"), F.count(F.lit(1)).alias("hulls"), F.sum("one.count").alias("wins"))
                         .where("least = 1 and hulls > 1").select("core", "wins", (F.col("hulls") > hot).alias("hot")), "unsure_cores")
    one = hulls.join(unsure, "core", "left_semi").select("one.h", "one.n", F.struct("core", "places", "one.start", "one.count").alias("p"))
    wanted = one.groupBy("h", "n").agg(F.collect_list("p").alias("wanted"))
    asked = materialize(long.join(wanted, ["h", "n"]).select("h", "text", "wanted").mapInArrow(_hull_bytes(window), _ddl(_HULLS)), "border_hulls")

    total = unsure.agg(F.sum(F.col("wins") + window), F.max("hot")).first()
    deals = max(1, (total[0] or 0) // DEAL)
    often = unsure.where("hot").select("core")
    cool = asked.join(often, "core", "left_anti") if total[1] else asked
    spans = cool.groupBy(F.pmod(F.xxhash64("core"), F.lit(deals))).applyInPandas(_compare(window), "h long, n int, start int, end int")
    if total[1]:
        windows = materialize(asked.join(often, "core", "left_semi").mapInPandas(_single_windows(window), "core long, places long, h long, n int, pos int, win long"), "windows")
        again = windows.groupBy("core", "win").agg(F.sum("places").alias("p")).where("p > 1").select("core", "win")
        spans = spans.union(windows.where("places = 1").join(materialize(again, "repeated_windows"), ["core", "win"], "left_semi")
                            .select("h", "n", F.col("pos").alias("start"), (F.col("pos") + window).cast("int").alias("end")))
    sure = materialize(hulls.where("places > 1").select("core", "hull"), "repeated_hulls")
    whole = (near.join(sure, ["core", "hull"], "left_semi")
             .select("h", "n", "start", (F.col("start") + F.col("count") - 1 + window).cast("int").alias("end")))
    found = materialize(whole.union(spans).groupBy("h", "n").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "spans")
    discard(near, hulls, unsure, asked, sure)
    return found


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def _cut(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    out = []
    for text, found in zip(texts, spans, strict=True):
        raw, kept, at = text.encode(), [], 0
        runs = merged(found) if found is not None else []
        for start, end in runs:
            kept.append(raw[at:start])
            at = end
        out.append(([{"start": a, "end": b} for a, b in runs], b"".join([*kept, raw[at:]])))
    return pd.DataFrame(out, columns=["spans", "kept"])


def remove_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW, batches: int = BATCHES, hot: int = HOT) -> DataFrame:
    """``h, n, spans, kept`` for each distinct text: the maximal runs of bytes
    (start, end) covered by repeated windows, and the bytes that remain (not
    always whole UTF-8 characters)."""
    texts = distinct_texts(docs, text)
    spans = repeated_spans(texts, window, batches, hot)
    cut = F.pandas_udf(_cut, "spans array<struct<start:int,end:int>>, kept binary")
    return texts.join(spans, ["h", "n"], "left").select("h", "n", cut("text", "spans").alias("c")).select("h", "n", "c.spans", "c.kept")


def of_rows(docs: DataFrame, texts: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's ``id`` and ``n_bytes`` with the columns of its text in
    ``texts`` (null for null texts)."""
    rows = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("rh"), F.octet_length(F.col(text)).alias("rn"))
    found = rows.join(texts, (F.col("rh") == F.col("h")) & (F.col("rn") == F.col("n")), "left")
    return found.withColumn("n_bytes", F.coalesce("rn", F.lit(0)).cast("long")).drop("h", "n", "rh", "rn")
