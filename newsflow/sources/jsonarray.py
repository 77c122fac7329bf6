"""One-array JSON files, read and written in parallel.

Spark reads a file that holds one JSON array in a single task, whatever its
size. Here such a file is cut into byte ranges and every range is a task:

1. Each range is scanned once for what it does to the reader's state: whether it
   holds an odd number of string quotes, and by how much its brackets change
   the nesting, for either case of its start (outside or inside a string).
   Brackets and commas inside strings and escaped quotes do not count.
2. These few numbers per range are chained on the driver, which gives each
   range the state at its first byte.
3. Each range then yields the records that begin in it: the text between two
   commas (or the brackets) of an array at the outermost level. The last one is
   read on beyond the range's end to its own end, so a record of any length
   belongs to one task, and it is parsed by Spark's ``from_json``.

The ranges are a Python data source (``json_array_ranges``). Files are opened by
``pyarrow.fs`` from their URI (local, HDFS, S3, GCS, ...), so executors read only
their ranges. A range's first byte is moved past an escape that the border
would cut.

Defined results: an empty array gives no record; records that are no object
give a row of nulls (as Spark's reader does); line breaks and indentation
between records do not matter; several arrays in one file are read one after
the other; a file that is no array, is cut off or is not balanced raises.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RANGE_BYTES = 8 << 20
FORMAT = "json_array_ranges"
SUMMARY = "file int, start long, quotes int, outside long, inside long, sound boolean"
_BATCH = 4 << 20           # bytes of record texts in an Arrow batch

_ESCAPE = re.compile(rb"\\.", re.S)
_QUOTE, _COMMA = b'",'
_DEPTH = np.zeros(256, np.int8)
_DEPTH[list(b"[{")] = 1
_DEPTH[list(b"]}")] = -1


def _open(uri: str):
    from pyarrow import fs
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def border(f, at: int) -> int:
    """``at``, or the byte after it if it is escaped: an odd number of
    backslashes stands before it."""
    n, block = 0, 64
    while at - n > 0:
        low = max(0, at - n - block)
        f.seek(low)
        before = f.read(at - n - low)
        run = len(before) - len(before.rstrip(b"\\"))
        n += run
        if run < len(before):
            break
        block *= 8
    return at + n % 2


def _range(f, start: int, end: int) -> tuple[int, np.ndarray]:
    """First byte and bytes of a range, escapes blanked out."""
    low, high = border(f, start), border(f, end)
    f.seek(low)
    return low, np.frombuffer(_ESCAPE.sub(b"__", f.read(high - low)), np.uint8)


def inside_strings(raw: np.ndarray, inside: bool) -> tuple[np.ndarray, bool]:
    """For each byte whether it is part of a string (the closing quote is
    none), and the state after the last."""
    odd = (np.cumsum(raw == _QUOTE, dtype=np.int32) + inside) % 2 == 1
    return odd, bool(odd[-1]) if len(odd) else inside


def summary(f, start: int, end: int) -> tuple[int, int, int, bool]:
    """Quotes (parity) and bracket balance of a range that starts outside or
    inside a string; whether the file's first range opens an array."""
    _, raw = _range(f, start, end)
    step = _DEPTH[raw]
    odd, _ = inside_strings(raw, False)
    text = raw[~np.isin(raw, list(b" \t\r\n\xef\xbb\xbf"))][:1] if start == 0 else b""
    sound = start > 0 or len(text) == 0 or text[0] == ord("[")
    return int((raw == _QUOTE).sum() % 2), int(step[~odd].sum(dtype=np.int64)), int(step[odd].sum(dtype=np.int64)), sound


def separators(raw: np.ndarray, inside: bool, depth: int) -> tuple[np.ndarray, np.ndarray, bool, int]:
    """Places of the outermost array's commas and brackets, which of them a
    record may follow, and the state after the last byte."""
    odd, inside = inside_strings(raw, inside)
    step = np.where(odd, 0, _DEPTH[raw]).astype(np.int8)
    level = depth + np.cumsum(step, dtype=np.int64)
    comma = (raw == _COMMA) & ~odd & (level == 1)
    opens, closes = (step == 1) & (level == 1), (step == -1) & (level == 0)
    at = np.flatnonzero(comma | opens | closes)
    return at, ~closes[at], inside, int(level[-1]) if len(level) else depth


def records(f, start: int, end: int, size: int, inside: bool, depth: int) -> Iterator[bytes]:
    """Texts of the records that begin in the range."""
    low, raw = _range(f, start, end)
    at, follows, inside, depth = separators(raw, inside, depth)
    if not len(at):
        return
    f.seek(low)
    text = f.read(len(raw))
    for a, b, is_one in zip(at[:-1].tolist(), at[1:].tolist(), follows[:-1].tolist(), strict=True):
        if is_one and (found := text[a + 1:b].strip()):
            yield found
    if not follows[-1]:
        return
    rest, block = [text[int(at[-1]) + 1:]], 1 << 16
    end = low + len(raw)
    while end < size:
        low, raw = _range(f, end, min(end + block, size))
        places, _, inside, depth = separators(raw, inside, depth)
        stop = int(places[0]) if len(places) else len(raw)
        f.seek(low)
        rest.append(f.read(stop))
        if len(places):
            break
        end, block = low + len(raw), min(8 * block, RANGE_BYTES)
    if found := b"".join(rest).strip():
        yield found


class Range(InputPartition):
    def __init__(self, file: int, uri: str, start: int, end: int, size: int, inside: bool, depth: int):
        self.file, self.uri, self.start, self.end, self.size, self.inside, self.depth = file, uri, start, end, size, inside, depth


class RangeReader(DataSourceReader):
    def __init__(self, options: dict):
        import json
        self.files = json.loads(options["files"])            # (uri, bytes) each
        self.step = int(options["rangeBytes"])
        states = options.get("states")
        self.states = json.loads(states) if states else None  # (inside, depth) of each range

    def partitions(self) -> list[Range]:
        cuts = [(i, uri, a, min(a + self.step, size), size) for i, (uri, size) in enumerate(self.files) for a in range(0, size, self.step)]
        return [Range(*c, *(self.states[k] if self.states else (False, 0))) for k, c in enumerate(cuts)]

    def read(self, p: Range) -> Iterator[pa.RecordBatch]:
        with _open(p.uri) as f:
            if self.states is None:
                row = (p.file, p.start, *summary(f, p.start, p.end))
                types = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=["file", "start", "quotes", "outside", "inside", "sound"])
                return
            texts, held = [], 0
            for record in records(f, p.start, p.end, p.size, p.inside, p.depth):
                texts.append(record.decode())
                held += len(record)
                if held >= _BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["value"])
                    texts, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["value"])


class JsonArrayRanges(DataSource):
    """Options: ``files`` (JSON list of [uri, bytes]), ``rangeBytes`` and, for
    the records instead of the ranges' summaries, ``states``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string" if self.options.get("states") else SUMMARY

    def reader(self, schema: T.StructType) -> RangeReader:
        return RangeReader({**self.options, "rangeBytes": self.options.get("rangebytes") or self.options["rangeBytes"]})


def array_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(uri, bytes) of the data files at ``path`` (a file, folder or pattern)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    system, found = p.getFileSystem(conf), []
    for top in system.globStatus(p) or []:
        for s in (system.listStatus(top.getPath()) if top.isDirectory() else [top]):
            if s.isFile() and not s.getPath().getName().startswith(("_", ".")) and s.getLen():
                found.append((s.getPath().toString(), s.getLen()))
    return sorted(found)


def chained(files: list[tuple[str, int]], rows: list) -> list[tuple[bool, int]]:
    """The state at the start of each range, in file and byte order."""
    states, last = [], None
    inside, depth = False, 0
    for r in sorted(rows, key=lambda r: (r["file"], r["start"])):
        if r["file"] != last:
            if inside or depth:
                raise ValueError(f"{files[last][0]} is cut off or not balanced")
            inside, depth, last = False, 0, r["file"]
        if not r["sound"]:
            raise ValueError(f"{files[last][0]} holds no JSON array")
        states.append((inside, depth))
        depth += r["inside"] if inside else r["outside"]
        inside ^= bool(r["quotes"])
    if inside or depth:
        raise ValueError(f"{files[last][0]} is cut off or not balanced")
    return states


def read_record_texts(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``value``: the JSON text of each record, one task for each byte range."""
    import json
    files = array_files(spark, path)
    if not files:
        return spark.createDataFrame([], "value string")
    spark.dataSource.register(JsonArrayRanges)
    reader = spark.read.format(FORMAT).option("files", json.dumps(files)).option("rangeBytes", str(range_bytes))
    states = chained(files, reader.load().collect())        # one small row for each range
    return reader.option("states", json.dumps(states)).load()


def read_json_arrays(spark: SparkSession, path: str, schema: T.StructType, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of all one-array files at ``path``."""
    texts = read_record_texts(spark, path, range_bytes)
    return texts.select(F.from_json("value", schema).alias("r")).select("r.*")


def write_json_arrays(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1, K2: one JSON array file for each task, null fields written."""
    lines = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))

    def bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = "["
        for b in batches:
            texts = []
            for v in b.column(0).to_pylist():
                texts.append(mark + v)
                mark = ","
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if mark == "[" else "]"], pa.string())], names=["value"])

    lines.mapInArrow(bracketed, "value string").write.mode(mode).text(path)
