"""Words (``WORD``: runs of letters) of sentences, found in the bytes of an Arrow batch.

A batch's sentences are laid side by side, a zero byte between them, and looked at
all at once (numpy): which bytes belong to letters, where runs of them begin and
end, and a 64-bit hash of each run. No word becomes a string of its own unless its
text is asked for. What a letter is, the driver's Java says (:func:`letter_runs`), so
words are those of Spark's own ``regexp_extract_all(sentence, WORD, 0)``; bytes that
are no UTF-8 are no letters.

Words of at most 8 bytes have different hashes, longer ones differ but for a chance
of ``2 ** -64`` a pair. Null sentences have no words.
"""

from __future__ import annotations

import hashlib
import itertools
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import SparkSession

from newsflow.operators.tagging import WORD

PAD = 16                                   # bytes after the last sentence, so 8 can be read at any place
LONG = 64                                  # words of more bytes are hashed one by one
ODD = np.uint64(0x9E3779B97F4A7C15)
HALF = np.uint64(32)
FIRST_OF_8 = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
LOWER = bytes(range(256)).lower()
LETTER, CHANGES, CAPITAL = 1, 2, 4
_RUNS: dict[str, bytes] = {}


def letter_runs(spark: SparkSession) -> bytes:
    """First and last code points of the runs of letters, as this Java knows them."""
    jvm = spark.sparkContext._jvm
    version = jvm.java.lang.System.getProperty("java.version")
    if version not in _RUNS:
        every = "".join(map(chr, itertools.chain(range(0xD800), range(0xE000, 0x110000))))
        letters = jvm.java.util.regex.Pattern.compile(WORD.replace(r"\p", r"\P")).matcher(every).replaceAll("")
        code = np.frombuffer(letters.encode("utf-32-le"), np.int32)
        cut = np.flatnonzero(np.diff(code) != 1)
        _RUNS[version] = np.stack([code[np.r_[0, cut + 1]], code[np.r_[cut, -1]]]).tobytes()
    return _RUNS[version]


@lru_cache(maxsize=4)
def letter_table(runs: bytes) -> np.ndarray:
    """For each code point: 0, or for a letter ``LETTER`` with ``CHANGES`` if lower case
    changes it and ``CAPITAL`` if it is a capital."""
    table = np.zeros(1 << 21, np.uint8)
    for low, high in np.frombuffer(runs, np.int32).reshape(2, -1).T.tolist():
        table[low:high + 1] = [LETTER | CHANGES * (chr(c).lower() != chr(c)) | CAPITAL * (unicodedata.category(chr(c)) == "Lu")
                               for c in range(low, high + 1)]
    return table


def side_by_side(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of strings, with a zero before and after each, and where each begins
    (one place more than strings: behind the last one's zero)."""
    if strings.null_count:
        strings = strings.fill_null("")
    offsets = np.frombuffer(strings.buffers()[1], np.int32, len(strings) + 1, strings.offset * 4).astype(np.int64) if len(strings) else np.zeros(1, np.int64)
    begin = offsets - offsets[0] + np.arange(1, len(strings) + 2)
    data = np.zeros(int(begin[-1]) + PAD, np.uint8)
    text = np.ones(int(begin[-1]), bool)
    text[begin - 1] = False
    if offsets[-1] > offsets[0]:
        data[:len(text)][text] = np.frombuffer(strings.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, begin


def translated(data: np.ndarray, table: bytes) -> np.ndarray:
    """``table[data]``, several times as fast."""
    return np.frombuffer(bytearray(data).translate(table), np.uint8)


class Words:
    """Words of sentences: word ``w`` is ``data[start[w]:end[w]]``, those of
    sentence ``s`` are ``bounds[s]`` to ``bounds[s + 1]``."""

    def __init__(self, sentences: pa.Array, runs: bytes):
        table = letter_table(runs)
        self.data, begin = side_by_side(sentences)
        self.kind = translated(self.data[:len(self.data) - PAD], table[:128].tobytes() + bytes(128))      # of the letter that a byte belongs to
        lead = np.flatnonzero(self.data >= 0xC0)
        sort, long = table[code_points(self.data, lead)], self.data[lead]
        lead, sort, long = lead[sort > 0], sort[sort > 0], long[sort > 0]
        for more, least in enumerate((0, 0, 0xE0, 0xF0)):          # a letter's bytes: two at least here
            self.kind[lead[long >= least] + more] = sort[long >= least]
        letter = self.kind > 0
        edge = np.flatnonzero(letter[1:] != letter[:-1]) + 1
        self.start, self.end = edge[::2], edge[1::2]
        self.bounds = np.searchsorted(self.start, begin)
        self.changing = lead[sort & CHANGES > 0]                   # letters outside ASCII that lower case changes

    def hashes(self) -> np.ndarray:
        return byte_hashes(self.data, self.start, self.end)

    def lower_hashes(self) -> np.ndarray:
        """Of the words in lower case."""
        out = byte_hashes(translated(self.data, LOWER), self.start, self.end)
        some = np.unique(np.searchsorted(self.start, self.changing, "right") - 1)
        if len(some):
            word, which = np.unique(out[some], return_inverse=True)
            one = np.empty(len(word), np.int64)
            one[which] = some
            out[some] = string_hashes(pa.array([self.text(w).lower() for w in one.tolist()], pa.string()))[which]
        return out

    def text(self, w: int) -> str:
        return self.data[self.start[w]:self.end[w]].tobytes().decode()

    def texts(self, at: np.ndarray, k: np.ndarray) -> pa.Array:
        """The texts of ``k`` words from word ``at`` on, a space between them."""
        word = runs_of(at, k)
        size = self.end[word] - self.start[word] + 1               # with the byte after it, the space
        last = np.cumsum(size) - 1
        out = self.data[runs_of(self.start[word], size)]
        out[last] = 32
        keep = np.ones(len(out), bool)
        final = last[np.cumsum(k) - 1]
        keep[final] = False
        offsets = np.r_[0, final - np.arange(len(k))].astype(np.int32)
        return pa.StringArray.from_buffers(len(k), pa.py_buffer(offsets), pa.py_buffer(out[keep]))


def capitals(words: Words, which: np.ndarray) -> np.ndarray:
    """How words begin: 0 as one capital alone, 1 of capitals only, 2 with a capital, 3 else."""
    out = np.full(len(which), 3, np.int64)
    high = np.flatnonzero(words.kind[words.start[which]] & CAPITAL)
    if len(high):
        start = words.start[which[high]]
        size = words.end[which[high]] - start
        low = np.add.reduceat(words.kind[runs_of(start, size)] & CAPITAL == 0, np.cumsum(size) - size, dtype=np.int64)
        lead = words.data[start]
        alone = size == 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
        out[high] = np.where(alone, 0, np.where(low == 0, 1, 2))
    return out


_SINES = np.floor(np.abs(np.sin(np.arange(1, 65))) * 2.0 ** 32).astype(np.uint32)
_TURNS = np.array([[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]], np.uint32)
MD5_BYTES = 55                             # of a word whose MD5 needs one block


def md5_heads(data: np.ndarray, start: np.ndarray, end: np.ndarray, at_once: int = 1 << 13) -> np.ndarray:
    """The first 4 bytes of the MD5 of ``data[start:end]`` each, as a number."""
    out = np.empty(len(start), np.uint32)
    for low in range(0, len(start), at_once):
        out[low:low + at_once] = _md5_block(data, start[low:low + at_once], np.minimum(end[low:low + at_once] - start[low:low + at_once], MD5_BYTES))
    for w in np.flatnonzero(end - start > MD5_BYTES).tolist():
        out[w] = int.from_bytes(hashlib.md5(data[start[w]:end[w]], usedforsecurity=False).digest()[:4])
    return out


def _md5_block(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    n = len(start)
    block = np.zeros((n, 64), np.uint8)
    block.reshape(-1)[runs_of(np.arange(n) * 64, size)] = data[runs_of(start, size)]
    block[np.arange(n), size] = 0x80
    block[:, 56], block[:, 57] = size * 8 & 255, size >> 5
    part = np.ascontiguousarray(block.view("<u4").T)
    a, b, c, d = (np.full(n, x, np.uint32) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476))
    first = a
    for i in range(64):
        turn, k = i // 16, (i, 5 * i + 1, 3 * i + 5, 7 * i)[i // 16] % 16
        f = d ^ (b & (c ^ d)) if turn == 0 else c ^ (d & (b ^ c)) if turn == 1 else b ^ c ^ d if turn == 2 else c ^ (b | ~d)
        f += a
        f += part[k]
        f += _SINES[i]
        s = _TURNS[turn, i % 4]
        a, d, c, b = d, c, b, b + (f << s | f >> np.uint32(32) - s)
    return (first + a).byteswap()


def runs_of(at: np.ndarray, k: np.ndarray) -> np.ndarray:
    """``at[0], at[0] + 1, ...`` (``k[0]`` of them), then those of ``at[1]`` and so on."""
    return np.repeat(at - (np.cumsum(k) - k), k) + np.arange(k.sum())


def code_points(data: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """The code points (UTF-8) that begin at ``lead``; 0 where bytes are missing."""
    one, two = data[lead].astype(np.int32), data[lead + 1].astype(np.int32)
    code = np.where(two >> 6 == 2, (one & 31) << 6 | two & 63, 0)
    more = np.flatnonzero((one >= 0xE0) & (two >> 6 == 2))
    if len(more):
        at, one, two = lead[more], one[more], two[more] & 63
        three, four = data[at + 2].astype(np.int32), data[at + 3].astype(np.int32)
        code[more] = np.where(three >> 6 != 2, 0, np.where(one < 0xF0, (one & 15) << 12 | two << 6 | three & 63, np.where(
            four >> 6 == 2, (one & 7) << 18 | two << 12 | (three & 63) << 6 | four & 63, 0)))
    return code


def byte_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of ``data[start:end]`` each; ``data`` goes on for ``PAD`` bytes."""
    eight = np.ndarray(len(data) - 7, np.uint64, data, strides=(1,))
    size = end - start
    out = eight[start] & FIRST_OF_8[np.minimum(size, 8)]
    out *= ODD
    out ^= out >> HALF
    out *= ODD
    out ^= out >> HALF
    open_ = np.flatnonzero(size > 8)
    for w in open_[size[open_] > LONG].tolist():
        out[w] = xxhash.xxh64_intdigest(data[start[w]:end[w]])
    open_, done = open_[size[open_] <= LONG], 8
    while len(open_):
        h = out[open_] ^ eight[start[open_] + done] & FIRST_OF_8[np.minimum(size[open_] - done, 8)]
        h *= ODD
        h ^= h >> HALF
        h += size[open_].astype(np.uint64)
        h *= ODD
        out[open_] = h ^ h >> HALF
        done += 8
        open_ = open_[size[open_] > done]
    return out


def string_hashes(strings: pa.Array) -> np.ndarray:
    """The hashes of whole strings, as of words."""
    data, begin = side_by_side(strings)
    return byte_hashes(data, begin[:-1], begin[1:] - 1)
