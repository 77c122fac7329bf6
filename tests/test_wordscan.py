"""Words found in bytes: against Spark's own expressions."""
import hashlib
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from newsflow.operators import sequence as SQ
from newsflow.operators import wordscan as W
from newsflow.operators.tagging import WORD

SIGNS = "aB zÉéß!ΣσİıǅⅷÅ名𝒜𐐀９9 　-́\x00"


def sentences(seed, n=400):
    draw = random.Random(seed)
    return ["".join(draw.choices(SIGNS, k=draw.randrange(0, 40))) for _ in range(n)] + ["", "é" * 99, "x" * 70 + " " + "x" * 71, None]


def cut(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select(
        "i", F.regexp_extract_all("t", F.lit(WORD), 0).alias("w")).select("i", "w", F.transform("w", F.lower).alias("l")).orderBy("i").collect()
    return [r.w or [] for r in rows], [w for r in rows for w in r.l or []]


def test_words_and_hashes_are_those_of_spark(spark):
    texts, runs = sentences(3), W.letter_runs(spark)
    words, low = cut(spark, texts)
    flat = [w for ws in words for w in ws]
    got = W.Words(pa.array(texts, pa.string()), runs)
    assert [[got.text(i) for i in range(a, b)] for a, b in zip(got.bounds[:-1], got.bounds[1:], strict=True)] == words
    assert len(set(got.hashes().tolist())) == len(set(flat)) and (got.hashes() == W.string_hashes(pa.array(flat))).all()
    assert (got.lower_hashes() == W.string_hashes(pa.array(low))).all()
    part = W.Words(pa.array(texts, pa.string())[100:200], runs)                  # a slice of an array
    assert [part.text(i) for i in range(len(part.start))] == [w for ws in words[100:200] for w in ws]
    at = np.arange(0, len(flat) - 3, 2)
    k = at % 3 + 1
    assert got.texts(at, k).to_pylist() == [" ".join(flat[a:a + n]) for a, n in zip(at, k, strict=True)]
    for none in ([], [""], [None, ""]):
        w = W.Words(pa.array(none, pa.string()), runs)
        assert not len(w.start) and w.texts(w.start, w.start).to_pylist() == [] and len(w.bounds) == len(none) + 1


def test_each_letter_is_one_and_in_lower_case_as_for_spark(spark):
    chars = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"{c} a{c}a A{c}." for c in chars[k:k + 2000]) for k in range(0, len(chars), 2000)]
    words, low = cut(spark, texts)
    got = W.Words(pa.array(texts), W.letter_runs(spark))
    assert np.diff(got.bounds).tolist() == list(map(len, words))
    assert (got.lower_hashes() == W.string_hashes(pa.array(low))).all()


def test_bytes_that_are_no_utf8_are_no_letters(spark):
    raw = [b"a\xc3", b"b\xc3 c", b"\xe2\x82d\xa9", b"\xf0\x9d\x92", b"e\xff\xfef", "gé".encode()]
    size = np.cumsum([0, *map(len, raw)]).astype(np.int32)
    got = W.Words(pa.StringArray.from_buffers(len(raw), pa.py_buffer(size), pa.py_buffer(b"".join(raw))), W.letter_runs(spark))
    assert [got.text(i) for i in range(len(got.start))] == ["a", "b", "c", "d", "e", "f", "gé"]
    assert got.bounds.tolist() == [0, 1, 3, 4, 4, 6, 7]


def test_md5_and_codes(spark):
    got = W.Words(pa.array([*sentences(4), *("x" * n + " " + "É" * n for n in range(1, 80))], pa.string()), W.letter_runs(spark))
    flat = [got.text(i) for i in range(len(got.start))]
    assert W.md5_heads(got.data, got.start, got.end, 100).tolist() == [int.from_bytes(hashlib.md5(w.encode()).digest()[:4]) for w in flat]
    want, known = SQ.sentence_codes(pa.array(flat), got.bounds), SQ.KnownCodes()
    for _ in range(2):                                                           # new words and known ones
        assert (known.of(got) == want).all()
    known.hash = known.hash[:1].repeat(len(known.hash))                          # none is remembered
    assert (known.of(got) == want).all()
