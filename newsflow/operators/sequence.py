"""Person tagging by a hidden Markov model.

Words are outside a name (O), its first word (B) or a later one (I). A first-order
model is counted from tagged texts, e.g. those in which the names of a table were
found, and finds names that no table lists: by the words around them, by their
own words, and by the shape of words that are rare.

* Symbols. A word is the bucket of its MD5 (``2 ** 20`` buckets, so the model has
  a fixed greatest size whatever the vocabulary); words of buckets seen fewer
  than ``RARE`` times are their shape instead (a capital, all capitals,
  capitalised, other; apart at the start of a sentence).
* Words are found in the bytes of an Arrow batch (:mod:`newsflow.operators.wordscan`) and
  carried as numbers; a Python worker remembers the numbers of words seen before.
* Counting is one aggregation with map-side sums over (tag before, tag, bucket,
  shape); a frequent word costs a row a task. What reaches the driver has at most
  a row for each bucket.
* Decoding. Costs are integers, ``floor(-1000 ln p + 0.5)``, so the cheapest path
  is exact. It is found by Viterbi's recursion for all sentences of an Arrow batch
  at once, one position after the other: linear in the words, without a shuffle.
  Of equally cheap paths the one with the smallest tag wins, from the last word
  backwards (O before B before I).

Defined results: null texts have no sentences; a sentence without a word has no
persons; a model of no texts tags nothing; I follows B or I only.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.operators.automaton import sentence_bounds
from newsflow.operators.tagging import split_sentences
from newsflow.operators.wordscan import Words, capitals, letter_runs, md5_heads, runs_of
from newsflow.session import materialize

OUTSIDE, FIRST, LATER, EDGE = 0, 1, 2, 3     # tags; EDGE is before and after a sentence
TAGS, SHAPES = 3, 8
HEX = 5                                      # digits of the MD5: 2 ** 20 buckets
CODES = 16 ** HEX * SHAPES + 1               # of words, and one for the end of a sentence
HELD = 1 << 19                               # rows of counts that a task keeps
KNOWN_BITS = 20                              # of the words whose codes a worker remembers: 12 MB
AT_ONCE = 1 << 12                            # sentences decoded at once
FEW = 8                                      # or one by one, where no more of them are as long
RARE = 5
SMOOTH = 0.5                                 # added to the counts of words
NEVER = 10 ** 9


@lru_cache(maxsize=100_000)
def word_code(word: str) -> int:
    """bucket * SHAPES + shape of a word inside a sentence."""
    shape = 3
    if word and not word.islower() and unicodedata.category(word[0]) == "Lu":
        shape = 0 if len(word) == 1 else 1 if all(unicodedata.category(c) == "Lu" for c in word) else 2
    return (int.from_bytes(hashlib.md5(word.encode(), usedforsecurity=False).digest()[:4]) >> 32 - 4 * HEX) * SHAPES + shape


def sentence_codes(words: pa.Array, bounds: np.ndarray) -> np.ndarray:
    """Each word of sentences (words ``bounds[k]`` to ``bounds[k + 1]``) as bucket * SHAPES +
    shape; different words are looked at once."""
    coded = words.dictionary_encode()
    if not len(coded):
        return np.empty(0, np.int64)
    out = np.fromiter(map(word_code, coded.dictionary.to_numpy(zero_copy_only=False)), np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
    out[bounds[:-1][np.diff(bounds) > 0]] += 4
    return out


class KnownCodes:
    """Codes of the words seen last, one for each value of the first ``KNOWN_BITS`` bits of their hashes."""

    def __init__(self):
        self.hash, self.code = np.zeros(1 << KNOWN_BITS, np.uint64), np.zeros(1 << KNOWN_BITS, np.int32)

    def of(self, words: Words) -> np.ndarray:
        """As :func:`sentence_codes`, of words found in the bytes."""
        h = words.hashes()
        slot = (h >> np.uint64(64 - KNOWN_BITS)).astype(np.int64)
        out = self.code[slot]
        missed = np.flatnonzero(self.hash[slot] != h)
        if len(missed):
            _, one, which = np.unique(h[missed], return_index=True, return_inverse=True)
            one = missed[one]
            bucket = md5_heads(words.data, words.start[one], words.end[one]) >> np.uint32(32 - 4 * HEX)
            code = (bucket * np.uint32(SHAPES)).astype(np.int32) + capitals(words, one).astype(np.int32)
            out[missed] = code[which]
            self.hash[slot[one]], self.code[slot[one]] = h[one], code
        out[words.bounds[:-1][np.diff(words.bounds) > 0]] += 4
        return out


@lru_cache(maxsize=1)
def known_codes() -> KnownCodes:
    return KnownCodes()


def codes(words: Column) -> Column:
    """The codes of a sentence's words."""
    def run(sentences: pa.Array) -> pa.Array:
        bounds = sentence_bounds(sentences)
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(sentence_codes(sentences.flatten(), bounds), pa.int32()))
    return F.arrow_udf(run, "array<int>")(words)


def tags(words: Column, spans: Column) -> Column:
    """The tags of a sentence's words, from the places of its names (in order,
    apart from each other)."""
    ends = F.transform(spans, lambda m: m["i"] + m["k"])
    parts = F.transform(spans, lambda m, j: F.concat(
        F.array_repeat(F.lit(OUTSIDE), m["i"] - F.coalesce(F.get(ends, j - 1), F.lit(0))),
        F.array(F.lit(FIRST)), F.array_repeat(F.lit(LATER), m["k"] - 1)))
    last = F.coalesce(F.get(ends, F.size(ends) - 1), F.lit(0))
    return F.concat(F.flatten(parts), F.array_repeat(F.lit(OUTSIDE), F.size(words) - last))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``step, code, n``: how often each step (tag before * 4 + tag) to a word (or its
    code) comes (code -1: to the end), summed over a task as far as ``HELD`` rows hold it."""
    def table(key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(key // CODES, pa.int32()), pa.array(key % CODES - 1, pa.int32()), pa.array(n, pa.int64())], ["step", "code", "n"])

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        key, which = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        n = np.zeros(len(key), np.int64)
        np.add.at(n, which, np.concatenate([n for _, n in parts]))
        return key, n

    parts, held, keys = [], 0, []
    for batch in batches:
        words, bounds = batch.column(0).flatten(), sentence_bounds(batch.column(0))
        code = words.to_numpy(zero_copy_only=False) if pa.types.is_integer(words.type) else sentence_codes(words, bounds)
        tag = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        before, (first, end) = np.r_[EDGE, tag[:-1]], (bounds[:-1], bounds[1:])
        before[first] = EDGE
        key = np.r_[(before * 4 + tag) * CODES + code + 1, (tag[end - 1] * 4 + EDGE) * CODES]
        keys.append(key)
        if sum(map(len, keys)) < HELD // 2:
            continue
        parts.append(np.unique(np.concatenate(keys), return_counts=True))
        keys = []
        held += len(parts[-1][0])
        if held > HELD:
            parts = [merged(parts)]
            held = len(parts[0][0])
            if held > HELD // 2:
                yield table(*parts[0])
                parts, held = [], 0
    if keys:
        parts.append(np.unique(np.concatenate(keys), return_counts=True))
    if parts:
        yield table(*merged(parts))


def tag_counts(tagged: DataFrame, words: str = "words", tag: str = "tags") -> DataFrame:
    """``before, tag, bucket, shape, n`` over sentences with an array of words (or of
    their codes) and one of as many tags. Rows with tag EDGE (bucket null) count the sentences' ends."""
    code = F.when(F.col("code") >= 0, F.col("code"))
    return (tagged.where(F.size(words) > 0).select(words, tag).mapInArrow(_summed, "step int, code int, n long")
            .groupBy("step", "code").agg(F.sum("n").alias("n"))
            .select(F.floor(F.col("step") / 4).cast("int").alias("before"), (F.col("step") % 4).alias("tag"),
                    F.floor(code / SHAPES).cast("int").alias("bucket"), (code % SHAPES).alias("shape"), "n"))


def cost(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.floor(-1000 * np.log(n / total) + 0.5).astype(np.int64)


@dataclass
class SequenceModel:
    """Integer costs: ``steps`` from tag (or EDGE) to tag (or EDGE), and of a
    symbol by tag: ``words`` for the buckets ``known`` (sorted), ``shapes``."""
    steps: np.ndarray
    known: np.ndarray
    words: np.ndarray
    shapes: np.ndarray

    @classmethod
    def learn(cls, tagged: DataFrame, words: str = "words", tag: str = "tags", rare: int = RARE) -> SequenceModel:
        counts = materialize(tag_counts(tagged, words, tag), "tag_counts")
        steps = np.zeros((TAGS + 1, TAGS + 1), np.int64)
        for r in counts.groupBy("before", "tag").agg(F.sum("n").alias("n")).collect():
            steps[r["before"], r["tag"]] = r["n"]
        by_tag = [F.sum(F.when(F.col("tag") == t, F.col("n")).otherwise(0)).alias(f"n{t}") for t in range(TAGS)]
        buckets = materialize(counts.where("bucket is not null").groupBy("bucket").agg(F.sum("n").alias("n"), *by_tag), "buckets")
        seldom = counts.join(buckets.where(F.col("n") < rare).select("bucket"), "bucket")
        some = np.zeros((SHAPES, TAGS), np.int64)
        for r in seldom.groupBy("shape").agg(*by_tag).collect():
            some[r["shape"]] = [r[f"n{t}"] for t in range(TAGS)]
        often = buckets.where(F.col("n") >= rare).drop("n").toArrow()      # at most a row for each bucket
        known = often.column("bucket").to_numpy()
        order = np.argsort(known)
        table = np.stack([often.column(f"n{t}").to_numpy() for t in range(TAGS)], axis=1)[order]
        of_tag = steps[:, :TAGS].sum(axis=0) + SMOOTH * (len(known) + SHAPES)
        return cls(step_costs(steps), known[order], cost(table + SMOOTH, of_tag), cost(some + SMOOTH, of_tag))

    @cached_property
    def symbols(self) -> tuple[np.ndarray, np.ndarray]:
        """The number of each bucket's symbol (0 for one that is not known), and the
        costs of the shapes and of the symbols, by tag."""
        number = np.zeros(16 ** HEX, np.int32)
        number[self.known] = SHAPES + np.arange(len(self.known))
        return number, np.concatenate([self.shapes, self.words]).astype(np.int32)

    def tags(self, code: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The tags of sentences' words, given as codes."""
        number, costs = self.symbols
        symbol = number[code // SHAPES]
        return cheapest_paths(costs, np.where(symbol > 0, symbol, code % SHAPES), bounds, self.steps)


def step_costs(n: np.ndarray) -> np.ndarray:
    """Costs of the steps from their counts, each one more than counted."""
    out = cost(n + 1.0, n.sum(axis=1, keepdims=True) + TAGS + 1.0)
    out[[OUTSIDE, EDGE], LATER] = NEVER
    return out


def cheapest(costs: np.ndarray, bounds: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The tags of the cheapest path through each sentence (words ``bounds[k]``
    to ``bounds[k + 1]``), with ``costs`` by word and tag."""
    return cheapest_paths(costs, np.arange(len(costs)), bounds, steps)


def cheapest_paths(costs: np.ndarray, symbol: np.ndarray, bounds: np.ndarray, steps: np.ndarray, few: int = FEW, at_once: int = AT_ONCE) -> np.ndarray:
    """:func:`cheapest` with ``costs`` by symbol and tag: ``at_once`` sentences of about one length after the others."""
    length, out = np.diff(bounds), np.zeros(len(symbol), np.int8)
    order = np.argsort(-length, kind="stable")
    for low in range(0, np.count_nonzero(length), at_once):
        some = order[low:low + at_once]
        _lay_paths(out, costs, symbol, bounds[some], length[some], steps, few)
    return out


def _lay_paths(out: np.ndarray, costs: np.ndarray, symbol: np.ndarray, start: np.ndarray, length: np.ndarray, steps: np.ndarray, few: int) -> None:
    """Paths of sentences, the longest first: position by position for all of them;
    where no more than ``few`` go on, these are followed one by one."""
    open_ = np.searchsorted(-length, -np.arange(length[0]), "left")       # at each position the open sentences are the first ones
    open_ = open_[:max(1, int(np.count_nonzero(open_ > few)))]
    begin = np.cumsum(open_) - open_                     # words by position: those at p from begin[p] on
    word = start[runs_of(np.zeros(len(open_), np.int64), open_)] + np.repeat(np.arange(len(open_)), open_)
    laid, back = np.take(costs, symbol[word], axis=0).T.astype(np.int64, order="C"), np.zeros((TAGS, len(word)), np.int8)
    total, ways = np.zeros((TAGS, len(length)), np.int64), steps[:TAGS, :TAGS, None]
    for p, (at, m) in enumerate(zip(begin.tolist(), open_.tolist(), strict=True)):
        now = total[:, :m]
        if p:
            way = now[:, None] + ways                    # tag before, tag, sentence
            later = (way[1] < way[0]).view(np.int8)
            least = np.minimum(way[0], way[1])
            last = (way[2] < least).view(np.int8)
            np.add(np.minimum(least, way[2]), laid[:, at:at + m], out=now)
            np.maximum(later, last + last, out=back[:, at:at + m])
        else:
            np.add(steps[EDGE, :TAGS, None], laid[:, :m], out=now)
    done = len(open_)
    tag = (total + steps[:TAGS, EDGE, None]).argmin(axis=0)
    for k in np.flatnonzero(length > done).tolist():
        low, high = int(start[k]) + done, int(start[k] + length[k])
        out[low:high], tag[k] = _followed(total[:, k].tolist(), costs[symbol[low:high]].tolist(), steps.tolist())
    path, flat = np.empty(len(word), np.int8), back.reshape(-1)
    for at, m in zip(begin[::-1].tolist(), open_[::-1].tolist(), strict=True):
        path[at:at + m] = tag[:m]
        tag[:m] = flat[tag[:m] * len(word) + np.arange(at, at + m)]
    out[word] = path


def _followed(total: list[int], costs: list[list[int]], steps: list[list[int]]) -> tuple[list[int], int]:
    """The rest of one sentence's tags, and the tag before it."""
    (aa, ab, ac, a_end), (ba, bb, bc, b_end), (ca, cb, cc, c_end), _ = steps
    a, b, c = total
    back = []
    for x, y, z in costs:
        i = j = k = 0
        to_a, to_b, to_c = a + aa, a + ab, a + ac
        if b + ba < to_a:
            to_a, i = b + ba, 1
        if c + ca < to_a:
            to_a, i = c + ca, 2
        if b + bb < to_b:
            to_b, j = b + bb, 1
        if c + cb < to_b:
            to_b, j = c + cb, 2
        if b + bc < to_c:
            to_c, k = b + bc, 1
        if c + cc < to_c:
            to_c, k = c + cc, 2
        a, b, c = to_a + x, to_b + y, to_c + z
        back.append((i, j, k))
    least = [a + a_end, b + b_end, c + c_end]
    tag = least.index(min(least))
    path = []
    for before in reversed(back):
        path.append(tag)
        tag = before[tag]
    return path[::-1], tag


def _decode(shared, runs: bytes):
    """The names in a text's sentences."""
    def run(texts: pa.Array) -> pa.Array:
        model, words = shared.value, Words(texts.flatten(), runs)
        found = model.tags(known_codes().of(words), words.bounds)
        first, no_later = np.flatnonzero(found == FIRST), np.r_[np.flatnonzero(found != LATER), len(found)]
        size = no_later[np.searchsorted(no_later, first, "right")] - first
        names = pa.ListArray.from_arrays(pa.array(np.searchsorted(first, words.bounds), pa.int32()), words.texts(first, size))
        n = np.cumsum(texts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        return pa.ListArray.from_arrays(pa.array(np.r_[0, n], pa.int32()), names, mask=texts.is_null())
    return run


class SequenceTagger:
    """N2 provider: sentences by rule, persons by the model."""

    name = "sequence"

    def __init__(self, model: SequenceModel, sentences=split_sentences):
        self.model, self.sentences = model, sentences

    def tag(self, df: DataFrame, text_col: str) -> DataFrame:
        spark = df.sparkSession
        decode = F.arrow_udf(_decode(spark.sparkContext.broadcast(self.model), letter_runs(spark)), "array<array<string>>")
        return df.withColumn("sents", self.sentences(F.col(text_col))).withColumn("persons", decode("sents"))


def _tagged(runs: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, spans = Words(batch.column(0).flatten(), runs), batch.column(1).flatten()
            per = spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            i, k = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in spans.flatten().flatten())
            tag, first = np.zeros(len(words.start), np.int8), np.repeat(words.bounds[:-1], per) + i
            tag[first] = FIRST
            tag[runs_of(first + 1, k - 1)] = LATER
            offsets = pa.array(words.bounds, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (known_codes().of(words), tag)], ["words", "tags"])
    return run


def tagged_sentences(found: DataFrame) -> DataFrame:
    """``words, tags``: a row for each sentence of texts with ``sents`` and ``_spans``, as
    :meth:`AutomatonTagger.spans` gives them; words are given as their codes."""
    return found.select("sents", "_spans").mapInArrow(
        _tagged(letter_runs(found.sparkSession)), "words array<int>, tags array<tinyint>")
