"""Toxicity by nearest labelled examples.

Terms are words and short stems of words. Every document becomes a TF-IDF vector
over all terms that the labelled examples have (a term that no example has
changes no neighbour and no vote); document frequencies are counted over all
documents. All labelled examples, clean ones too, form an index in blocks of
alike examples, with the largest weight of each term in each block: blocks whose
upper bound is below the k-th neighbour of the most promising block are skipped,
their postings unread, which gives the exact k nearest by cosine. Neighbours vote
with their similarity; votes are calibrated on the examples themselves (each
without itself in the index), and the neighbours' ids are the evidence.

Examples are a bounded sample of the labelled rows outside the held-out fold, by
a hash of the id: at most ``EXAMPLES`` rows, half of them toxic as far as there
are as many, and at most ``POSTINGS`` different terms in all. In calibration an
example weighs as many rows of its label as it stands for. Terms are told apart
by 64-bit hashes. Text passes twice through Python: for the examples and
for all documents.

Defined results: null and empty texts, and texts without a term of an example,
have no neighbours; they get the rate of toxic rows among the examples without a
term, drawn to the rate of all examples by one row. Of equal neighbours the smaller id (as text) comes first. A label whose
document is missing, or a null label, is ignored; repeated documents are scored
one by one and count once as an example; where an id has several texts, the
smallest is the example; without labelled rows every score is
0.0; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import if_small
from newsflow.llm.decontaminate import folded
from newsflow.llm.labels import Isotonic, training_labels
from newsflow.session import materialize

EXAMPLES = 4_000      # labelled rows that the index is made of
POSTINGS = 4_000_000  # and their different terms, added up
STEMS = (4, 5)        # letters of a stem; stems catch inflected forms
K = 15
BLOCK = 512
DENSE = 2_048         # terms of most examples that are kept as dense columns
BATCH = 256           # documents searched at a time
CALIBRATORS = 12      # tasks that the examples' own votes are computed in
ROUNDING = 2e-4       # more than the error of single precision sums of DENSE terms
EVIDENCE = 5
PAIR = np.dtype([("number", np.int32), ("weight", np.float32)])
TOGETHER = 1 << 20    # characters of the texts whose words are counted together
SLICE = 1 << 15       # words hashed at a time
WIDTH = 32            # strings of fewer bytes are hashed as arrays
PRIMES = [np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]
KEPT = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)    # masks of the first n bytes


class Flat(NamedTuple):
    """Vectors one after the other: vector i has the terms and weights from
    ``start[i]`` to ``start[i + 1]``."""
    start: np.ndarray
    t: np.ndarray
    w: np.ndarray

    @classmethod
    def of(cls, vectors: list[dict[int, float]]) -> Flat:
        return cls(np.cumsum([0] + [len(v) for v in vectors]), np.array([t for v in vectors for t in v], np.int32),
                   np.array([w for v in vectors for w in v.values()], np.float32))


class BlockMaxIndex:
    """Unit vectors of the examples, in blocks of alike examples. Terms of many
    examples are dense columns; the others are postings by term and block. Both
    have each term's largest weight in each block, which bounds the block."""

    def __init__(self, vectors: list[dict[int, float]] | Flat, terms: int, block: int = BLOCK):
        start, t, w = vectors if isinstance(vectors, Flat) else Flat.of(vectors)
        self.n, self.block = len(start) - 1, block
        of = np.repeat(np.arange(self.n, dtype=np.int32), np.diff(start))
        rows = np.bincount(t, minlength=terms)
        common = np.argsort(-rows, kind="stable")[:DENSE]
        column = np.full(terms, -1, np.int32)
        column[common[rows[common] > 0]] = np.arange((rows[common] > 0).sum())
        col = column[t]
        dense = np.zeros((self.n, min(DENSE, terms)), np.float32)
        dense[of[col >= 0], col[col >= 0]] = w[col >= 0]
        self.rank = self._alike(dense)
        place = np.empty(self.n, np.int32)
        place[self.rank] = np.arange(self.n, dtype=np.int32)
        self.dense = dense[self.rank]
        del dense
        self.blocks = -(-self.n // block)
        self.top = np.stack([self.dense[b * block:(b + 1) * block].max(axis=0) for b in range(self.blocks)])
        rare = np.flatnonzero(col < 0)      # most frequent terms first, as queries mostly read these
        rare = rare[np.lexsort((place[of[rare]], t[rare], -rows[t[rare]]))]
        self.postings = self._pairs(place[of[rare]], w[rare])
        # an entry for each term and block: its block and largest weight, and its first posting
        of_term, of_block = t[rare], place[of[rare]] // block
        first = np.flatnonzero(np.r_[True, (of_term[1:] != of_term[:-1]) | (of_block[1:] != of_block[:-1])]) if len(rare) else rare
        self.posting = np.r_[first, len(rare)]
        self.entries = self._pairs(of_block[first], np.maximum.reduceat(w[rare], first) if len(rare) else w[rare])
        # for each term together: dense column or -1, first entry, entries, first posting, postings
        self.table = np.zeros((terms, 5), np.int32)
        self.table[:, 0] = column
        for j, x in (1, of_term[first]), (3, of_term):
            at = np.flatnonzero(np.diff(x, prepend=-1))
            self.table[x[at], j], self.table[x[at], j + 1] = at, np.diff(at, append=len(x))

    @staticmethod
    def _pairs(number: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Numbers and weights side by side, to be read together by ``_read``."""
        pairs = np.empty(len(number), PAIR)
        pairs["number"], pairs["weight"] = number, weight
        return pairs.view(np.int64)

    @staticmethod
    def _read(pairs: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = pairs.take(at).view(PAIR)
        return found["number"].astype(np.int64), found["weight"]

    @staticmethod
    def _alike(dense: np.ndarray, groups: int = 16, rounds: int = 4) -> np.ndarray:
        """An order of the examples in which alike ones are next to each other."""
        centres = dense[np.linspace(0, len(dense) - 1, min(groups, len(dense))).astype(int)]
        for _ in range(rounds):
            near = (dense @ centres.T).argmax(axis=1)
            sums = np.stack([dense[near == g].sum(axis=0) for g in range(len(centres))])
            centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
        return np.argsort(near, kind="stable")

    @staticmethod
    def _ranges(low: np.ndarray, size: np.ndarray) -> np.ndarray:
        """All numbers of the ranges that start at ``low``, one after the other."""
        low, size = low[size > 0], size[size > 0]
        flat = np.ones(size.sum(), np.int64)
        flat[:1] = low[:1]
        flat[np.cumsum(size[:-1])] = low[1:] - low[:-1] - size[:-1] + 1
        return np.cumsum(flat, out=flat)

    def search_many(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int] | None = None) -> list[list[tuple[float, int]]]:
        """For each query (terms, weights) the k examples of largest cosine
        above 0: (cosine, example), ties by example number."""
        m, step = len(queries), self.block
        q = np.zeros((m, self.dense.shape[1]), np.float32)
        score = np.zeros((m, self.n), np.float32)     # what the dense columns add
        bound, parts = np.zeros((m, self.blocks)), []
        for i, (t, w) in enumerate(queries):
            part = self.table.take(t, axis=0).T
            is_rare = part[0] < 0
            common, rare = np.flatnonzero(~is_rare), np.flatnonzero(is_rare)
            columns = part[0, common]
            q[i, columns] = w[common]
            _, low, size, *postings = part[:, rare]
            block, most = self._read(self.entries, self._ranges(low, size))
            bound[i] = np.bincount(block, most * np.repeat(w[rare], size), minlength=self.blocks)
            parts.append((common, columns, rare, low, size, *postings))
        bound += q @ self.top.T
        best = bound.argmax(axis=1)

        def visit(wanted: np.ndarray) -> None:
            for b in np.flatnonzero(wanted.any(axis=0)):
                who, rows = np.flatnonzero(wanted[:, b]), self.dense[b * step:(b + 1) * step]
                if 2 * len(who) > m:      # dearer to pick than to do all
                    who = slice(None)
                score[who, b * step:b * step + len(rows)] = q[who] @ rows.T

        keep = k + (without is not None)
        done = np.arange(self.blocks) == best[:, None]
        visit(done)
        least = np.zeros(m, np.float32)       # no weight is negative: the k-th best of a query's best block is no less
        for i, b in enumerate(best):
            found = score[i, b * step:(b + 1) * step]
            if len(found) >= keep:
                least[i] = np.partition(found, len(found) - keep)[len(found) - keep]
        more = ~done & (bound >= least[:, None] - ROUNDING) & (bound > 0)
        visit(more)
        done |= more
        return [self._nearest(w, score[i], done[i], parts[i], k, keep, None if without is None else without[i]) for i, (_, w) in enumerate(queries)]

    def _nearest(self, w: np.ndarray, score: np.ndarray, done: np.ndarray, part: tuple[np.ndarray, ...], k: int, keep: int, without: int | None) -> list[tuple[float, int]]:
        """The k nearest in the blocks that are ``done``, of which ``score`` has
        the dense part."""
        common, columns, rare, entry, entries, low, size = part
        if not done.all():      # else all postings of a term, which lie together
            e = self._ranges(entry, entries)
            here = done[self._read(self.entries, e)[0]]
            e, rare = e[here], np.repeat(rare, entries)[here]
            low, size = self.posting[e], self.posting[e + 1] - self.posting[e]
            score = np.where(np.repeat(done, self.block)[:self.n], score, 0)
        at, adds = self._read(self.postings, self._ranges(low, size))
        adds = adds * np.repeat(w[rare], size)
        rest = np.bincount(at, adds, minlength=self.n)
        s = score + rest
        edge = np.partition(s, self.n - keep)[self.n - keep] if self.n > keep else 0.0
        near = np.flatnonzero((s >= edge - ROUNDING) & (s > 0))
        # the candidates' cosines in double precision, each summed in the same order, so that equal examples tie
        exact = rest[near] + np.concatenate([(self.dense[near[j:j + BLOCK, None], columns] * w[common]).sum(axis=1) for j in range(0, len(near), BLOCK)] or [[]])
        order = sorted((-x, n) for x, n in zip(exact.tolist(), self.rank[near].tolist(), strict=True) if x > 0 and n != without)
        return [(-x, n) for x, n in order[:k]]

    def search(self, query: dict[int, float], k: int, without: int | None = None) -> list[tuple[float, int]]:
        pair = (np.fromiter(query, np.int64, len(query)), np.fromiter(query.values(), float, len(query)))
        return self.search_many([pair], k, None if without is None else [without])[0]


class Model:
    """``bags``: for each example its term numbers and counts. Only these travel;
    each Python worker builds the index from them once."""

    def __init__(self, idf: np.ndarray, ids: list[str], labels: list[int], bags: list[tuple[np.ndarray, np.ndarray]], base: float):
        self.idf, self.base, self.built = idf.astype(np.float32), base, None
        order = sorted(range(len(ids)), key=lambda i: (ids[i], i))
        self.ids, self.labels = [ids[i] for i in order], np.array([labels[i] for i in order], float)
        self.edges = np.cumsum([0] + [len(bags[i][0]) for i in order])
        self.t = np.concatenate([bags[i][0] for i in order] + [np.empty(0, np.int32)]).astype(np.int32)
        self.counts = np.concatenate([bags[i][1] for i in order] + [np.empty(0, np.int32)]).astype(np.int32)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "built": None}

    def examples(self, lo: int, hi: int) -> list[tuple[np.ndarray, np.ndarray]]:
        e = self.edges
        return [self.vector(self.t[e[i]:e[i + 1]], self.counts[e[i]:e[i + 1]]) for i in range(lo, hi)]

    @property
    def index(self) -> BlockMaxIndex:
        if self.built is None:
            w = (1 + np.log(self.counts.astype(np.float32))) * self.idf[self.t]
            norm = np.sqrt(np.add.reduceat(w.astype(float) ** 2, self.edges[:-1]))
            w /= np.repeat(norm, np.diff(self.edges)).astype(np.float32)
            self.built = BlockMaxIndex(Flat(self.edges, self.t, w), len(self.idf))
        return self.built

    def own_votes(self, lo: int, hi: int) -> list[tuple[float | None, float]]:
        """Vote and label of examples, each without itself in the index."""
        found = self.index.search_many(self.examples(lo, hi), K, list(range(lo, hi)))
        return [(self.vote(near)[0], y) for near, y in zip(found, self.labels[lo:hi], strict=True)]

    def vector(self, t: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = (1 + np.log(n)) * self.idf.take(t)
        return t, (w / np.sqrt(w @ w) if len(w) else w)

    def vote(self, near: list[tuple[float, int]]) -> tuple[float | None, list[str]]:
        if not near:
            return None, []
        sim = np.array([s for s, _ in near])
        return float(sim @ self.labels[[i for _, i in near]] / sim.sum()), [self.ids[i] for _, i in near[:EVIDENCE]]

    def score_many(self, bags: list[tuple[np.ndarray, np.ndarray]], calibrated: Isotonic | None) -> list[tuple[float, list[str]]]:
        if calibrated is None:
            return [(self.base, [])] * len(bags)
        out = []
        for at in range(0, len(bags), BATCH):
            votes = [self.vote(near) for near in self.index.search_many([self.vector(*b) for b in bags[at:at + BATCH]], K)]
            scores = calibrated(np.array([0.0 if v is None else v for v, _ in votes]))
            out += [(self.base if v is None else float(s), ids) for (v, ids), s in zip(votes, scores, strict=True)]
        return out


def rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def short_hashes(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """xxh64 of many strings of fewer than WIDTH bytes at once: the first
    ``sizes`` bytes of each row."""
    p1, p2, p3, p4, p5 = PRIMES
    words = rows.view("<u8").T & KEPT[np.clip(sizes - 8 * np.arange(WIDTH // 8)[:, None], 0, 8)]
    h = p5 + sizes.astype(np.uint64)
    for j in range(WIDTH // 8 - 1):
        long = np.flatnonzero(sizes >= 8 * j + 8)
        h[long] = rotated(h[long] ^ (rotated(words[j, long] * p2, 31) * p1), 27) * p1 + p4
    tail, left = words[sizes // 8, np.arange(len(sizes))], sizes % 8
    h = np.where(left >= 4, rotated(h ^ ((tail & np.uint64(0xFFFFFFFF)) * p1), 23) * p2 + p3, h)
    tail = np.where(left >= 4, tail >> np.uint64(32), tail)
    for j in range(3):
        h = np.where(left % 4 > j, rotated(h ^ (((tail >> np.uint64(8 * j)) & np.uint64(0xFF)) * p5), 11) * p1, h)
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return h ^ (h >> np.uint64(32))


def word_numbers(blob: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of a blob, which goes on for WIDTH bytes
    after the last."""
    rows = np.lib.stride_tricks.sliding_window_view(blob, WIDTH)
    out = np.empty(len(starts), np.uint64)
    for lo in range(0, len(starts), SLICE):
        s, n = starts[lo:lo + SLICE], sizes[lo:lo + SLICE]
        out[lo:lo + SLICE] = short_hashes(rows[s], np.minimum(n, WIDTH - 1))
    for i in np.flatnonzero(sizes >= WIDTH):
        out[i] = xxhash.xxh64_intdigest(blob[starts[i]:starts[i] + sizes[i]].tobytes())
    return out


def stem_numbers(rows: np.ndarray, sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length of STEMS: which words (the first bytes of each, spaces
    behind the end) have more letters, and the hashes of these stems with a `*`."""
    letters = np.cumsum((rows & 0xC0) != 0x80, axis=1, dtype=np.int8)
    out = []
    for k in STEMS:
        size = (letters <= k).sum(axis=1)
        who = np.flatnonzero(size < sizes)
        stems, size = rows[who], size[who]
        stems[np.arange(len(who)), size] = ord("*")
        out.append((who, short_hashes(stems, size + 1)))
    return out


def counted_together(texts: list[str | None], terms: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its terms and their counts, all texts at once: the words
    are cut and hashed as arrays, and each different word is looked up once."""
    parts = [folded(t.lower()) if t else b"" for t in texts]
    blob = np.frombuffer(b" ".join([b"", *parts, b" " * WIDTH]), np.uint8)
    edges = np.flatnonzero(np.diff(blob != ord(" "))) + 1
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    text = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, np.cumsum([0] + [len(p) + 1 for p in parts]))))
    word, different = pd.factorize(word_numbers(blob, starts, sizes))
    first = np.empty(len(different), np.int64)
    first[word[::-1]] = np.arange(len(word))[::-1]
    stems = stem_numbers(np.lib.stride_tricks.sliding_window_view(blob, WIDTH)[starts[first]], sizes[first])
    of, found = pd.factorize(np.concatenate([different, *(h for _, h in stems)]))
    order = np.argsort(found)
    known = found[order] if terms is None else terms
    at = np.minimum(np.searchsorted(known, found[order]), max(len(known) - 1, 0))
    number = np.empty(len(found), np.int64)
    number[order] = np.where(known[at] == found[order], at, -1) if len(known) else -1
    of = number[of]
    numbers = np.full((1 + len(STEMS), len(different)), -1)
    numbers[0], lo = of[:len(different)], len(different)
    for row, (who, _) in zip(numbers[1:], stems, strict=True):
        row[who] = of[lo:lo + len(who)]
        lo += len(who)
    size = max(len(known), 1)
    keys = numbers.take(word, axis=1)
    left = keys >= 0
    keys += text * size
    keys = keys[left]
    keys.sort()
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    counts = np.diff(first, append=len(keys)).astype(np.int32)
    keys = keys[first]
    ends = np.searchsorted(keys, np.arange(len(texts) + 1) * size)
    for i, (lo, hi) in enumerate(pairwise(ends)):
        t = keys[lo:hi] - i * size
        yield known[t] if terms is None else t, counts[lo:hi]


def counted(texts: Iterable[str | None], terms: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its terms and their counts, by term. Terms are 64-bit
    hashes or, given some sorted hashes, places among these, others left out."""
    some, size = [], 0
    for t in texts:
        some.append(t)
        size += len(t) if t else 0
        if size >= TOGETHER:
            yield from counted_together(some, terms)
            some, size = [], 0
    if some:
        yield from counted_together(some, terms)


def sampled(labels: DataFrame, label: str, examples: int) -> tuple[DataFrame, dict[int, float]]:
    """At most ``examples`` labelled rows, half of each label as far as there
    are as many, and how many rows each one stands for, by label."""
    train = materialize(training_labels(labels, label), "labelled")
    there = {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic = min(there.get(1, 0), max(examples // 2, examples - there.get(0, 0)))
    take = {1: toxic, 0: min(there.get(0, 0), examples - toxic)}
    some = [train.where(F.col("y") == y).orderBy(F.xxhash64("lid"), "lid").limit(n) for y, n in take.items()]
    return materialize(some[0].union(some[1]), "examples"), {y: there.get(y, 0) / max(n, 1) for y, n in take.items()}


def score_documents(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", examples: int = EXAMPLES,
                    postings: int = POSTINGS) -> DataFrame:
    """``id, score, evidence``: one row per document."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    chosen, weight = sampled(labels, label, examples)

    def bag(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(h.tobytes(), n.tobytes()) for h, n in counted(texts)], columns=["h", "n"])

    # a bounded number of examples and terms: these are numbered on the driver
    known = materialize(docs.join(if_small(chosen), F.col("id") == F.col("lid")).groupBy("lid", "y").agg(F.min("text").alias("text"))
                        .select(F.xxhash64("lid").alias("o"), F.col("lid").cast("string").alias("id"), "y", F.pandas_udf(bag, "h binary, n binary")("text").alias("c"))
                        .select("o", "id", "y", "c.*"), "example_terms")
    room, last = postings, None
    for r in known.select("o", "id", (F.octet_length("n") / 4).cast("long").alias("terms")).orderBy("o", "id").toLocalIterator():
        room -= r["terms"]
        if room < 0:
            break
        last = r["o"]
    if room < 0:
        known = known.where(F.col("o") <= F.lit(last)) if last is not None else known.where("false")
    known = known.orderBy("o", "id").toArrow()
    ids, labelled = known.column("id").to_pylist(), known.column("y").to_pylist()

    def arrays(name: str, kind: type) -> list[np.ndarray]:
        return [np.frombuffer(b.as_py(), kind) for b in known.column(name)]

    hashes, counts = arrays("h", np.uint64), arrays("n", np.int32)
    del known
    terms = np.unique(np.concatenate([*hashes, np.empty(0, np.uint64)]))
    numbers = [np.searchsorted(terms, h).astype(np.int32) for h in hashes]
    del hashes
    number = spark.sparkContext.broadcast(terms)

    def count_terms(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for some in texts:
            yield pd.DataFrame([(t.astype(np.int32), n) for t, n in counted(some, number.value)], columns=["t", "n"])

    bags = materialize(docs.select("id", F.pandas_udf(count_terms, "t array<int>, n array<int>")("text").alias("c")).select("id", "c.*"), "bags")
    total = bags.count()
    found = bags.select(F.explode("t").alias("t")).groupBy("t").count().toArrow()
    idf = np.ones(max(len(terms), 1))
    idf[found.column("t").to_numpy()] = np.log((1 + total) / (1 + found.column("count").to_numpy())) + 1

    some = [i for i, t in enumerate(numbers) if len(t)]
    rows = [weight[y] for y in labelled]
    blank = [i for i, t in enumerate(numbers) if not len(t)]
    rate = sum(w * y for w, y in zip(rows, labelled, strict=True)) / sum(rows) if ids else 0.0
    base = (sum(rows[i] * labelled[i] for i in blank) + rate) / (sum(rows[i] for i in blank) + 1)
    model = spark.sparkContext.broadcast(Model(idf, [ids[i] for i in some], [labelled[i] for i in some], [(numbers[i], counts[i]) for i in some], base))

    def own_votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in b["id"]:
                yield pd.DataFrame(model.value.own_votes(lo, min(lo + BATCH, len(some))), columns=["v", "y"]).astype(float)

    votes = spark.range(0, len(some), BATCH, numPartitions=min(CALIBRATORS, -(-len(some) // BATCH))).mapInPandas(own_votes, "v double, y double").collect() if some else []
    seen = [(r["v"], r["y"]) for r in votes if r["v"] is not None and not np.isnan(r["v"])]
    calibrated = Isotonic([v for v, _ in seen], [y * weight[int(y)] for _, y in seen], [weight[int(y)] for _, y in seen]) if seen else None

    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for t, n in batches:
            yield pd.DataFrame(model.value.score_many(list(zip(t, n, strict=True)), calibrated), columns=["score", "evidence"])

    return bags.select("id", F.pandas_udf(score, "score double, evidence array<string>")("t", "n").alias("s")).select("id", "s.*")
