"""Name tagging with a token automaton.

The names become one trie over words with failure links (Aho-Corasick), held in
flat sorted arrays. A sentence is read once, word by word: a transition is
followed while a name may still grow, else the failure link leads to the longest
suffix that may; every name that ends at a word is reported, and the reports are
folded leftmost-longest. No n-gram is built and no text is shuffled.

The automaton is broadcast, so its size is checked first. Names of more words in
all than ``max_words`` are told by hashes (:class:`DealtNames`): a bitmap of at most
``2 ** MAX_BITS`` bits tells on the map side which places of a text may hold a name.
Up to ``MAX_LISTED`` names are broadcast as 96 bits each, and those places looked up
there, without a shuffle. More names are not gathered but dealt: the places are joined
to them, and what is found is joined back to the texts. All give the same rows.

Defined results: null texts have no sentences; names are compared in lower case
by their words (runs of letters); null names and names without a word match
nothing; repeated names count once; persons keep the text's spelling.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.operators.tagging import WORD, split_sentences
from newsflow.operators.wordscan import Words, letter_runs, string_hashes
from newsflow.session import materialize

MAX_WORDS = 2_000_000     # words of all names: about 100 MB of arrays
MAX_BITS = 29             # of the dealt form's bitmap: 64 MB; a fuller one lets more places pass, all of them checked
MAX_LISTED = 2 ** 23      # names of which each hash is gathered: 96 MB
_REMEMBERED = 1_000_000   # transitions a Python worker remembers


class TokenAutomaton:
    """Flat arrays: ``words`` (sorted hashes), ``keys`` (state * words + word,
    sorted) with ``child``, and by state ``fail``, ``length`` (words of the name
    that ends here, else 0) and ``out`` (next state by failure links at which a
    shorter name ends, else 0). State 0 is the root."""

    def __init__(self, names: list[list[str]]):
        names = sorted({tuple(n) for n in names if n})
        flat = string_hashes(pa.array([w for n in names for w in n], pa.string()))
        size = np.array([len(n) for n in names], np.int64)
        first = np.cumsum(size) - size
        self.words = np.unique(flat)
        word = np.searchsorted(self.words, flat)
        v = max(1, len(self.words))
        at = np.zeros(len(names), np.int64)            # each name's state so far
        keys, child, depth, fail = [], [], [np.zeros(1, np.int32)], [np.zeros(1, np.int64)]
        n = 1
        for d in range(int(size.max(initial=0))):
            longer = np.flatnonzero(size > d)
            edge, which = np.unique(at[longer] * v + word[first[longer] + d], return_inverse=True)
            at[longer] = n + which
            keys.append(edge)
            child.append(n + np.arange(len(edge)))
            depth.append(np.full(len(edge), d + 1, np.int32))
            n += len(edge)
        self.keys, self.child = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (keys, child))
        order = np.argsort(self.keys)
        level_keys = keys
        self.keys, self.child = self.keys[order], self.child[order]
        depth = np.concatenate(depth)
        self.fail = np.zeros(n, np.int64)
        self.length = np.zeros(n, np.int32)
        self.length[at] = size
        self.length[0] = 0
        self.out = np.zeros(n, np.int64)
        done = 1
        for d, edge in enumerate(level_keys):           # by depth: failure links lead upwards
            state, w = done + np.arange(len(edge)), edge % v
            if d:
                back, open_ = self.fail[edge // v], np.arange(len(edge))
                while len(open_):
                    to = self.go(back[open_], w[open_])
                    hit = to >= 0
                    self.fail[state[open_[hit]]] = to[hit]
                    open_ = open_[~hit & (back[open_] > 0)]
                    back[open_] = self.fail[back[open_]]
            f = self.fail[state]
            self.out[state] = np.where(self.length[f] > 0, f, self.out[f])
            done += len(edge)

    def go(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The child by a word for each state; -1 without one."""
        if not len(self.keys):
            return np.full(len(state), -1)
        key = state * len(self.words) + word
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[i] == key) & (word >= 0), self.child[i], -1)

    def child_of(self, state: int, word: int) -> int:
        """:meth:`go` for one state and word."""
        key = state * len(self.words) + word
        i = int(self.keys.searchsorted(key))
        return int(self.child[i]) if i < len(self.keys) and self.keys[i] == key else -1

    def word_ids(self, words: list[str]) -> np.ndarray:
        """Numbers of the words; -1 for those in no name."""
        return self.ids_of(string_hashes(pa.array(words, pa.string())))

    def ids_of(self, h: np.ndarray) -> np.ndarray:
        """The same, from the words' hashes."""
        if not len(self.words):
            return np.full(len(h), -1)
        different, which = np.unique(h, return_inverse=True)
        i = np.minimum(np.searchsorted(self.words, different), len(self.words) - 1)
        return np.where(self.words[i] == different, i, -1)[which]


class Matcher:
    """An automaton at work in a Python worker, with the transitions used so far."""

    def __init__(self, automaton: TokenAutomaton):
        self.a = automaton
        self.seen: dict[tuple[int, int], int] = {}

    def step(self, state: int, word: int) -> int:
        """The state after ``word``: by a transition, or by failure links to one."""
        a, key = self.a, (state, word)
        to = self.seen.get(key)
        if to is None:
            s = state
            while (to := a.child_of(s, word)) < 0 and s:
                s = int(a.fail[s])
            if len(self.seen) >= _REMEMBERED:
                self.seen.clear()
            to = self.seen[key] = max(to, 0)
        return to

    def spans(self, ids: np.ndarray, bounds: np.ndarray) -> list[list[tuple[int, int]]]:
        """For each sentence (words ``bounds[k]`` to ``bounds[k + 1]``) the names
        in it, leftmost-longest, as (first word, words)."""
        a = self.a
        starts = np.flatnonzero(a.go(np.zeros(len(ids), np.int64), ids) > 0)
        cut = np.searchsorted(starts, bounds)
        out = []
        for k in range(len(bounds) - 1):
            low, high = int(bounds[k]), int(bounds[k + 1])
            mine, m, found, state, i = starts[cut[k]:cut[k + 1]].tolist(), 0, {}, 0, low
            while True:
                if not state:                            # on to the next word that begins a name
                    while m < len(mine) and mine[m] < i:
                        m += 1
                    if m == len(mine):
                        break
                    i = mine[m]
                if i >= high:
                    break
                word = int(ids[i])
                state = self.step(state, word) if word >= 0 else 0
                o = state if a.length[state] else int(a.out[state])
                while o:
                    n = int(a.length[o])
                    found[i - n + 1] = max(found.get(i - n + 1, 0), n)
                    o = int(a.out[o])
                i += 1
            kept, end = [], low
            for at in sorted(found):
                if at >= end:
                    kept.append((at - low, found[at]))
                    end = at + found[at]
            out.append(kept)
        return out


SPANS = "array<array<struct<i:int,k:int>>>"


def sentence_bounds(sentences: pa.Array) -> np.ndarray:
    """Where each list of words starts among all words, and the end."""
    sizes = np.array([len(s) for s in sentences], np.int64) if sentences.null_count else np.diff(sentences.offsets.to_numpy())
    return np.r_[0, np.cumsum(sizes)]


def span_lists(texts: pa.Array, per: np.ndarray, i: list[int], k: list[int]) -> pa.Array:
    """Spans (first word, words) in text order as ``SPANS``: ``per`` of them in
    each sentence of ``texts``."""
    pairs = pa.StructArray.from_arrays([pa.array(i, pa.int32()), pa.array(k, pa.int32())], names=["i", "k"])
    inner = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(per)], pa.int32()), pairs)
    counts = texts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), inner)


def span_texts(words: str, spans: str) -> Column:
    """The texts of each sentence's spans."""
    return F.transform(words, lambda t, s: F.transform(
        F.element_at(spans, s + 1), lambda m: F.array_join(F.slice(t, m["i"] + 1, m["k"]), " ")))


def _match(shared, runs: bytes):
    made: list[Matcher] = []

    def run(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(Matcher(shared.value))
        matcher, words = made[0], Words(texts.flatten(), runs)
        found = matcher.spans(matcher.a.ids_of(words.lower_hashes()), words.bounds)
        flat = [x for f in found for x in f]
        return span_lists(texts, np.array([len(f) for f in found], np.int64), [i for i, _ in flat], [k for _, k in flat])
    return run


def gram_hashes(words: np.ndarray, at: np.ndarray, k: int, odd: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A hash of the ``k`` words from each place on, from the words' hashes."""
    out = np.full(len(at), k, np.uint64)
    for j in range(k):
        out *= np.uint64(odd)
        out += words[at + j]
    out ^= out >> np.uint64(32)
    return out


def gram_checks(words: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """32 bits of another hash."""
    return (gram_hashes(words, at, k, 0xD6E8FEB86659FD93) >> np.uint64(32)).astype(np.uint32)


def bit_pair(h: np.ndarray, n_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a hash in a bitmap of ``2 ** n_bits``."""
    mask = np.uint64(2 ** n_bits - 1)
    return (h & mask).astype(np.int64), (h >> np.uint64(64 - n_bits)).astype(np.int64)


def _name_hashes(names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words, size = string_hashes(names.flatten()), names.value_lengths().to_numpy(zero_copy_only=False)
    first, out, check = np.cumsum(size) - size, np.empty(len(size), np.uint64), np.empty(len(size), np.uint32)
    for k in np.unique(size).tolist():
        mine = np.flatnonzero(size == k)
        out[mine], check[mine] = gram_hashes(words, first[mine], k), gram_checks(words, first[mine], k)
    return out, check


def _name_bits(n_bits: int):
    def run(names: pa.Array) -> pa.Array:
        bits = np.stack(bit_pair(_name_hashes(names)[0], n_bits), axis=1)
        return pa.ListArray.from_arrays(pa.array(2 * np.arange(len(bits) + 1), pa.int32()), pa.array(bits.ravel()))
    return run


def _hashed_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each batch of names: their hashes and checks, as bytes."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in _name_hashes(batch.column(0))], ["hash", "check"])


def places(words: np.ndarray, bounds: np.ndarray, listed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sentence, word and number of words where the names' hashes, or without them
    their bitmap, hold the hash, from the hashes of the words in lower case."""
    bitmap, n_bits, sizes, hashes, checks = listed
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(words))      # words to the sentence's end
    found, lengths = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for k in sizes:
        at = np.flatnonzero(left >= k)
        h = gram_hashes(words, at, k)
        for bit in (0, 1):
            place = bit_pair(h, n_bits)[bit]
            held = np.flatnonzero(bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1)
            at, h = at[held], h[held]
        if hashes is not None:
            i = np.searchsorted(hashes, h)
            held = np.flatnonzero(i < len(hashes))
            held = held[hashes[i[held]] == h[held]]
            at = at[held[checks[i[held]] == gram_checks(words, at[held], k)]]
        found.append(at)
        lengths.append(np.full(len(found[-1]), k))
    at, k = np.concatenate(found), np.concatenate(lengths)
    order = np.argsort(at, kind="stable")
    at, k = at[order], k[order]
    return np.searchsorted(bounds, at, "right") - 1, at, k


def _may_be_names(shared):
    """Places of a text's sentences, given as lists of words, that may be names."""
    def run(tokens: pa.Array) -> pa.Array:
        sentences = tokens.flatten()
        bounds = sentence_bounds(sentences)
        sentence, at, k = places(string_hashes(sentences.flatten()), bounds, shared.value)
        return span_lists(tokens, np.bincount(sentence, minlength=len(bounds) - 1), at - bounds[sentence], k)
    return run


def _places(shared, runs: bytes):
    """From texts' ids and sentences: the places that may be names, with their text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.columns
            words = Words(texts.flatten(), runs)
            sentence, at, k = places(words.lower_hashes(), words.bounds, shared.value)
            first = np.r_[0, np.cumsum(texts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]
            text = np.searchsorted(first, sentence, "right") - 1
            ints = [pa.array(x, pa.int32()) for x in (sentence - first[text], at - words.bounds[sentence], k)]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(text)), *ints, words.texts(at, k)], ["_text_id", "s", "i", "k", "text"])
    return run


def _listed_names(shared, runs: bytes):
    """The names in a text's sentences, told by their hashes."""
    def run(texts: pa.Array) -> pa.Array:
        words = Words(texts.flatten(), runs)
        sentence, at, k = places(words.lower_hashes(), words.bounds, shared.value)
        kept = apart(at, k)
        sentence, at, k = sentence[kept], at[kept], k[kept]
        return span_lists(texts, np.bincount(sentence, minlength=len(words.bounds) - 1), at - words.bounds[sentence], k)
    return run


def apart(at: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Which of the names found (first word, words) are left, in text order: leftmost-longest."""
    order = np.lexsort((k, at))
    order = order[np.r_[at[order][1:] != at[order][:-1], np.ones(min(len(at), 1), bool)]]      # the longest from each place
    first, end = at[order], at[order] + k[order]
    kept = np.r_[np.ones(min(len(order), 1), bool), first[1:] >= np.maximum.accumulate(end)[:-1]]
    last = 0
    for n in np.flatnonzero(~kept).tolist():             # in the way of one before, if that is left
        last = end[n - 1] if kept[n - 1] else last
        if first[n] >= last:
            kept[n], last = True, end[n]
    return order[kept]


def _leftmost_longest(found: pa.Array, sentences: pa.Array) -> pa.Array:
    """The names found in a text (sentence, first word, words) as ``SPANS``."""
    counts = np.maximum(sentences.to_numpy(zero_copy_only=False), 0)
    per = found.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    s, i, k = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in found.flatten().flatten())
    s += np.repeat(np.cumsum(counts) - counts, per)                            # among all sentences
    kept = apart(s << 32 | i, k)
    pairs = pa.StructArray.from_arrays([pa.array(i[kept], pa.int32()), pa.array(k[kept], pa.int32())], names=["i", "k"])
    inner = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.bincount(s[kept], minlength=int(counts.sum())))], pa.int32()), pairs)
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), inner)


class DealtNames:
    """Names that are too many for an automaton, in a table with their words ``w``
    in lower case. Two names count as one, or other words as a name, by a chance of
    ``2 ** -64`` and ``2 ** -96`` a pair; more than ``max_listed`` names by none. There
    texts are told apart by their MD5, so keys may repeat."""

    def __init__(self, listed: DataFrame, max_bits: int = MAX_BITS, max_listed: int = MAX_LISTED):
        sizes = {r["k"]: r["n"] for r in listed.groupBy(F.size("w").alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}
        n_bits = max(15, min(max_bits, (16 * sum(sizes.values())).bit_length()))
        self.names = listed.select(F.array_join("w", " ").alias("_name"))
        self.listed = sum(sizes.values()) <= max_listed
        hashes, checks = self._gathered(listed, sum(sizes.values())) if self.listed else (None, None)
        bitmap = np.zeros((2 ** (n_bits - 15), 2 ** 12), np.uint8)
        if self.listed:
            for bit in bit_pair(hashes, n_bits):
                np.bitwise_or.at(bitmap.reshape(-1), bit >> 3, np.uint8(1) << (bit & 7).astype(np.uint8))
        else:
            bits = (listed.select(F.explode(F.arrow_udf(_name_bits(n_bits), "array<bigint>")("w")).alias("bit"))
                    .select(F.shiftright("bit", 15).alias("part"), F.col("bit").bitwiseAND(2 ** 15 - 1).alias("bit"))
                    .repartition("part").groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")))
            for r in bits.toLocalIterator():
                bitmap[r["part"]] = np.frombuffer(r["bits"], np.uint8)
        self.shared = listed.sparkSession.sparkContext.broadcast((bitmap.ravel(), n_bits, sorted(sizes), hashes, checks))

    @staticmethod
    def _gathered(listed: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The names' hashes, sorted, and their checks."""
        hashes, checks, done = np.empty(n, np.uint64), np.empty(n, np.uint32), 0
        for r in listed.mapInArrow(_hashed_names, "hash binary, check binary").toLocalIterator():
            some = np.frombuffer(r["hash"], np.uint64)
            hashes[done:done + len(some)], checks[done:done + len(some)] = some, np.frombuffer(r["check"], np.uint32)
            done += len(some)
        order = np.argsort(hashes)
        return hashes[order], checks[order]

    def spans(self, df: DataFrame, text_col: str) -> DataFrame:
        """``df`` with ``sents``, ``_toks`` and ``_spans``."""
        if self.listed:
            found = F.arrow_udf(_listed_names(self.shared, letter_runs(df.sparkSession)), SPANS)
            return with_words(df, text_col).withColumn("_spans", found("sents"))
        text_id = F.md5(F.col(text_col).cast("binary"))
        maybe = _places(self.shared, letter_runs(df.sparkSession))
        found = (df.select(text_id.alias("_text_id"), split_sentences(F.col(text_col)).alias("sents"))
                 .mapInArrow(maybe, "_text_id string, s int, i int, k int, text string")
                 .select("_text_id", "s", "i", "k", F.lower("text").alias("_name"))
                 .join(self.names, "_name", "left_semi")
                 .groupBy("_text_id").agg(F.collect_set(F.struct("s", "i", "k")).alias("_found")))
        joined = df.withColumn("_text_id", text_id).join(found, "_text_id", "left")
        fold = F.arrow_udf(_leftmost_longest, SPANS)
        return (with_words(joined, text_col).withColumn("_spans", fold("_found", F.coalesce(F.size("sents"), F.lit(0))))
                .drop("_text_id", "_found"))


def with_words(df: DataFrame, text_col: str) -> DataFrame:
    return (df.withColumn("sents", split_sentences(F.col(text_col)))
            .withColumn("_toks", F.transform("sents", lambda s: F.regexp_extract_all(s, F.lit(WORD), 0))))


class AutomatonTagger:
    """Gazetteer given as a DataFrame with a ``name`` column. ``key_col`` is not
    needed any more; it stays for callers that name it."""

    name = "gazetteer-automaton"

    def __init__(self, names: DataFrame, key_col: str = "doc_id", max_words: int = MAX_WORDS, max_listed: int = MAX_LISTED):
        words = F.transform(F.regexp_extract_all(F.col("name"), F.lit(WORD), 0), F.lower)
        listed = materialize(names.where("name is not null").select(words.alias("w")).where(F.size("w") > 0).distinct(), "names")
        total = listed.agg(F.sum(F.size("w"))).first()[0] or 0
        self.dealt = DealtNames(listed, max_listed=max_listed) if total > max_words else None
        if not self.dealt:
            automaton = TokenAutomaton([r["w"] for r in listed.toLocalIterator()])
            self.shared = names.sparkSession.sparkContext.broadcast(automaton)

    def spans(self, df: DataFrame, text_col: str) -> DataFrame:
        """``df`` with ``sents``, their words ``_toks`` and the names' places
        ``_spans``."""
        if self.dealt:
            return self.dealt.spans(df, text_col)
        match = F.arrow_udf(_match(self.shared, letter_runs(df.sparkSession)), SPANS)
        return with_words(df, text_col).withColumn("_spans", match("sents"))

    def tag(self, df: DataFrame, text_col: str) -> DataFrame:
        return self.spans(df, text_col).withColumn("persons", span_texts("_toks", "_spans")).drop("_toks", "_spans")
