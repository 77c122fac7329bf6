"""Sentence borders with abbreviations learnt from the texts.

A full stop ends a sentence unless the word before it is an abbreviation. Which
words are is not listed but counted (Kiss and Strunk, "Unsupervised Multilingual
Sentence Boundary Detection", 2006):

* A word is an abbreviation if it stands before a full stop far more often than
  words do on average: a log-likelihood ratio, scaled up for short words and
  inner full stops and down for each occurrence without one. A single capital
  letter (an initial) always counts as one.
* After an abbreviation a sentence may still end. It does if the next word is
  capitalised and either starts sentences far more often than by chance (log-
  likelihood against the sure borders), or is known in lower case, is never
  capitalised inside a sentence, and makes no collocation with the abbreviation
  (log-likelihood of the pair).

All counts come from one aggregation over the words with their neighbours, with
map-side sums, so a frequent word costs one row a task. Borders are then decided
row by row in the JVM from two sets compiled into the plan; sets beyond
``MAX_LITERALS`` are joined to the doubtful borders instead, which moves a few
words of each, not the texts.

Defined results: null texts have no sentences (null); without a mark a text is
one sentence; white space after a border is dropped, that inside a sentence
stays; numbers are words in lower case; an empty corpus has no abbreviations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions.dates import bind
from newsflow.functions.text import WS_RE
from newsflow.session import materialize

# --- fixed values: thresholds published with the method -----------------------------
ABBREVIATION, COLLOCATION, STARTER = 0.3, 7.88, 30.0
# ------------------------------------------------------------------------------------
DOTTED = 0.99             # how often an abbreviation has its full stop
MAX_LITERALS = 20_000

WORD_RE = r"[\p{L}\p{N}]+(?:\.[\p{L}\p{N}]+)*"
TOKEN_RE = WORD_RE + "[.!?]?"
BEFORE = rf"({WORD_RE})\.$"
NEXT = rf"^(?:{WS_RE})*([\p{{L}}\p{{N}}]+)"
PIECES = rf"(?<=[.!?])(?={WS_RE})"


def _capital(word: Column) -> Column:
    return word.rlike(r"^\p{Lu}")


def word_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """``a, b, n, dots, lower, inside, capital``. Rows with ``b`` null are words:
    occurrences, those before a full stop, in lower case, and capitalised inside
    a sentence. The others are pairs around a mark (``a`` empty after ``!`` or
    ``?``): occurrences, and those with ``b`` capitalised."""
    zero = F.lit(0)

    def row(a, b, n, dots=zero, lower=zero, inside=zero, capital=zero):
        flags = {"n": n, "dots": dots, "lower": lower, "inside": inside, "capital": capital}
        return F.struct(a.alias("a"), b.alias("b"), *[v.cast("int").alias(k) for k, v in flags.items()])

    def parts(tokens):
        return F.transform(tokens, lambda t: F.struct(
            F.lower(F.regexp_replace(t, "[.!?]$", "")).alias("w"), F.regexp_extract(t, "[.!?]$", 0).alias("mark"), _capital(t).alias("cap")))

    def rows(tokens):
        def of(t, i):
            before, after = F.get(tokens, i - 1), F.get(tokens, i + 1)
            word = row(t["w"], F.lit(None).cast("string"), F.lit(1), t["mark"] == ".", ~t["cap"], t["cap"] & F.coalesce(before["mark"] == "", F.lit(False)))
            pair = row(F.when(t["mark"] == ".", t["w"]).otherwise(""), after["w"], F.lit(1), capital=after["cap"])
            return F.when((t["mark"] != "") & after["w"].isNotNull(), F.array(word, pair)).otherwise(F.array(word))
        return F.flatten(F.transform(tokens, of))

    found = texts.select(F.regexp_extract_all(F.col(text), F.lit(TOKEN_RE), 0).alias("t")).select(bind(F.col("t"), lambda t: bind(parts(t), rows)).alias("r"))
    names = ("n", "dots", "lower", "inside", "capital")
    return found.select(F.inline("r")).groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in names])


def _likelihood(k: Column, n: Column, p: Column) -> Column:
    """Logarithm of p^k (1 - p)^(n - k), with 0 log 0 = 0."""
    return F.when(k > 0, k * F.ln(p)).otherwise(0.0) + F.when(n - k > 0, (n - k) * F.ln(1 - p)).otherwise(0.0)


def association(both: Column, first: Column, second: Column, total: Column) -> Column:
    """Dunning's log-likelihood ratio of ``second`` after ``first``; 0 where it
    is no more frequent there than elsewhere."""
    both, first, second, total = (c.cast("double") for c in (both, first, second, total))
    p, p1, p2 = second / total, both / first, (second - both) / F.greatest(total - first, F.lit(1.0))
    ratio = 2 * (_likelihood(both, first, p1) + _likelihood(second - both, total - first, p2)
                 - _likelihood(both, first, p) - _likelihood(second - both, total - first, p))
    return F.when(p1 > p, ratio).otherwise(0.0)


def abbreviations(counts: DataFrame) -> DataFrame:
    """``a``: the words that are abbreviations."""
    words = counts.where("b is null and n > 0")
    all_ = words.agg(F.sum("n").cast("double").alias("total"), F.sum("dots").cast("double").alias("all_dots"))
    plain, dots = (F.col("n") - F.col("dots")).cast("double"), F.col("dots").cast("double")
    letters = F.char_length(F.replace("a", F.lit("."), F.lit(""))).cast("double")
    inner = F.char_length("a") - letters + 1
    rate = F.col("all_dots") / F.col("total")
    ratio = 2 * (_likelihood(dots, F.col("n").cast("double"), F.lit(DOTTED)) - _likelihood(dots, F.col("n").cast("double"), rate))
    score = ratio * F.exp(-letters) * inner * F.pow(letters, -plain)
    return (words.where("dots > 0").crossJoin(F.broadcast(all_)).where("all_dots < total").where(score >= ABBREVIATION).select("a"))


def borders_after(counts: DataFrame, abbreviated: DataFrame) -> DataFrame:
    """``a, b``: pairs of an abbreviation (or an initial) and the capitalised
    word after it between which a sentence ends."""
    words = counts.where("b is null").select(F.col("a").alias("w"), "n", "dots", "lower", "inside")
    pairs = counts.where("b is not null")
    known = abbreviated.select(F.col("a").alias("k"))
    marked = pairs.join(known, F.col("a") == F.col("k"), "left").withColumn("doubtful", F.col("k").isNotNull() | (F.char_length("a") == 1)).drop("k")
    starts = marked.where("not doubtful").groupBy(F.col("b").alias("s")).agg(F.sum("n").alias("starts"))
    totals = (marked.agg(F.coalesce(F.sum(F.when(~F.col("doubtful"), F.col("n"))), F.lit(0)).alias("sure"))
              .crossJoin(words.agg(F.sum("n").alias("total"))))
    open_ = marked.where("doubtful and capital > 0").select("a", "b", F.col("n").alias("pair"))
    told = (open_.join(words.select(F.col("w").alias("wa"), F.col("dots").alias("a_dots")), F.col("a") == F.col("wa"))
            .join(words, F.col("b") == F.col("w"))
            .join(starts, F.col("b") == F.col("s"), "left").crossJoin(F.broadcast(totals)))
    collocation = association(F.col("pair"), F.col("a_dots"), F.col("n"), F.col("total")) >= COLLOCATION
    starter = (F.col("sure") > 0) & (association(F.coalesce("starts", F.lit(0)), F.greatest("sure", F.lit(1)), F.col("n"), F.col("total")) >= STARTER)
    return told.where(starter | (~collocation & (F.col("lower") > 0) & (F.col("inside") == 0))).select("a", "b")


@dataclass
class Borders:
    """What was learnt: tables of abbreviations (``a``) and of pairs (``a, b``)
    that a border parts."""
    abbreviated: DataFrame
    parted: DataFrame
    max_literals: int = MAX_LITERALS

    @classmethod
    def learn(cls, texts: DataFrame, text: str = "text", max_literals: int = MAX_LITERALS) -> Borders:
        counts = materialize(word_counts(texts, text), "word_counts")
        abbreviated = materialize(abbreviations(counts), "abbreviations")
        return cls(abbreviated, materialize(borders_after(counts, abbreviated), "parted_pairs"), max_literals)

    def split(self, df: DataFrame, text: str = "text", out: str = "sents", key: str = "doc_id") -> DataFrame:
        """``df`` with the array column ``out``, the sentences of ``text``.
        ``key`` is a unique column, needed only beyond ``max_literals``."""
        small = max(self.abbreviated.count(), self.parted.count()) <= self.max_literals
        pieces = F.split(F.col(text), PIECES)
        if small:
            known = [r["a"] for r in self.abbreviated.toLocalIterator()]
            pairs = [f"{r['a']} {r['b']}" for r in self.parted.toLocalIterator()]
            return df.withColumn(out, bind(pieces, lambda ps: merged(ps, lambda p, q, i: joined(p, q, known, pairs))))
        doubts = (df.select(key, F.posexplode(F.transform(pieces, lambda p: p)).alias("i", "p"))
                  .select(key, "i", F.regexp_extract("p", BEFORE, 1).alias("w"), F.regexp_extract("p", NEXT, 1).alias("first")))
        # the pair of a border: the last word of a piece and the first of the next
        before = doubts.where("w <> ''").select(key, (F.col("i") + 1).alias("i"), F.lower("w").alias("a"), (F.col("w").rlike(r"^\p{Lu}$")).alias("initial"))
        after = doubts.select(key, "i", F.lower("first").alias("b"), _capital(F.col("first")).alias("cap"))
        known, parted = self.abbreviated.withColumn("known", F.lit(True)), self.parted.withColumn("parted", F.lit(True))
        held = (before.join(after, [key, "i"]).join(known, "a", "left").where("known or initial").join(parted, ["a", "b"], "left")
                .where("not (cap and coalesce(parted, false))").groupBy(F.col(key).alias("_key")).agg(F.collect_set("i").alias("_held")))
        whole = df.join(held, F.col(key) == F.col("_key"), "left").drop("_key")
        none = F.array().cast("array<int>")
        return whole.withColumn(out, bind(pieces, lambda ps: merged(ps, lambda p, q, i: F.array_contains(F.coalesce("_held", none), i.cast("int"))))).drop("_held")


def joined(piece: Column, following: Column, known: list[str], pairs: list[str]) -> Column:
    """Whether no sentence ends between two pieces."""
    def told(w):
        doubtful = F.lower(w).isin(known) | w.rlike(r"^\p{Lu}$") if known else w.rlike(r"^\p{Lu}$")
        first = F.regexp_extract(following, NEXT, 1)
        ends = _capital(first) & F.concat_ws(" ", F.lower(w), F.lower(first)).isin(pairs) if pairs else F.lit(False)
        return (w != "") & doubtful & ~ends
    return bind(F.regexp_extract(piece, BEFORE, 1), told)


def merged(pieces: Column, hold) -> Column:
    """Sentences of the pieces: piece i goes on with the one before where
    ``hold(before, piece, i)``; white space at a border is dropped."""
    n = F.size(pieces)

    def sentences(starts):
        def whole(at, k):
            end = F.coalesce(F.get(starts, k + 1), n)
            text = F.array_join(F.slice(pieces, at + 1, end - at), "")
            return F.when(at == 0, text).otherwise(F.regexp_replace(text, f"^(?:{WS_RE})+", ""))
        return F.transform(starts, whole)

    firsts = F.transform(pieces, lambda p, i: F.when((i > 0) & hold(F.get(pieces, i - 1), p, i), F.lit(None)).otherwise(i))
    return F.when(pieces.isNotNull(), bind(F.array_compact(firsts), sentences))


class LearnedTagger:
    """N1 by learnt borders, then any provider's person rule on each sentence."""

    name = "learned-borders"

    def __init__(self, borders: Borders, persons, key_col: str = "doc_id"):
        self.borders, self.persons, self.key_col = borders, persons, key_col

    def tag(self, df: DataFrame, text_col: str) -> DataFrame:
        return self.borders.split(df, text_col, "sents", self.key_col).withColumn("persons", F.transform("sents", self.persons))
