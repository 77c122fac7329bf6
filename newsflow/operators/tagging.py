"""Sentence segmentation and person tagging providers.

Every provider turns a text column into two aligned per-document arrays:

* ``sents``   ARRAY<STRING>          the sentence spans, in order (N1)
* ``persons`` ARRAY<ARRAY<STRING>>   the PERSON entities of each sentence,
                                     in text order, duplicates kept (N2, P6)

Keeping both per document (rather than one row per sentence) lets the
context window (W1) read neighbours by index with no shuffle.

Providers:

* :class:`RuleTagger` - native expressions only (whole-stage codegen).
* :class:`GazetteerTagger` - a name list that a plan can hold, matched leftmost-longest on
  word n-grams, native expressions only (no shuffle).
* :class:`GazetteerTableTagger` - the same matching for a name table of any
  size: exploded n-grams joined to the names (shuffles; no size limit).
* :class:`ModelTagger` - any NER model, run by ``mapInPandas`` and loaded once
  per Python worker (the reference reloads its model for every article).
"""

from __future__ import annotations

import hashlib
import pickle
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.functions.dates import bind
from newsflow.functions.text import WS_CLASS, WS_RE

# A sentence ends at . ! or ? followed by whitespace (rule segmentation).
# Java regex can look behind, so the Spark split is one pass; the portable
# form (mark the break, then split on the mark) is what the RE2 oracle uses.
SENT_SPLIT = "(?<=[.!?])" + WS_RE + "+"
SENT_BREAK_PORTABLE = "([.!?])" + WS_CLASS + "+"
# Two or more capitalised words separated by single spaces.
PERSON_RULE = r"\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)+"
WORD = r"\p{L}+"


def split_sentences(text: Column) -> Column:
    """N1 rule segmentation: ARRAY<STRING>, whitespace after the mark dropped."""
    return F.split(text, SENT_SPLIT)


def rule_persons(sentence: Column) -> Column:
    """N2 rule provider for one sentence: runs of >= 2 capitalised words."""
    return F.regexp_extract_all(sentence, F.lit(PERSON_RULE), 0)


class RuleTagger:
    name = "rule"

    def tag(self, df: DataFrame, text_col: str) -> DataFrame:
        sents = split_sentences(F.col(text_col))
        return (df.withColumn("sents", sents)
                  .withColumn("persons", F.transform("sents", rule_persons)))


def name_words(name: str) -> list[str]:
    """A listed name cut as the text is: runs of letters (``WORD``), so hyphens
    and apostrophes separate words on both sides."""
    return "".join(c if unicodedata.category(c).startswith("L") else " " for c in name).split()


class GazetteerTagger:
    """Known-name matching: leftmost-longest over word n-grams, up to the words
    of the longest name.

    ``names`` are compared in lower case. The list is compiled into the plan;
    :class:`GazetteerTableTagger` reads it from a table instead.
    """

    name = "gazetteer"

    def __init__(self, names: Iterable[str]):
        self.names = sorted({" ".join(w).lower() for n in names if n and (w := name_words(n))})
        self.max_words = max((len(n.split()) for n in self.names), default=1)

    def tokens_persons(self, words: Column) -> Column:
        """Names in one sentence (``t`` its words, ``l`` the same in lower case;
        a bound lambda variable, so both are evaluated once): longest match at
        each position, then a left-to-right fold over the matching positions
        only, skipping overlaps. Membership tests are ``isin`` over literals,
        which the optimizer turns into a hashed InSet."""
        names = list(self.names)
        first_words = sorted({x.split()[0] for x in names})
        toks, low = words["t"], words["l"]
        n = F.size(toks)

        def longest(i):
            out = F.lit(0)
            for k in range(1, self.max_words + 1):
                hit = (i + k <= n) & F.array_join(F.slice(low, i + 1, k), " ").isin(names)
                out = F.when(hit, F.lit(k)).otherwise(out)
            return out

        starts = F.filter(F.transform(low, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isin(first_words))
        cands = F.filter(F.transform(starts, lambda x: F.struct(x["i"].alias("i"), longest(x["i"]).alias("k"))),
                         lambda c: c["k"] > 0)
        start = F.struct(F.lit(0).alias("nxt"), F.array().cast("array<string>").alias("out"))

        def step(acc, c):
            return F.when(c["i"] >= acc["nxt"],
                          F.struct((c["i"] + c["k"]).alias("nxt"),
                                   F.array_append(acc["out"], F.array_join(F.slice(toks, c["i"] + 1, c["k"]), " ")).alias("out"))
                          ).otherwise(acc)

        return F.aggregate(cands, start, step, lambda acc: acc["out"])

    def tag(self, df: DataFrame, text_col: str) -> DataFrame:
        def persons(sentence):
            def both(t):
                return bind(F.struct(t.alias("t"), F.transform(t, F.lower).alias("l")), self.tokens_persons)
            return bind(F.regexp_extract_all(sentence, F.lit(WORD), 0), both)

        out = F.transform("sents", persons) if self.names else F.transform("sents", lambda s: F.array().cast("array<string>"))
        return df.withColumn("sents", split_sentences(F.col(text_col))).withColumn("persons", out)


def leftmost_longest(cands: Column) -> Column:
    """Fold candidate matches ``struct(i, rk, k, text)``, sorted by start ``i``
    and then longest first (``rk = max - k``), into the non-overlapping
    leftmost-longest list of texts."""
    start = F.struct(F.lit(0).cast("bigint").alias("nxt"), F.array().cast("array<string>").alias("out"))

    def step(acc, c):
        return F.when(c["i"] >= acc["nxt"],
                      F.struct((c["i"] + c["k"]).cast("bigint").alias("nxt"),
                               F.array_append(acc["out"], c["text"]).alias("out"))).otherwise(acc)
    return F.aggregate(cands, start, step, lambda acc: acc["out"])


class GazetteerTableTagger:
    """Gazetteer of any size, given as a DataFrame with a ``name`` column.

    Word n-grams, up to the words of the longest name, of every sentence are
    exploded and joined to the lower-cased names (Spark broadcasts them if its
    statistics allow, else adaptive execution splits the commonest n-grams);
    matches are folded leftmost-longest per sentence and
    attached back to the article by ``key_col``. Same result as
    :class:`GazetteerTagger`, without compiling the names into the plan.
    Costs three shuffles (names join, per-sentence fold, re-attach).
    """

    name = "gazetteer-table"

    def __init__(self, names: DataFrame, key_col: str = "doc_id"):
        words = F.regexp_extract_all(F.col("name"), F.lit(WORD), 0)
        self.names = names.select(F.lower(F.array_join(words, " ")).alias("g")).filter(F.col("g") != "").distinct()
        self.max_words = self.names.agg(F.max(F.size(F.split("g", " ")))).first()[0] or 1
        self.key_col = key_col

    def tag(self, df: DataFrame, text_col: str) -> DataFrame:
        key, K = self.key_col, self.max_words
        base = df.withColumn("sents", split_sentences(F.col(text_col)))
        words = base.select(key, F.posexplode(F.transform("sents", lambda s: F.regexp_extract_all(
            s, F.lit(WORD), 0))).alias("sentence_no", "toks")).filter(F.size("toks") > 0)

        def grams(toks):
            n = F.size(toks)
            per_pos = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.transform(
                F.filter(F.sequence(F.lit(1), F.lit(K)), lambda k: i + k <= n),
                lambda k: F.struct(i.cast("bigint").alias("i"), (F.lit(K) - k).cast("bigint").alias("rk"),
                                   k.cast("bigint").alias("k"),
                                   F.array_join(F.slice(toks, i + 1, k), " ").alias("text"))))
            return F.flatten(per_pos)
        # one row per n-gram, carrying only the n-gram (never the sentence array)
        g = (words.select(key, "sentence_no", F.explode(grams(F.col("toks"))).alias("c"))
                  .withColumn("g", F.lower(F.col("c.text"))))
        hits = g.join(self.names, "g", "left_semi")
        per_sentence = (hits.groupBy(key, "sentence_no")
                            .agg(leftmost_longest(F.array_sort(F.collect_list("c"))).alias("p")))
        per_doc = per_sentence.groupBy(key).agg(
            F.map_from_entries(F.collect_list(F.struct("sentence_no", "p"))).alias("_pm"))
        empty = F.array().cast("array<string>")
        return (base.join(per_doc, key, "left")
                    .withColumn("persons", F.transform("sents", lambda s, i: F.coalesce(
                        F.try_element_at(F.col("_pm"), i.cast("int")), empty)))
                    .drop("_pm"))


_MODELS: dict = {}


def worker_model(key, load: Callable):
    """Load a model at most once per Python worker process (workers are reused)."""
    from newsflow.operators import tagging as here  # module state lives in the worker
    fn = here._MODELS.get(key)
    if fn is None:
        fn = here._MODELS[key] = load()
    return fn


def model_key(load: Callable) -> bytes:
    """What tells two loaders apart: the pickled loader with all it closes
    over, so two that one factory made never share a cached model."""
    from pyspark import cloudpickle
    return hashlib.sha256(cloudpickle.dumps(load, protocol=pickle.HIGHEST_PROTOCOL)).digest()


PERSON = "PERSON"
ENTITIES = "array<array<struct<text:string,label:string,start:int>>>"


def entity_texts(entities: Column, label: str = PERSON) -> Column:
    """The texts of one sentence's entities with a label, in text order."""
    return F.transform(F.filter(entities, lambda e: e["label"] == label), lambda e: e["text"])


def with_persons(df: DataFrame, label: str = PERSON) -> DataFrame:
    """``entities`` (per sentence, any labels) -> ``persons``."""
    return df.withColumn("persons", F.transform("entities", lambda e: entity_texts(e, label)))


class RuleEntityTagger:
    """Entities of two kinds by rule, natively: PERSON as in :class:`RuleTagger`
    and CARDINAL for runs of digits, each with its start in the sentence."""

    name = "rule-entities"

    def __init__(self, label: str = PERSON):
        self.label = label

    @staticmethod
    def entities(sentence: Column) -> Column:
        found = F.regexp_extract_all(sentence, F.lit(f"{PERSON_RULE}|[0-9]+"), 0)

        def step(acc, text):     # the next match starts where its text is found next
            at = F.call_function("locate", text, sentence, acc["end"] + 1)
            label = F.when(text.rlike("^[0-9]"), F.lit("CARDINAL")).otherwise(F.lit(PERSON))
            e = F.struct(text.alias("text"), label.alias("label"), (at - 1).alias("start"))
            return F.struct((at - 1 + F.char_length(text)).alias("end"), F.array_append(acc["out"], e).alias("out"))

        none = F.array().cast("array<struct<text:string,label:string,start:int>>")
        return F.aggregate(found, F.struct(F.lit(0).alias("end"), none.alias("out")), step, lambda acc: acc["out"])

    def tag(self, df: DataFrame, text_col: str) -> DataFrame:
        df = df.withColumn("sents", split_sentences(F.col(text_col))).withColumn("entities", F.transform("sents", self.entities))
        return with_persons(df, self.label)


class ModelEntityTagger:
    """Plug-in for a model that labels its entities: ``load()`` returns a
    callable ``text -> (sentences, entities)`` with, per sentence, a list of
    (text, label, start). The label filter (P6) runs natively afterwards."""

    name = "model-entities"

    def __init__(self, load: Callable, label: str = PERSON):
        self.load, self.label = load, label

    def tag(self, df: DataFrame, text_col: str) -> DataFrame:
        load, key = self.load, model_key(self.load)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            fn = worker_model(key, load)
            for b in batches:
                res = [fn(t) if t is not None else ([], []) for t in b[text_col]]
                b = b.copy()
                b["sents"] = [list(r[0]) for r in res]
                b["entities"] = [[[{"text": e[0], "label": e[1], "start": int(e[2])} for e in s] for s in r[1]] for r in res]
                yield b

        schema = T.StructType(list(df.schema.fields) + [
            T.StructField("sents", T.ArrayType(T.StringType())), T.StructField("entities", T._parse_datatype_string(ENTITIES))])
        return with_persons(df.mapInPandas(run, schema), self.label)


class ModelTagger:
    """Plug-in for a real NER model.

    ``load`` is called once per Python worker process and must return a
    callable ``text -> (sentences, persons_per_sentence)``. Rows pass through
    ``mapInPandas`` whole, so no join (and no shuffle) is needed afterwards.
    """

    name = "model"

    def __init__(self, load: Callable[[], Callable[[str], tuple[list[str], list[list[str]]]]]):
        self.load = load

    def tag(self, df: DataFrame, text_col: str) -> DataFrame:
        load, key = self.load, model_key(self.load)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            fn = worker_model(key, load)
            for b in batches:
                res = [fn(t) if t is not None else ([], []) for t in b[text_col]]
                b = b.copy()
                b["sents"] = [list(r[0]) for r in res]
                b["persons"] = [[list(p) for p in r[1]] for r in res]
                yield b

        schema = T.StructType(list(df.schema.fields) + [
            T.StructField("sents", T.ArrayType(T.StringType())),
            T.StructField("persons", T.ArrayType(T.ArrayType(T.StringType())))])
        return df.mapInPandas(run, schema)
