"""Person mentions with context.

Pipeline per article, all as array expressions on the article row, so the
plan has no Exchange between the scan and the two generators:

    text -> sents/persons (tagger) -> sentences with a person (P5)
         -> context of sentence i = strip(s[i-1]) + ' ' + strip(s[i]) + ' ' + strip(s[i+1]),
            clipped at the article ends, newlines removed (W1, T6)
         -> 512-character chunks (T8) -> one row per chunk (N6)

The neighbours are read from the full sentence array (blank sentences
included), exactly as the reference indexes its sentence list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions.text import CHUNK_LEN, chunks, drop_newlines, strip_ws
from newsflow.operators.tagging import RuleTagger


def context_window(sents: Column, i: Column) -> Column:
    """Sentences i-1..i+1 (0-based, clipped), each stripped, joined by ' '."""
    n = F.size(sents)
    lo = F.greatest(i - 1, F.lit(0))
    hi = F.least(i + 2, n)
    members = F.slice(sents, lo + 1, hi - lo)
    return drop_newlines(F.array_join(F.transform(members, strip_ws), " "))


def sentences_with_persons(tagged: DataFrame, keep: list[str]) -> DataFrame:
    """P5 + W1: one row per sentence that has a person.

    Output: keep..., sentence_no BIGINT, persons ARRAY<STRING>, context STRING.
    """
    hits = F.filter(
        F.transform("persons", lambda p, i: F.struct(i.alias("i"), p.alias("p"))),
        lambda h: F.size(h["p"]) > 0)
    with_ctx = F.transform(hits, lambda h: F.struct(
        h["i"].cast("bigint").alias("sentence_no"),
        h["p"].alias("persons"),
        context_window(F.col("sents"), h["i"]).alias("context")))
    return tagged.select(*keep, F.inline(with_ctx))


def explode_chunks(df: DataFrame, size: int = CHUNK_LEN) -> DataFrame:
    """T8 + N6: one row per context chunk, ``chunk_no`` from 0."""
    cols = [c for c in df.columns if c != "context"]
    return (df.select(*cols, F.posexplode(chunks(F.col("context"), size)).alias("chunk_no", "chunk"))
              .withColumn("chunk_no", F.col("chunk_no").cast("bigint")))


def person_context(articles: DataFrame, text_col: str = "art_content", keep: list[str] | None = None,
                   tagger=None, size: int = CHUNK_LEN) -> DataFrame:
    """Flagship N6: article rows -> (keep..., sentence_no, chunk_no, persons, chunk).

    ``persons`` stays an array here; ``persons_string`` gives the joined form (N3).
    """
    tagger = tagger or RuleTagger()
    keep = list(keep if keep is not None else [c for c in articles.columns if c != text_col])
    tagged = tagger.tag(articles.select(*keep, text_col), text_col)
    return explode_chunks(sentences_with_persons(tagged, keep), size)


def persons_string(persons: Column) -> Column:
    """N3 ``','.join(persons_in_sentence)``."""
    return F.array_join(persons, ",")
