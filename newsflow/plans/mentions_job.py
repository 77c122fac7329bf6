"""The mentions job: articles -> persons with context ->
sentiment -> encrypted Persons/Context/Sentiment + article metadata ->
appended table. One Catalyst plan; with the native providers it has no
Exchange at all (every step is a projection or a generator on the article row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.functions.crypto import encrypt_columns
from newsflow.operators.mentions import person_context, persons_string
from newsflow.operators.sentiment import add_sentiment
from newsflow.sinks.tables import append_mentions, append_once

MENTION_FIELDS = ("Persons", "Context", "Sentiment")


def mention_rows(articles: DataFrame, scorer, tagger=None, text_col: str = "art_content"):
    """(rows, rejects). Rows: clear-text mention rows: metadata (all article columns but the content,
    P3), sentence_no, chunk_no, Persons, Context, Sentiment. Rejects: chunks
    whose sentiment label is outside the star map (the reference raises on
    it); always returned, so no row is lost silently.
    """
    meta = [c for c in articles.columns if c != text_col]
    pc = person_context(articles, text_col=text_col, keep=meta, tagger=tagger)
    scored = add_sentiment(pc, scorer, "chunk")
    mention = {"Persons": persons_string(F.col("persons")), "Context": F.col("chunk"),
               "Sentiment": F.col("sentiment")}
    # On a name clash the article's value wins (dict.update order).
    cols = [*meta, "sentence_no", "chunk_no"] + [v.alias(k) for k, v in mention.items() if k not in meta]
    rows = scored.select(*cols)
    good = rows.filter(F.col("Sentiment").isNotNull()) if "Sentiment" not in meta else rows
    rejects = scored.filter(F.col("sentiment").isNull()).select(*meta, "sentence_no", "chunk_no",
                                                                F.lit("unknown sentiment label").alias("reason"))
    return good, rejects


def mentions_job(articles: DataFrame, key: str | bytes, scorer, out_path: str | None = None,
                 tagger=None, run_id: str | None = None):
    """Full job -> (encrypted mention documents, rejects); the documents are
    appended to ``out_path`` if given (K3), once for each ``run_id`` if given."""
    rows, rejects = mention_rows(articles, scorer, tagger)
    enc = encrypt_columns(rows, [c for c in MENTION_FIELDS if c in rows.columns], key)
    if out_path and run_id:
        append_once(enc, out_path, run_id)
    elif out_path:
        append_mentions(enc, out_path)
    return enc, rejects
