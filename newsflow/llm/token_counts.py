"""Token counts by a map-side two-tier lookup.

A text's tokens are the tokens of its pre-tokens, so a count needs lengths of
pre-tokens only. Tier one is a hash table of frequent pre-tokens and their
lengths, broadcast once; its size is a parameter. Tier two encodes the rest
through a cache that each Python worker keeps, bounded as well. Pre-tokens are
never shuffled. The table and the caches only save work: any pre-token has the
same length with or without them.

Texts that the fast splitter could see differently from the library (special
token strings, or characters beyond Latin letters) are encoded whole by the
library itself.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows
are counted one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import fresh

TABLE_WORDS = 50_000      # entries of the broadcast table
TABLE_DOCS = 1_000        # documents that the table's pre-tokens are taken from,
TABLE_BYTES = 65_536      # each of at most so many bytes: 64 MB in all
CACHE_WORDS = 300_000     # pre-tokens that a worker remembers
MAX_TOKENS = 2048

# The split pattern of the vocabulary file, after its normaliser
# has turned all white space into single spaces.
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^ \p{L}\p{N}]+")
PLAIN = re.compile("[^\x00-ɏ]")


class Counting:
    """Counts tokens in one Python worker; made once per worker and file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.cache: dict[str, int] = {}

    def pretokens(self, text: str) -> list[str] | None:
        """None: only the library splits this text for sure as it does."""
        if any(s in text for s in self.special):
            return None
        norm = self.tok.normalizer.normalize_str(text)
        return None if PLAIN.search(norm) else PRETOKEN.findall(norm)

    def lengths(self, words: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tok.encode_batch(words, add_special_tokens=False)]

    def count(self, texts: list[str], table: dict[str, int]) -> list[int]:
        out, open_, missing = [0] * len(texts), [], set()
        for i, text in enumerate(texts):
            if not text:
                continue
            words = self.pretokens(text)
            if words is None:
                out[i] = len(self.tok.encode(text, add_special_tokens=False).ids)
                continue
            rest = [w for w in words if w not in table]
            out[i] = sum(map(table.get, [w for w in words if w in table]))
            if rest:
                open_.append((i, rest))
                missing.update(w for w in rest if w not in self.cache)
        if missing:
            if len(self.cache) + len(missing) > CACHE_WORDS:
                self.cache.clear()
                missing = {w for _, rest in open_ for w in rest}
            missing = list(missing)
            self.cache.update(zip(missing, self.lengths(missing), strict=True))
        for i, rest in open_:
            out[i] += sum(map(self.cache.__getitem__, rest))
        return out


_COUNTING: dict[str, Counting] = {}


def counting(path: str) -> Counting:
    if path not in _COUNTING:
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # Spark runs the tasks side by side
        _COUNTING[path] = Counting(path)
    return _COUNTING[path]


def frequent_lengths(docs: DataFrame, tokenizer: str, text: str = "text",
                     words: int = TABLE_WORDS, sample: int = TABLE_DOCS) -> dict[str, int]:
    """The hash table of tier one. It decides how many look-ups miss, never a
    count, so a bounded number of documents is enough to fill it. ``take``
    reads as few partitions as it needs and shuffles nothing."""
    c, seen = counting(tokenizer), Counter()
    for r in docs.select(F.col(text).alias("t")).where(F.octet_length("t").between(1, TABLE_BYTES)).take(sample):
        seen.update(c.pretokens(r["t"]) or ())
    best = [w for w, n in seen.most_common(words) if n > 1]
    return dict(zip(best, c.lengths(best), strict=True)) if best else {}


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text", out: str = "tokens",
                 table: dict[str, int] | None = None) -> DataFrame:
    """``docs`` with the struct column ``out``: ``n_bytes`` and ``n_tokens``."""
    spark = docs.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_lengths(docs, tokenizer, text) if table is None else table)

    @F.pandas_udf("long")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c, lengths = counting(tokenizer), frequent.value
        for texts in batches:
            yield pd.Series(c.count(texts.tolist(), lengths), dtype="int64")

    n = fresh(docs, "_n")
    return (docs.withColumn(n, n_tokens(F.col(text)))
            .withColumn(out, F.struct(F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"),
                                      F.col(n).alias("n_tokens"))).drop(n))
