"""Benchmark decontamination by a prefix-filtered set join.

Every benchmark item gives windows of 10 words (one shorter window if it has
fewer). A window is a set of positioned 5-word shingles (one shingle of its
whole length if it has fewer words). Shingles are ordered by rarity, counted
over all documents; since a window must be contained whole, its necessary
prefix is its single rarest shingle. Documents are joined on those prefix
shingles only. A shingle found at word p that stands at offset o in the window
fixes the start p - o; starts before the text and ends beyond it are cut
(positional and length bounds), and the words around the hit are then compared
with the window's words one by one (exact containment).

The benchmark's shingles reach the tasks as a sorted array of 64-bit hashes.
Its size is bounded: a larger benchmark is dealt into slices of at most
``SLICE`` shingles, one pass over the documents for each.

Defined results: null and empty texts have no words, no hits and no items;
items without a word have no windows; equal items (repeated rows, shared
windows) all count as items, by their distinct ids; items with a null id mark
words but are not counted; rarity ties go to the smaller hash; repeated
documents are judged one by one; an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import if_small, window_hashes, word_hashes
from newsflow.session import materialize

WINDOW = 10
SHINGLE = 5
SLICE = 4_000_000   # 64-bit hashes broadcast at a time: 32 MB

# A-Z to a-z; ASCII other than letters and digits to spaces; the rest stays.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def folded(text: str) -> bytes:
    """The text in UTF-8 with its words in lower case and spaces between them."""
    return text.encode().translate(_FOLD)


def words_of(text: str | None) -> list[bytes]:
    return folded(text).split() if text else []


def item_windows(words: list[bytes]) -> list[list[bytes]]:
    if len(words) <= WINDOW:
        return [words] if words else []
    return [words[i:i + WINDOW] for i in range(len(words) - WINDOW + 1)]


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each shingle of each window."""
    for b in batches:
        out = []
        for item, text in zip(b["item"], b["text"], strict=True):
            for w in item_windows(words_of(text)):
                size = min(SHINGLE, len(w))
                key = b" ".join(w).decode()
                for o, h in enumerate(window_hashes(word_hashes(w), size).view(np.int64).tolist()):
                    out.append((item, key, len(w), size, o, h))
        yield pd.DataFrame(out, columns=["item", "win", "len", "size", "off", "h"]).astype({"len": "int32", "size": "int32", "off": "int32", "h": "int64"})


class Lookup:
    """The sorted shingle hashes of a slice, by shingle size."""

    def __init__(self, rows: list[tuple[int, int]]):
        self.by_size = {s: np.sort(np.array([h for k, h in rows if k == s], np.int64)) for s in {k for k, _ in rows}}

    def hits(self, words: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each size: positions in the text, and the hashes found there."""
        h = word_hashes(words)
        for size, known in self.by_size.items():
            found = window_hashes(h, size).view(np.int64)
            at = np.searchsorted(known, found)
            at[at == len(known)] = 0
            pos = np.flatnonzero(known[at] == found)
            yield size, pos, found[pos]


def rarity(texts: DataFrame, lookup) -> DataFrame:
    """``h, n``: occurrences of the benchmark's shingles in all documents."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, int] = {}
        for b in batches:
            for t in b["text"]:
                for _, _, found in lookup.value.hits(words_of(t)):
                    for h in found.tolist():
                        total[h] = total.get(h, 0) + 1
        yield pd.DataFrame({"h": list(total), "n": list(total.values())}, dtype="int64")

    return texts.select("text").mapInPandas(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def prefix_hits(lookup):
    """A column function: a text's ``n_words`` and, in parallel arrays, its
    prefix hits: hash, position, and the words within reach of a window around
    it (from word ``lo`` on)."""
    def find(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            words, h, p, lo, near = words_of(t), [], [], [], []
            for size, pos, found in lookup.value.hits(words):
                h += found.tolist()
                p += pos.tolist()
                first = np.maximum(0, pos - WINDOW + size).tolist()
                lo += first
                near += [b" ".join(words[x:y + WINDOW]).decode() for x, y in zip(first, pos.tolist(), strict=True)]
            out.append((len(words), h, p, lo, near))
        return pd.DataFrame(out, columns=["n_words", "h", "pos", "lo", "near"])

    return F.pandas_udf(find, "n_words long, h array<long>, pos array<int>, lo array<int>, near array<string>")


def contaminated_words(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text",
                       item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``row, id, text_hash, n_words, n_hit, items, spans``: per document the number of
    its words inside an occurrence of a benchmark window, the sorted ids (as
    strings) of the items found, and the sorted (start, length) of the windows."""
    spark = docs.sparkSession
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    shingles = materialize(benchmark.select(F.col(item).cast("string").alias("item"), F.col(item_text).alias("text"))
                           .mapInPandas(_windows, "item string, win string, len int, size int, off int, h long"), "item_shingles")
    keys = materialize(shingles.select("size", "h").distinct(), "item_keys")
    slices = max(1, -(-keys.count() // SLICE))

    if slices > 1:   # several passes must agree on the row numbers
        texts = materialize(texts, "texts")

    def lookup(rows: DataFrame, part: int):
        rows = rows.where(F.pmod("h", F.lit(slices)) == part)
        return spark.sparkContext.broadcast(Lookup([(r["size"], r["h"]) for r in rows.toLocalIterator()]))

    counted = None
    for part in range(slices):
        n = rarity(texts, lookup(keys, part))
        counted = n if counted is None else counted.union(n)
    counted = materialize(counted, "rarity")

    # the rarest shingle of each window, at its first offset; unseen windows cannot occur
    prefixes = materialize(shingles.join(counted, "h").groupBy("win", "len", "size")
                           .agg(F.min(F.struct("n", "h", "off")).alias("s")).select("win", "len", "size", "s.h", "s.off"), "prefixes")
    used = materialize(prefixes.select("size", "h").distinct(), "prefix_keys")

    found = base = None
    for part in range(slices):
        c = materialize(texts.select("row", "id", "text_hash", prefix_hits(lookup(used, part))("text").alias("c")).select("row", "id", "text_hash", "c.*"), "candidates")
        base = c.select("row", "id", "text_hash", "n_words") if base is None else base
        hits = c.where(F.size("h") > 0).select("row", "n_words", F.inline(F.arrays_zip("h", "pos", "lo", "near")))
        found = hits if found is None else found.union(hits)

    start = F.col("pos") - F.col("off")
    exact = (found.join(if_small(prefixes.drop("size").withColumnRenamed("h", "ph")), F.col("h") == F.col("ph"))
             .where((start >= 0) & (start + F.col("len") <= F.col("n_words")))
             .where(F.array_join(F.slice(F.split("near", " "), start - F.col("lo") + 1, F.col("len")), " ") == F.col("win"))
             .select("row", start.alias("start"), "len", "win"))
    items = materialize(shingles.select("win", "item").where("item is not null").groupBy(F.col("win").alias("iwin"))
                        .agg(F.collect_set("item").alias("items")), "items")
    words = F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1)))
    judged = (exact.join(if_small(items), F.col("win") == F.col("iwin"), "left")
              .groupBy(F.col("row").alias("r"))
              .agg(F.collect_set(F.struct("start", "len")).alias("spans"), F.collect_set("items").alias("items"))
              .select("r", F.size(F.array_distinct(words)).cast("long").alias("n_hit"),
                      F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"), F.array_sort("spans").alias("spans")))
    none = F.array().cast("array<string>")
    return (base.join(judged, F.col("row") == F.col("r"), "left")
            .select("row", "id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", none).alias("items"),
                    F.coalesce("spans", F.array().cast("array<struct<start:int,len:int>>")).alias("spans")))
