"""Mixing sources to target weights by balanced sampling (the cube method).

Targets: sources in code-point order (null last) weigh 1, 2, 3, repeating, and
share the corpus' size; a target stops at ``MAX_REPEATS`` times its source's
size and the excess is reshared by weight (water filling). A document of a
source with ratio r = target / size is taken floor(r) times for certain and
once more with inclusion probability r - floor(r).

The fractional parts are settled by the cube method, source by source. The
flight phase walks the documents from large to small. Each is moved to 0 or 1
along a null-space vector of the two balancing constraints (documents and
words) that spreads the compensation over all smaller undecided documents, so
both totals stay as they are. It runs in blocks of bounded size; what each
block leaves (three of its smallest documents) meets in the blocks of the next
level, until a source is a single block. There the landing problem of those
few small documents gives up the number of documents first, then takes one
draw: a source's words miss the target by about one small document.

All draws depend on the source, the level and the block only, and all orders
are total, so reruns agree.

Defined results: null and empty texts have size 0 and are balanced as
documents; the null source is a source; a source of size 0 has target 0 and
takes nothing; repeated rows are mixed one by one; ties of size are ordered by
a hash of the id, then the id; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.common import WORD_RE, if_small
from newsflow.session import materialize

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
BLOCK = 1024      # documents that one block settles
LEFT = 3          # documents that a block may leave undecided
SEED = 20_260


def sizes_of(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_RE)), F.lit(0)).cast("long")
    return docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(source).alias("source"), size.alias("size"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: ``source, docs, source_size, target``. The windows
    run over this table of sums, one small row per source, never over
    documents. Comparisons are exact (decimals), so targets do not depend on
    the order of any sum."""
    big = "decimal(38,0)"
    sums = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size"))
    order = [F.col("source").asc_nulls_last()]
    rank = (F.row_number().over(Window.orderBy(*order)) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), rank.cast("int") + 1)
    s = sums.withColumn("w", weight).withColumn("cap", max_repeats * F.col("source_size"))
    # water filling: sources that are full first come first in the order of cap / w
    by_fill = Window.orderBy((F.col("cap") / F.col("w")).asc(), *order)
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    after = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = (s.withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
         .withColumn("wsum", F.sum("w").over(after))
         .withColumn("fits", F.col("left").cast(big) * F.col("w") <= F.col("cap").cast(big) * F.col("wsum"))
         .withColumn("n", F.row_number().over(by_fill)))
    level = F.min(F.when(F.col("fits"), F.struct("n", "left", "wsum"))).over(everything)
    s = s.withColumn("level", level)
    share = F.col("w") * F.col("level.left").cast("double") / F.col("level.wsum")
    target = F.when(F.col("n") < F.col("level.n"), F.col("cap").cast("double")).otherwise(F.least(share, F.col("cap").cast("double")))
    return s.select("source", "docs", "source_size", target.alias("target"))


def direction(size: np.ndarray, p: np.ndarray) -> np.ndarray:
    """A null-space vector of the balancing constraints that moves the first
    document by 1 and spreads the compensation over all others, most where
    there is room. Documents and words are kept; where the others' sizes can
    keep only one of them (or none is left to do so), words go first."""
    v, s, lead = p[1:] * (1 - p[1:]), size[1:], size[0]
    s0, s1, s2 = v.sum(), (v * s).sum(), (v * s * s).sum()
    det = s0 * s2 - s1 * s1
    if det > 1e-9 * s0 * s2:
        rest = v * ((s2 - lead * s1) + (lead * s0 - s1) * s) / det
    elif s1 > 0:
        rest = v * (lead / s1)
    else:
        rest = v * (1 / s0 if lead == 0 and s0 > 0 else 0)
    return np.concatenate(([1.0], -rest))


def flight(size: np.ndarray, p: np.ndarray, draws: np.random.Generator, land: bool) -> np.ndarray:
    """Moves the probabilities ``p`` of documents, ordered by falling size,
    until at most ``LEFT`` (with ``land``: none) are strictly between 0 and 1.
    The flight keeps the sums of p and of p * size; the landing keeps words as
    long as two documents are open, then draws."""
    size, p = size.astype(float), p.astype(float).copy()
    open_ = np.flatnonzero((p > 0) & (p < 1))
    while len(open_) > (1 if land else LEFT):
        q, way = p[open_], direction(size[open_], p[open_])
        with np.errstate(divide="ignore", invalid="ignore"):
            above, below = (1 - q) / np.abs(way), q / np.abs(way)
        up, down = np.where(way > 0, above, below), np.where(way > 0, below, above)
        up[way == 0] = down[way == 0] = np.inf
        far, near = up.min(), down.min()
        step, met = (far, up.argmin()) if draws.random() * (far + near) < near else (-near, down.argmin())
        q = np.clip(q + step * way, 0.0, 1.0)
        q[met] = np.round(q[met])
        q[q < 1e-12], q[q > 1 - 1e-12] = 0.0, 1.0
        p[open_] = q
        open_ = open_[(q > 0) & (q < 1)]
    if land and len(open_):
        p[open_] = float(draws.random() < p[open_[0]])
    return p


def _settle(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["size", "h", "key"], ascending=[False, True, True], kind="stable", ignore_index=True)
    first = pdf.iloc[0]
    draws = np.random.default_rng([SEED, int(first["sh"]) & 0xFFFFFFFF, int(first["level"]), int(first["block"])])
    pdf["p"] = flight(pdf["size"].to_numpy(), pdf["p"].to_numpy(), draws, bool(first["blocks"] == 1))
    return pdf


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, block: int = BLOCK) -> DataFrame:
    """One row per document: ``id, text_hash, source, size, source_size, target,
    repeats`` (how often the mix takes the document)."""
    sizes = materialize(sizes_of(docs, id, text, source), "sizes")
    targets = materialize(source_targets(sizes, weights, max_repeats), "targets")
    side = if_small(targets.withColumnRenamed("source", "s"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = (sizes.join(side, F.col("source").eqNullSafe(F.col("s"))).drop("s")
            .withColumn("base", F.floor(ratio).cast("long")).withColumn("p", ratio - F.floor(ratio)))
    certain = rows.where("p = 0").select("id", "text_hash", "source", "size", "source_size", "target", F.col("base").alias("repeats"))

    # ids travel as strings so that null and large ids come back as they were
    keep = ["id", "text_hash", "source", "size", "source_size", "target", "base"]
    key = F.coalesce(F.col("id").cast("string"), F.lit(""))
    open_ = (rows.where("p > 0").withColumn("key", key).withColumn("h", F.xxhash64("key", "size"))
             .withColumn("sh", F.xxhash64("source")).withColumn("blocks", F.ceil(F.col("docs") / block).cast("long")).drop("docs"))
    schema = "id string, text_hash long, source string, size long, source_size long, target double, base long, p double, key string, h long, sh long, blocks long, block long, level int"
    most = targets.agg(F.max("docs")).first()[0] or 0
    done, level, blocks = [], 0, math.ceil(most / block)
    while blocks:
        dealt = (open_.withColumn("id", F.col("id").cast("string"))
                 .withColumn("block", F.pmod(F.xxhash64("h", F.lit(level)), F.col("blocks"))).withColumn("level", F.lit(level)))
        settled = materialize(dealt.groupBy("sh", "block").applyInPandas(_settle, schema), f"level{level}")
        done.append(settled.where("p = 0 or p = 1").select(*keep, "p"))
        open_ = settled.where("p > 0 and p < 1").drop("block", "level").withColumn("blocks", F.ceil(LEFT * F.col("blocks") / block).cast("long"))
        level, blocks = level + 1, 0 if blocks == 1 else math.ceil(LEFT * blocks / block)
    kind, skind = docs.schema[id].dataType, docs.schema[source].dataType
    for d in done:
        certain = certain.union(d.select(F.col("id").cast(kind).alias("id"), "text_hash", F.col("source").cast(skind).alias("source"), "size", "source_size", "target",
                                         (F.col("base") + F.col("p").cast("long")).alias("repeats")))
    return certain
