"""Connected components of a link table, by alternating large-star and
small-star steps (Kiveris et al., 2014). Every step is two aggregations with
map-side partial results and a join; hot nodes are split by adaptive
execution. Each step's table is written to the shared folder, so a lost
executor never repeats earlier steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
    return (both.where("b > a").join(least, F.col("a") == F.col("c"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least.withColumnRenamed("a", "c"), F.col("a") == F.col("c")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.union(least.select("a", F.col("m").alias("b"))).where("a <> b")


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 30)))).first()
    return r[0], r[1]


def connected(links: DataFrame) -> DataFrame:
    """``links``: two columns of node ids (long). Returns ``node, root`` for
    every node that has a link; root is the component's smallest node and has
    a row of its own. An empty table gives an empty one."""
    a, b = links.columns
    edges = materialize(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "links")
    state = _state(edges)
    while state[0]:
        edges = materialize(_small_star(_large_star(edges)).distinct(), "stars")
        before, state = state, _state(edges)
        if before == state:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
