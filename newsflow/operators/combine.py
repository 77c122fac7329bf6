"""Union of the per-site datasets and per-site counts (A1, A2)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from newsflow import sites as S


def union_sites(frames: dict[str, DataFrame], order=S.UNION_ORDER) -> DataFrame:
    """Bag union in the fixed site order; differing columns allowed (absent
    ones become NULL). ``source_ord`` keeps the append order observable.
    A union is narrow: no shuffle."""
    parts = [frames[s].withColumn("source_ord", F.lit(i)) for i, s in enumerate(order) if s in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def append_order(df: DataFrame, site_col: str = "site", order=S.UNION_ORDER) -> DataFrame:
    """U1 over one table of all sites (read with partition discovery): adds
    ``source_ord``. A site without rows is simply absent; one outside the order
    gets NULL."""
    m = F.create_map(*[x for i, s in enumerate(order) for x in (F.lit(s), F.lit(i))])
    return df.withColumn("source_ord", F.try_element_at(m, F.col(site_col)))


def count_by_site(df: DataFrame, name: str = "n", site_col: str = "site") -> DataFrame:
    """A1 / A2: rows per site (partial aggregation before the shuffle, so a
    site holding most rows costs one small partial row per task)."""
    return df.groupBy(site_col).agg(F.count(F.lit(1)).cast("bigint").alias(name))


def write_with_counts(df: DataFrame, path: str, name: str = "n", site_col: str = "site", sites=S.UNION_ORDER) -> DataFrame:
    """A1 / A2 without a pass of their own: ``df`` is written to ``path`` and its
    rows per configured site are counted by the write itself. Rows of other or
    no sites are counted together (null site). Sites without rows are absent."""
    seen = Observation()
    column = F.col(site_col)
    counts = [F.count(F.when(column == s, 1)).alias(f"s{i}") for i, s in enumerate(sites)]
    df.observe(seen, F.count(F.lit(1)).alias("all"), *counts).write.mode("overwrite").parquet(path)
    got = seen.get
    rows = [(s, got[f"s{i}"]) for i, s in enumerate(sites)]
    rows.append((None, got["all"] - sum(n for _, n in rows)))
    return df.sparkSession.createDataFrame([r for r in rows if r[1]], f"{site_col} string, {name} bigint")
