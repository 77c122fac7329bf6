"""JSON article files.

The reference writes one JSON array per site and one combined array. Here
the boundary format is JSON lines in a directory (splittable, one task per
file split), partitioned by site; the reader also accepts the reference's
single-array files (``multiLine``). Inside the pipeline, Parquet is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.functions.dates import render_ts

# Article record as found in the JSON files: timestamps are strings there.
ARTICLE_JSON = T.StructType([
    T.StructField("art_url", T.StringType()),
    T.StructField("art_title", T.StringType()),
    T.StructField("art_published_at", T.StringType()),
    T.StructField("art_type", T.StringType()),
    T.StructField("art_content", T.StringType()),
    T.StructField("art_category", T.StringType()),
    T.StructField("inactive", T.BooleanType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("scrapped_by", T.StringType()),
    T.StructField("art_source", T.StringType()),
    T.StructField("art_creation_date", T.StringType()),
])


def to_json_record(df: DataFrame) -> DataFrame:
    """Timestamps rendered as Python ``str(datetime)`` text."""
    out = df
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            out = out.withColumn(f.name, render_ts(F.col(f.name)))
    return out


def write_articles_json(df: DataFrame, path: str, partition_by: str | None = "site",
                        mode: str = "overwrite") -> None:
    """K1 / K2: JSON lines, null fields written as ``null`` (not dropped).

    Per-site output (K1): only sites configured with a category element carry
    the ``art_type`` key; the records of the others, of unknown sites and of no
    site are written without it. One pass over the input: each record is
    rendered to its JSON text and written to its site's folder.
    """
    record = to_json_record(df)
    if partition_by == "site" and "art_type" in df.columns:
        from newsflow import sites as S
        typed = [s.site for s in S.SITES if s.type_sel]
        cols = [c for c in record.columns if c != "site"]

        def text(names):
            return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})

        line = F.when(F.col("site").isin(typed), text(cols)).otherwise(text([c for c in cols if c != "art_type"]))
        record.select("site", line.alias("value")).write.mode(mode).partitionBy("site").text(path)
        return
    w = record.write.mode(mode).option("ignoreNullFields", "false")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.json(path)


def read_articles_json(spark: SparkSession, path: str, schema: T.StructType = ARTICLE_JSON,
                       multiline: bool = False) -> DataFrame:
    """Fixed schema, no inference. ``multiline`` for one-array files."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def read_site_json(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """S4 over a directory of per-site folders: one scan, ``site`` from the
    folder names. Sites without a folder are absent."""
    schema = T.StructType([*ARTICLE_JSON.fields, T.StructField("site", T.StringType())])
    return read_articles_json(spark, path, schema, multiline)


def sample(df: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """S5 ``find_one()``: any one row; deterministic when ``order_by`` is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(1)
