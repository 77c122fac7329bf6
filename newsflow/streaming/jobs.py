"""Streaming forms of the two jobs.

* Articles: ``readStream`` over the landed crawl directory. Each micro-batch
  runs the batch articles job inside ``foreachBatch`` and overwrites its own
  ``batch_id`` partition (dynamic partition overwrite), so a replayed epoch
  after a failure rewrites the same partition instead of appending twice.
* Mentions: with the native providers every step is row-local (projections
  and generators, no shuffle, no state), so the whole job runs as a
  streaming plan into the file sink, which commits exactly once per batch.

Both keep progress in a checkpoint location that must be on shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from newsflow.functions.crypto import encrypt_columns
from newsflow.plans.articles_job import articles_job
from newsflow.plans.mentions_job import MENTION_FIELDS, mention_rows

CRAWL_SCHEMA = T.StructType([
    T.StructField("site", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("html", T.StringType()),
    T.StructField("fetched_at", T.TimestampNTZType()),
])


def crawl_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(CRAWL_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(landing_dir)


def start_articles_stream(spark: SparkSession, landing_dir: str, out_dir: str, rejects_dir: str,
                          checkpoint: str, profiles=None, run_ts: str | None = None,
                          available_now: bool = True, max_files_per_trigger: int | None = None
                          ) -> StreamingQuery:
    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        arts, rejects = articles_job(batch, profiles, run_ts=run_ts, materialize_fields=True)
        for df, path in ((arts, out_dir), (rejects, rejects_dir)):
            (df.withColumn("batch_id", F.lit(epoch_id).cast("bigint"))
               .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy("batch_id").parquet(path))

    w = (crawl_stream(spark, landing_dir, max_files_per_trigger).writeStream
         .foreachBatch(per_batch).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_mentions_stream(spark: SparkSession, articles_dir: str, articles_schema: T.StructType,
                          out_dir: str, checkpoint: str, key: str | bytes, scorer, tagger=None,
                          available_now: bool = True, rejects_dir: str | None = None) -> StreamingQuery:
    """``rejects_dir``: a second query writes the chunks with an unknown label
    there (its progress is kept under ``<checkpoint>-rejects``)."""
    arts = spark.readStream.schema(articles_schema).parquet(articles_dir)
    rows, rejects = mention_rows(arts, scorer, tagger)
    enc = encrypt_columns(rows, [c for c in MENTION_FIELDS if c in rows.columns], key)

    def start(df: DataFrame, path: str, progress: str) -> StreamingQuery:
        w = (df.writeStream.format("parquet").option("path", path)
               .option("checkpointLocation", progress).outputMode("append"))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
        return w.start()

    if rejects_dir:
        start(rejects, rejects_dir, f"{checkpoint.rstrip('/')}-rejects")
    return start(enc, out_dir, checkpoint)
