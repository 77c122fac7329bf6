"""From documents to a training mix: five stages, each one operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents. All but the
last return the columns of documents, whatever these are.

Defined results for unusual rows. A row is known by its doc_id (null included)
and its text: rows equal in both are repeated rows. Quality stages judge row by
row. Near-dedup keeps one row of each group; a repeated row is a group.
Decontamination drops every row with a hit. The mix takes repeated rows
together, as one row that is taken as often as all of them. Null and empty
texts fail the quality rules. Empty tables pass through every stage.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm import decontaminate, minhash, mixing, quality_classifier, quality_rules
from newsflow.llm.common import fresh, if_small, table
from newsflow.llm.labels import training_labels
from newsflow.llm.queries import QUALITY_CUT
from newsflow.session import apply_job_conf, materialize


def _stage(fn):
    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        apply_job_conf(spark)
        return fn(spark, docs, sf_dir)
    return run_stage


@_stage
def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules, of hosts that are not rejected."""
    m, q = fresh(docs, "_measures"), fresh(docs, "_quality")
    measured = quality_rules.measure(docs, out=m)
    judged = quality_rules.judge(measured, quality_rules.rate_hosts(measured, measures=m), measures=m, out=q)
    return judged.where(F.col(q)["kept"]).select(docs.columns)


@_stage
def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of at least the cut."""
    known = materialize(docs.select(F.col("doc_id").alias("id"), quality_classifier.statistics_column().alias("x")), "statistics")
    labels = training_labels(table(spark, sf_dir, "labels"), "quality")
    model = quality_classifier.fit(known.join(labels, F.col("id") == F.col("lid")))
    x, s = fresh(docs, "_x"), fresh(docs, "_score")
    scored = docs.withColumn(x, quality_classifier.statistics_column()).withColumn(s, quality_classifier.score_column(model, x))
    return scored.where(F.col(s) >= QUALITY_CUT).select(docs.columns)


def _of_rows(docs: DataFrame, side: DataFrame, how: str) -> DataFrame:
    """Joins ``docs`` with a written table keyed by ``id`` and ``text_hash``."""
    i, h = fresh(docs, "_id"), fresh(docs, "_hash")
    side = if_small(side.withColumnsRenamed({"id": i, "text_hash": h}))
    return docs.join(side, docs["doc_id"].eqNullSafe(F.col(i)) & (F.xxhash64(docs["text"]) == F.col(h)), how)


@_stage
def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    rows = materialize(minhash.near_duplicates(docs).groupBy("id", "text_hash")
                       .agg(F.bool_or(F.col("row") == F.col("keeper")).alias("kept"), F.count(F.lit(1)).alias("n")), "groups")
    losers = materialize(rows.where("not kept").select("id", "text_hash"), "losers")
    rest = _of_rows(docs, losers, "left_anti")
    if rows.where("kept and n > 1").isEmpty():
        return rest
    h = fresh(docs, "_hash")
    return rest.withColumn(h, F.xxhash64("text")).dropDuplicates(["doc_id", h]).drop(h)


@_stage
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    found = decontaminate.contaminated_words(docs, table(spark, sf_dir, "benchmark"))
    return _of_rows(docs, materialize(found.where("n_hit > 0").select("id", "text_hash").distinct(), "contaminated"), "left_anti")


@_stage
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``repeats``, how often."""
    picks = materialize(mixing.mix(docs).groupBy("id", "text_hash").agg(F.sum("repeats").alias("repeats"), F.count(F.lit(1)).alias("n"))
                        .where("repeats > 0"), "picks")
    name, n = fresh(docs, "repeats"), fresh(docs, "_n")
    taken = _of_rows(docs, picks.withColumnsRenamed({"repeats": name, "n": n}), "inner")
    if not picks.where("n > 1").isEmpty():
        h = fresh(docs, "_hash")
        taken = taken.withColumn(h, F.xxhash64("text")).dropDuplicates(["doc_id", h])
    return taken.select(*docs.columns, name)


STAGES = [
    ("quality rules", quality_rules_stage),
    ("quality classifier", quality_classifier_stage),
    ("near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

# A trained classifier and balanced sampling have no SQL form; the pipeline is
# tested against brute-force versions of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
