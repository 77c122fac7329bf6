"""URL filters: listed canonical URLs and host/path rules through one blocked
Bloom filter and an exact hash join. DataFrame functions only.

Every listed entry is one key: a rule is its host and path, a URL its
canonical form. A page's URL has a candidate key for each suffix of its host
(at dots) with each length of path that any rule has, and one for its own
canonical form. The filter is a table of 64-bit blocks; a key sets ``BITS``
bits of one block, so a look-up reads one block. Keys that pass are joined with
the listed entries themselves, which removes the false positives. Each
distinct URL is looked up once.

Of the rules that fit, the longest stands (host and path together, then host);
its verdict overrides the URL list. A URL that is listed and fits no rule is
blocked, all others are allowed.

Canonical form: host in lower case without a leading ``www.``, path without
trailing slashes; scheme, query and fragment are dropped.

Defined results: a null URL, or one without ``://``, has an empty host and
path, fits nothing and is allowed; repeated pages get equal rows; empty tables
give empty results; with an empty list and no rules everything is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import fresh, if_small
from newsflow.session import materialize

BITS = 5              # bits set for a key, all in one 64-bit block
BITS_PER_KEY = 16     # blocks are as many as give this many bits for each key

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, r"/+$", ""))


def _block(key: Column, blocks: int) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(blocks - 1))


def _mask(key: Column) -> Column:
    h, out = F.xxhash64(key, F.lit(1)), F.lit(0).cast("long")
    for i in range(BITS):
        bit = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return out


def bloom_blocks(entries: DataFrame, blocks: int) -> DataFrame:
    """``block, word``: the filter. At most ``blocks`` rows of 16 bytes."""
    return entries.groupBy(_block(F.col("key"), blocks).alias("block")).agg(F.bit_or(_mask(F.col("key"))).alias("word"))


def passing(keys: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """The rows of ``keys`` (column ``key``) whose bits are all set."""
    side = if_small(bloom.withColumnRenamed("block", "_b"))
    probe = keys.withColumn("_at", _block(F.col("key"), blocks)).withColumn("_m", _mask(F.col("key")))
    return (probe.join(side, F.col("_at") == F.col("_b")).where(F.col("word").bitwiseAND(F.col("_m")) == F.col("_m"))
            .drop("_b", "word", "_at", "_m"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], listed: DataFrame, url: str = "url", out: str = "filter") -> DataFrame:
    """``pages`` with the struct column ``out``: ``host, path, rule, listed,
    verdict``. ``rules``: (verdict, host, path); ``listed``: one column of
    canonical URLs."""
    spark = pages.sparkSession
    fixed = spark.createDataFrame([(f"r:{h}{p}", v, f"{h}{p}", len(h)) for v, h, p in rules], "key string, verdict string, rule string, hlen int")
    urls_ = listed.select(F.concat(F.lit("u:"), F.col(listed.columns[0])).alias("key")).where("key is not null").distinct()
    entries = materialize(fixed.unionByName(urls_, allowMissingColumns=True), "listed")
    blocks = 64
    while blocks * 64 < entries.count() * BITS_PER_KEY:
        blocks *= 2
    bloom = materialize(bloom_blocks(entries, blocks), "bloom")

    u = F.col("u")
    labels = F.split(host_of(u), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    lengths = sorted({len(p) for _, _, p in rules})
    path = path_of(u)

    def with_prefix(n: int) -> Column:
        fits = F.when(F.char_length(path) >= n, suffixes).otherwise(F.array().cast("array<string>"))
        return F.transform(fits, lambda s: F.concat(F.lit("r:"), s, F.substring(path, 1, n)))

    of_rules = [with_prefix(n) for n in lengths]
    own = F.array(F.concat(F.lit("u:"), canonical(host_of(u), path)))
    keys = (pages.select(F.col(url).alias("u")).where(F.instr("u", "://") > 0).distinct()
            .select("u", F.explode(F.array_distinct(F.concat(own, *of_rules))).alias("key")))
    hits = (passing(keys, bloom, blocks).join(if_small(entries.withColumnRenamed("key", "k")), F.col("key") == F.col("k"))
            .groupBy("u").agg(F.max(F.when(F.col("rule").isNotNull(), F.struct(F.char_length("rule"), "hlen", "rule", "verdict"))).alias("best"),
                              F.bool_or(F.col("rule").isNull()).alias("is_listed")))
    mine, key = fresh(pages, "_hit"), fresh(pages, "_url")
    side = hits.select(F.col("u").alias(key), F.struct("best", "is_listed").alias(mine))
    is_listed = F.coalesce(F.col(mine)["is_listed"], F.lit(False))
    verdict = F.coalesce(F.col(mine)["best"]["verdict"], F.when(is_listed, F.lit("block")).otherwise(F.lit("allow")))
    return (pages.join(side, F.col(url) == F.col(key), "left")
            .withColumn(out, F.struct(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
                                      F.col(mine)["best"]["rule"].alias("rule"), is_listed.alias("listed"), verdict.alias("verdict")))
            .drop(mine, key))
