"""The operators' registered queries and their DuckDB twins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm import (
    decontaminate,
    html_blocks,
    licenses,
    minhash,
    mixing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    suffix_dedup,
    token_counts,
    toxicity,
    url_filter,
    vector_codes,
)
from newsflow.llm.common import table
from newsflow.llm.labels import held_out, training_labels
from newsflow.session import materialize

TOKENIZER = "word_bpe_49k.json"


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    measured = materialize(quality_rules.measure(docs).drop("text"), "op1_measures")
    judged = quality_rules.judge(measured, quality_rules.rate_hosts(measured))
    return judged.select("doc_id", "measures.*", "quality.kept", F.round("quality.host_rate", 9).alias("host_rate"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                        (F.col("repeats") * F.col("size")).alias("taken"), "source", "repeats")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated_words(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op4_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_blocks.extract(pages).select("page_id", "url", F.col("main_text").alias("text"),
                                             F.char_length("main_text").cast("long").alias("n_chars"))


TOXIC_CUT = 0.5


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
                         (F.col("score") >= TOXIC_CUT).cast("int").alias("predicted"), "evidence")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path(TOKENIZER))
    return counted.select("doc_id", "tokens.n_bytes", "tokens.n_tokens",
                          (F.col("tokens.n_tokens") > token_counts.MAX_TOKENS).alias("over_limit"))


QUALITY_CUT = 0.3


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", quality_classifier.statistics_column().alias("x"))
    docs = materialize(docs, "op7_statistics")
    labels = training_labels(table(spark, sf_dir, "labels"), "quality")
    model = quality_classifier.fit(docs.join(labels, F.col("doc_id") == F.col("lid")))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), quality_classifier.score_column(model, "x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= QUALITY_CUT).cast("int"))


# The contract's rules: (verdict, host, path).
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
# The list of blocked URLs: the canonical URLs of all pages on hosts of these
# names, gathered from the table itself, so it grows with it.
LISTED_NAMES = ("spam-farm", "cheap-pills", "casino-win", "adult-x", "free-bets", "ads-track")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    host, path = url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))
    on_list = F.arrays_overlap(F.split(host, r"\."), F.array(*map(F.lit, LISTED_NAMES)))
    listed = pages.where(on_list).select(url_filter.canonical(host, path).alias("listed"))
    judged = url_filter.judge(pages, URL_RULES, listed)
    return judged.select("page_id", "filter.host", "filter.path", "filter.rule", "filter.verdict", "filter.listed")


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
                        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    sure = F.filter("licences", lambda x: x["confirmed"])
    return found.select("doc_id", F.size("licences").cast("long").alias("n_findings"), F.size(sure).cast("long").alias("n_licences"),
                        F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda x: x["family"]))), ",").alias("families"),
                        F.array_join(F.transform(sure, lambda x: x["paragraph"].cast("string")), ",").alias("paragraphs"),
                        F.array_max(F.transform("licences", lambda x: x["probability"])).alias("probability"),
                        F.array_max(F.transform("licences", lambda x: x["similarity"])).alias("similarity"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return coded.select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    texts = suffix_dedup.remove_repeats(docs)
    digest = texts.select("h", "n", (F.col("n") - F.octet_length("kept")).alias("gone"), F.size("spans").alias("runs"), F.sha2("kept", 256).alias("sha"))
    none = F.sha2(F.lit("").cast("binary"), 256)
    return suffix_dedup.of_rows(docs, digest).select(
        F.col("id").alias("doc_id"), "n_bytes", F.coalesce("gone", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("runs", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("sha", none).alias("kept_sha256"))


def repeat_tail(words: list[bytes], h: int | None) -> list[bytes]:
    """The contract's planted tail: in every tenth text by ``h``, words repeat
    with some period from some word on."""
    n = len(words)
    if h is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i] for i in (np.arange(n - a) % p).tolist()]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.find_runs(docs, edit=repeat_tail, key=F.crc32(F.col("doc_id").cast("string").cast("binary")))
    lines = F.transform("periodic.runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    best = found.select("doc_id", F.size("periodic.runs").cast("long").alias("n_runs"), periodic_runs.strongest(F.col("periodic.runs")).alias("b"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2(F.col("periodic.collapsed"), 256).alias("collapsed_sha256"))
    return best.select("doc_id", "n_runs", "b.start", "b.length", "b.period", F.expr("1000 * b.length div b.period").alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_mixing, op3_decontamination, op4_html_blocks, op5_toxicity, op6_token_counts, op7_quality_classifier, op8_url_filter, op9_minhash,
                                   op10_licenses, op11_vector_codes, op12_suffix_dedup, op13_periodic_runs)}

WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# host_rate and the host verdict: the same prior by moments, over the sources.
OP1_SQL = f"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS text, {WORDS_SQL} AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
hit AS (SELECT doc_id, count(DISTINCT i + k) AS n
        FROM (SELECT g.doc_id, g.i, unnest(range(0, 5)) AS k
              FROM g JOIN (SELECT doc_id, g FROM g GROUP BY ALL HAVING count(*) > 1) r USING (doc_id, g)) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n
          FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM w)
          WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
m AS (SELECT doc_id, source, len(ws) AS n_words,
             CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(lines.n, 0) AS n_dup_lines, coalesce(hit.n, 0) AS n_repeat_words
      FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN lines USING (doc_id)),
f AS (SELECT *, n_words < {quality_rules.MIN_WORDS}
                OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS d, count(*) FILTER (base_failed) AS x FROM f WHERE source IS NOT NULL GROUP BY source),
s AS (SELECT count(*) AS k, CAST(sum(d) AS DOUBLE) AS n, sum(x) / CAST(sum(d) AS DOUBLE) AS p,
             sum(CAST(d AS DOUBLE) * d) AS n2, sum(CAST(x AS DOUBLE) * x / d) AS ff FROM h),
v AS (SELECT *, p * (1 - p) AS b, (ff - n * p * p - (k - 1) * p * (1 - p)) / greatest(n - n2 / n, 1e-9) AS var FROM s),
a AS (SELECT least(greatest(CASE WHEN k > 1 AND b > 0 AND var > 0 THEN b / var - 1 ELSE {quality_rules.PRIOR_STRENGTH[1]} END,
                            {quality_rules.PRIOR_STRENGTH[0]}), {quality_rules.PRIOR_STRENGTH[1]}) AS strength,
             least(greatest(p, 0.5 / (n + 1)), 1 - 0.5 / (n + 1)) AS p FROM v),
r AS (SELECT source, (x + p * strength) / (d + strength) AS rate FROM h, a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(rate > {quality_rules.MAX_HOST_RATE}, false) AS kept, round(rate, 9) AS host_rate
FROM f LEFT JOIN r USING (source)
"""

OP3_WORDS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
OP3_SQL = f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {OP3_WORDS_SQL} AS ws FROM benchmark),
v AS (SELECT DISTINCT item, least(len(ws), 10) AS l, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS win
      FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 8, 2))) AS i FROM b WHERE len(ws) > 0)),
d AS (SELECT doc_id, {OP3_WORDS_SQL} AS ws FROM documents),
places AS (SELECT doc_id, i, l, array_to_string(ws[i:i + l - 1], ' ') AS win
       FROM (SELECT doc_id, ws, l, unnest(range(1, len(ws) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM v) WHERE len(ws) >= l)),
hits AS (SELECT doc_id, i, l, item FROM places JOIN v USING (l, win)),
words AS (SELECT doc_id, count(DISTINCT i + k) AS n
          FROM (SELECT doc_id, i, unnest(range(0, l)) AS k FROM (SELECT DISTINCT doc_id, i, l FROM hits)) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM hits WHERE item IS NOT NULL GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_hit, coalesce(len(items), 0) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP9_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + least(len(ws), 5) - 1], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
rare AS (SELECT g FROM g GROUP BY g HAVING count(*) > 1),
both_ AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
          FROM (SELECT * FROM g SEMI JOIN rare USING (g)) x JOIN (SELECT * FROM g SEMI JOIN rare USING (g)) y USING (g)
          WHERE x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM both_ JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
          WHERE 100 * c >= {minhash.THRESHOLD} * (p.n + q.n - c)),
near AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
          UNION SELECT reach.a, near.b FROM reach JOIN near ON reach.b = near.a),
low AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM low LEFT JOIN n USING (doc_id)
"""

_RULES_SQL = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
_NAMES_SQL = ", ".join(f"'{n}'" for n in LISTED_NAMES)
OP8_SQL = f"""
WITH u AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, url, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
             coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
c AS (SELECT *, regexp_replace(host, '^www\\.', '') || regexp_replace(path, '/+$', '') AS canon,
             strpos(url, '://') > 0 AS has_host FROM p),
l AS (SELECT DISTINCT canon FROM c WHERE list_has_any(string_split(host, '.'), [{_NAMES_SQL}])),
r AS (SELECT * FROM (VALUES {_RULES_SQL}) t(verdict, h, p)),
best AS (SELECT page_id, arg_max(struct_pack(rule := h || r.p, verdict := verdict), length(h || r.p) * 1000 + length(h)) AS b
         FROM c JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, r.p) GROUP BY page_id)
SELECT page_id, host, path, b.rule AS rule, coalesce(b.verdict, CASE WHEN l.canon IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
       l.canon IS NOT NULL AS listed
FROM c LEFT JOIN best USING (page_id) LEFT JOIN l ON c.canon = l.canon AND has_host
"""

# Two rounds of moves, written out; positions within a vector are c.
def _op11_assign(book: str) -> str:
    return f"""(SELECT vec_id, p, arg_min(e, d * 1000 + e) AS e, min(d) AS d
               FROM (SELECT x.vec_id, x.p, b.e, sum((x.v - b.v) * (x.v - b.v)) AS d FROM x JOIN {book} b USING (p, c) GROUP BY ALL) GROUP BY ALL)"""


def _op11_move(book: str) -> str:
    return f"""(SELECT b.p, b.e, b.c, coalesce(m.v, b.v) AS v FROM {book} b LEFT JOIN
                (SELECT a.p, a.e, x.c, CAST(floor(sum(x.v) / count(*)) AS BIGINT) AS v FROM {_op11_assign(book)} a JOIN x USING (vec_id, p) GROUP BY ALL) m USING (p, e, c))"""


OP11_SQL = f"""
WITH k AS (SELECT vec_id, label, embedding FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
x AS MATERIALIZED (SELECT vec_id, c // (len // {vector_codes.PARTS}) AS p, c, CAST(floor({vector_codes.SCALE} * CAST(embedding[c + 1] AS DOUBLE)) AS BIGINT) AS v
      FROM (SELECT vec_id, embedding, len(embedding) AS len, unnest(range(0, len(embedding))) AS c FROM k)),
s AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k ORDER BY vec_id LIMIT {vector_codes.ENTRIES}),
b0 AS MATERIALIZED (SELECT p, e, c, v FROM x JOIN s USING (vec_id)),
b1 AS MATERIALIZED {_op11_move("b0")},
b2 AS MATERIALIZED {_op11_move("b1")},
r AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM {_op11_assign("b2")} GROUP BY vec_id),
l AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM r JOIN k USING (vec_id) GROUP BY label)
SELECT r.vec_id, code, error, label_error, (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, e, c)) FROM b2) AS codebooks_sha256
FROM r JOIN k USING (vec_id) JOIN l ON l.label IS NOT DISTINCT FROM k.label
"""

# All windows of all texts, as hexadecimal digits: two a byte.
OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT r, i, md5(substr(x, 2 * i + 1, {2 * suffix_dedup.WINDOW})) AS w
      FROM (SELECT r, x, unnest(range(0, len(x) // 2 - {suffix_dedup.WINDOW - 1})) AS i FROM d WHERE len(x) >= {2 * suffix_dedup.WINDOW})),
f AS (SELECT r, i FROM w WHERE w IN (SELECT w FROM w GROUP BY w HAVING count(*) > 1)),
g AS (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= {suffix_dedup.WINDOW} THEN 0 ELSE 1 END AS fresh FROM f),
runs AS (SELECT r, min(i) AS a, max(i) + {suffix_dedup.WINDOW} AS b FROM (SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS k FROM g) GROUP BY r, k),
gaps AS (SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS z FROM runs),
cut AS (SELECT r, count(*) AS n, sum(b - a) AS removed, max(b) AS last, string_agg(substr(x, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS kept FROM gaps JOIN d USING (r) GROUP BY r)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (r)
"""

ORACLE = {"op11_vector_codes": OP11_SQL, "op12_suffix_dedup": OP12_SQL, "op8_url_filter": OP8_SQL, "op3_decontamination": OP3_SQL, "op9_minhash": OP9_SQL, "op1_quality_rules": OP1_SQL}
