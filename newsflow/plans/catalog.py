"""Registered queries: one per operator of SURVEY §2, each reading the
driver's tables at ``sf_dir`` in full, plus the independent DuckDB SQL that
must give the same rows (tables are views named after the parquet files).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow import sites as S
from newsflow.functions import crypto as CR
from newsflow.functions import dates as D
from newsflow.functions import text as T
from newsflow.operators import borders as BD
from newsflow.operators import combine as C
from newsflow.operators import extract as X
from newsflow.operators import lineage as L
from newsflow.operators import mentions as M
from newsflow.operators import nearmemory as NM
from newsflow.operators import ordinal as OR
from newsflow.operators import sentiment as SE
from newsflow.operators import sequence as SQ
from newsflow.operators import shapes as SH
from newsflow.operators import translate as TR
from newsflow.operators.automaton import AutomatonTagger
from newsflow.operators.tagging import GazetteerTagger
from newsflow.operators.tagging import PERSON, PERSON_RULE, WORD, RuleEntityTagger, RuleTagger, entity_texts, split_sentences
from newsflow.plans import articles_job as AJ
from newsflow.plans import bindings as B
from newsflow.plans import mentions_job as MJ
from newsflow.plans import sqlkit as Q
from newsflow.session import scratch_path
from newsflow.sinks import tables as TB
from newsflow.sources import crawl as FR
from newsflow.sources import jsonarray as JA
from newsflow.sources import jsonio as J
from newsflow.streaming import state as ST

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
# without SQL: fitted by rounds of gradients (tested against a direct fit); edit distances
# of characters between all pairs (tested against brute force)
NO_SQL = {"chunk_stars_learned", "translate_near"}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _docs(spark, sf_dir, *cols):
    return B.table(spark, sf_dir, "documents", *cols)


# --- N1 / N2 / N3 / P5 / P6 / W1 / T8 / N6 -----------------------------------

@query("sentences", f"""
  SELECT doc_id, sentence_no, sents[sentence_no + 1] AS sentence FROM ({Q.DOC_SENTENCES})""")
def q_sentences(spark, sf_dir):
    d = _docs(spark, sf_dir, "doc_id", "text")
    return (d.select("doc_id", F.posexplode(split_sentences(F.col("text"))).alias("sentence_no", "sentence"))
             .withColumn("sentence_no", F.col("sentence_no").cast("bigint")))


# N1 with learnt abbreviations. The texts have none, so some of their words are
# turned into ones that a border may or may not follow.
ABBREVIATED = ((" of ", " cf. "), (" de ", " Dr. "), (" und ", " Nr. Sa "), (" and ", " etc. The "), (" by ", " A. "), (" le ", " e.g. "))


def _abbreviated_sql() -> str:
    text = "text"
    for a, b in ABBREVIATED:
        text = f"replace({text}, '{a}', '{b}')"
    return f"SELECT doc_id, {text} AS text FROM documents"


def _l(k: str, n: str, p: str) -> str:
    return f"(CASE WHEN {k} > 0 THEN ({k}) * ln({p}) ELSE 0 END + CASE WHEN ({n}) - ({k}) > 0 THEN (({n}) - ({k})) * ln(1 - ({p})) ELSE 0 END)"


def _association_sql(both: str, first: str, second: str, total: str) -> str:
    p, p1, p2 = f"CAST({second} AS DOUBLE) / {total}", f"CAST({both} AS DOUBLE) / {first}", f"CAST(({second} - {both}) AS DOUBLE) / greatest({total} - {first}, 1)"
    ratio = f"2 * ({_l(both, first, p1)} + {_l(f'{second} - {both}', f'{total} - {first}', p2)} - {_l(both, first, p)} - {_l(f'{second} - {both}', f'{total} - {first}', p)})"
    return f"CASE WHEN {p1} > {p} THEN {ratio} ELSE 0 END"


def _learned_sql() -> str:
    ws = f"{Q.WS_CLASS}"
    return f"""
  WITH d AS ({_abbreviated_sql()}),
  t AS (SELECT doc_id, i, lower(regexp_replace(tok, '[.!?]$', '')) AS w, regexp_extract(tok, '[.!?]$') AS mark, regexp_matches(tok, '^\\p{{Lu}}') AS cap
        FROM (SELECT doc_id, unnest(toks) AS tok, unnest(range(0, len(toks))) AS i FROM (SELECT doc_id, regexp_extract_all(text, '{BD.TOKEN_RE}') AS toks FROM d))),
  x AS (SELECT *, lag(mark) OVER o AS before, lead(w) OVER o AS nw, lead(cap) OVER o AS ncap FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
  words AS (SELECT w, count(*) AS n, count(*) FILTER (mark = '.') AS dots, count(*) FILTER (NOT cap) AS low, count(*) FILTER (cap AND before = '') AS inside FROM x GROUP BY w),
  pairs AS (SELECT CASE WHEN mark = '.' THEN w ELSE '' END AS a, nw AS b, count(*) AS n, count(*) FILTER (ncap) AS capital FROM x WHERE mark <> '' AND nw IS NOT NULL GROUP BY ALL),
  tot AS (SELECT sum(n) AS total, sum(dots) AS all_dots FROM words),
  abbr AS (SELECT w AS a FROM (SELECT w, n, dots, total, all_dots, length(replace(w, '.', '')) AS letters, length(w) - length(replace(w, '.', '')) + 1 AS inner_ FROM words, tot)
           WHERE dots > 0 AND all_dots < total
             AND 2 * ({_l('dots', 'n', str(BD.DOTTED))} - {_l('dots', 'n', 'CAST(all_dots AS DOUBLE) / total')}) * exp(-letters) * inner_ * pow(CAST(letters AS DOUBLE), dots - n) >= {BD.ABBREVIATION}),
  marked AS (SELECT *, a IN (SELECT a FROM abbr) OR length(a) = 1 AS doubtful FROM pairs),
  starts AS (SELECT b, sum(n) AS starts FROM marked WHERE NOT doubtful GROUP BY b),
  sure AS (SELECT coalesce(sum(n) FILTER (NOT doubtful), 0) AS sure FROM marked),
  parted AS (SELECT m.a, m.b FROM marked m JOIN words wa ON wa.w = m.a JOIN words wb ON wb.w = m.b LEFT JOIN starts s ON s.b = m.b, tot, sure
             WHERE m.doubtful AND m.capital > 0
               AND ((sure > 0 AND ({_association_sql('coalesce(starts, 0)', 'greatest(sure, 1)', 'wb.n', 'total')}) >= {BD.STARTER})
                    OR (wb.low > 0 AND wb.inside = 0 AND NOT ({_association_sql('m.n', 'wa.dots', 'wb.n', 'total')}) >= {BD.COLLOCATION}))),
  p AS (SELECT doc_id, unnest(ps) AS p, unnest(range(0, len(ps))) AS i
        FROM (SELECT doc_id, string_split(regexp_replace(text, '([.!?])({ws})', '\\1' || chr(1) || '\\2', 'g'), chr(1)) AS ps FROM d)),
  q AS (SELECT doc_id, i, p, regexp_extract(lag(p) OVER (PARTITION BY doc_id ORDER BY i), '({BD.WORD_RE})\\.$', 1) AS w, regexp_extract(p, '^{ws}*([\\p{{L}}\\p{{N}}]+)', 1) AS first FROM p),
  r AS (SELECT doc_id, i, p, CASE WHEN i = 0 THEN 1 WHEN w <> '' AND (lower(w) IN (SELECT a FROM abbr) OR regexp_matches(w, '^\\p{{Lu}}$'))
                 AND NOT (regexp_matches(first, '^\\p{{Lu}}') AND (lower(w), lower(first)) IN (SELECT (a, b) FROM parted)) THEN 0 ELSE 1 END AS fresh FROM q),
  s AS (SELECT doc_id, i, CASE WHEN fresh = 1 AND i > 0 THEN regexp_replace(p, '^{ws}+', '') ELSE p END AS p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) - 1 AS k FROM r)
  SELECT doc_id, CAST(k AS BIGINT) AS sentence_no, string_agg(p, '' ORDER BY i) AS sentence FROM s GROUP BY doc_id, k"""


def _abbreviated(spark, sf_dir):
    text = F.col("text")
    for a, b in ABBREVIATED:
        text = F.replace(text, F.lit(a), F.lit(b))
    return _docs(spark, sf_dir, "doc_id", "text").select("doc_id", text.alias("text"))


@query("sentences_learned", _learned_sql())
def q_sentences_learned(spark, sf_dir):
    """Abbreviations and collocations counted over all texts, then borders."""
    docs = _abbreviated(spark, sf_dir)
    split = BD.Borders.learn(docs).split(docs)
    return split.select("doc_id", F.posexplode("sents").alias("sentence_no", "sentence")).withColumn("sentence_no", F.col("sentence_no").cast("bigint"))


@query("persons", f"""
  SELECT doc_id, sentence_no, person_no, persons[person_no + 1] AS person
  FROM (SELECT doc_id, sentence_no, persons, unnest(range(0, len(persons))) AS person_no
        FROM (SELECT doc_id, sentence_no, {Q.persons('sents[sentence_no + 1]')} AS persons
              FROM ({Q.DOC_SENTENCES})))""")
def q_persons(spark, sf_dir):
    tagged = RuleTagger().tag(_docs(spark, sf_dir, "doc_id", "text"), "text")
    hits = F.filter(F.transform("persons", lambda p, i: F.struct(i.cast("bigint").alias("sentence_no"),
                                                                  p.alias("p"))),
                    lambda h: F.size(h["p"]) > 0)            # explode only sentences with persons
    s = tagged.select("doc_id", F.inline(hits))
    return s.select("doc_id", "sentence_no", F.posexplode("p").alias("person_no", "person")
                    ).withColumn("person_no", F.col("person_no").cast("bigint"))


# Without sentence marks a text is one sentence, in which persons meet.
@query("persons_joined", f"""
  SELECT doc_id, 0::BIGINT AS sentence_no, array_to_string(persons, ',') AS persons,
         CAST(len(persons) AS BIGINT) AS n_persons
  FROM (SELECT doc_id, {Q.persons("regexp_replace(text, '[.!?]', '', 'g')")} AS persons FROM documents)
  WHERE len(persons) > 0""")
def q_persons_joined(spark, sf_dir):
    """All persons of a sentence in one string, in text order."""
    d = _docs(spark, sf_dir, "doc_id", "text").withColumn("text", F.regexp_replace("text", "[.!?]", ""))
    tagged = RuleTagger().tag(d, "text")
    hits = M.sentences_with_persons(tagged, ["doc_id"])
    return hits.select("doc_id", "sentence_no", M.persons_string(F.col("persons")).alias("persons"),
                       F.size("persons").cast("bigint").alias("n_persons"))


@query("persons_by_label", f"""
  SELECT doc_id, sentence_no, CAST(len(list_filter(e, lambda x: regexp_matches(x, '^[0-9]'))) AS BIGINT) AS n_numbers,
         array_to_string(list_filter(e, lambda x: NOT regexp_matches(x, '^[0-9]')), ',') AS persons,
         strpos(s, list_filter(e, lambda x: NOT regexp_matches(x, '^[0-9]'))[1]) - 1 AS first_start
  FROM (SELECT doc_id, sentence_no, sents[sentence_no + 1] AS s,
               regexp_extract_all(sents[sentence_no + 1], '{PERSON_RULE}|[0-9]+') AS e FROM ({Q.DOC_SENTENCES}))
  WHERE len(list_filter(e, lambda x: NOT regexp_matches(x, '^[0-9]'))) > 0""")
def q_persons_by_label(spark, sf_dir):
    """Labelled entities, of which the label filter keeps the persons."""
    tagged = RuleEntityTagger().tag(_docs(spark, sf_dir, "doc_id", "text"), "text")
    rows = F.transform("sents", lambda s, i: F.struct(i.cast("bigint").alias("sentence_no"),
                                                      F.element_at("entities", i + 1).alias("entities"),
                                                      F.element_at("persons", i + 1).alias("persons")))
    hits = tagged.select("doc_id", F.inline(F.filter(rows, lambda r: F.size(r["persons"]) > 0)))
    first = F.filter("entities", lambda e: e["label"] == PERSON)[0]
    return hits.select("doc_id", "sentence_no", F.size(entity_texts(F.col("entities"), "CARDINAL")).cast("bigint").alias("n_numbers"),
                       M.persons_string(F.col("persons")).alias("persons"), first["start"].cast("bigint").alias("first_start"))


@query("sentences_with_person", f"""
  SELECT doc_id, sentence_no FROM ({Q.DOC_HITS})""")
def q_sentences_with_person(spark, sf_dir):
    tagged = RuleTagger().tag(_docs(spark, sf_dir, "doc_id", "text"), "text")
    return M.sentences_with_persons(tagged, ["doc_id"]).select("doc_id", "sentence_no")


# The oracle reads neighbours with lag/lead over a window, an independent
# formulation of the array slice used on the Spark side.
@query("context_window", f"""
  WITH s AS (SELECT doc_id, sentence_no, sents[sentence_no + 1] AS sentence FROM ({Q.DOC_SENTENCES})),
  w AS (SELECT doc_id, sentence_no, {Q.persons('sentence')} AS persons,
               lag({Q.strip('sentence')}) OVER (PARTITION BY doc_id ORDER BY sentence_no) AS prv,
               {Q.strip('sentence')} AS cur,
               lead({Q.strip('sentence')}) OVER (PARTITION BY doc_id ORDER BY sentence_no) AS nxt
        FROM s)
  SELECT doc_id, sentence_no,
         replace(array_to_string(list_filter([prv, cur, nxt], lambda x: x IS NOT NULL), ' '), chr(10), '')
           AS context
  FROM w WHERE len(persons) > 0""")
def q_context_window(spark, sf_dir):
    tagged = RuleTagger().tag(_docs(spark, sf_dir, "doc_id", "text"), "text")
    return M.sentences_with_persons(tagged, ["doc_id"]).select("doc_id", "sentence_no", "context")


@query("chunk_512", f"""
  SELECT doc_id, sentence_no, chunk_no, CAST(length(chunk) AS BIGINT) AS chunk_len, chunk
  FROM ({Q.DOC_CHUNKS})""")
def q_chunk_512(spark, sf_dir):
    df = M.person_context(_docs(spark, sf_dir, "doc_id", "text"), text_col="text", keep=["doc_id"])
    return df.select("doc_id", "sentence_no", "chunk_no",
                     F.length("chunk").cast("bigint").alias("chunk_len"), "chunk")


PERSON_CONTEXT_SQL = f"""
  SELECT doc_id, sentence_no, chunk_no, array_to_string(persons, ',') AS persons, chunk
  FROM ({Q.DOC_CHUNKS})"""


@query("person_context", PERSON_CONTEXT_SQL)
def q_person_context(spark, sf_dir):
    """Flagship: documents -> sentences -> persons -> context -> 512-char chunks."""
    df = M.person_context(_docs(spark, sf_dir, "doc_id", "text"), text_col="text", keep=["doc_id"])
    return df.select("doc_id", "sentence_no", "chunk_no",
                     M.persons_string(F.col("persons")).alias("persons"), "chunk")


# --- T1 / T2 / T3 / T4 ---------------------------------------------------------

@query("collapse_ws", f"""
  SELECT conv_id, turn, {Q.collapse('text')} AS collapsed, {Q.strip('text')} AS stripped,
         lower({Q.collapse('text')}) AS lowered
  FROM conversations""")
def q_collapse_ws(spark, sf_dir):
    c = B.table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    return c.select("conv_id", "turn", T.collapse_ws("text").alias("collapsed"),
                    T.strip_ws("text").alias("stripped"), T.lower(T.collapse_ws("text")).alias("lowered"))


# The phrase does not occur in the tables; it is put before, inside and after
# the texts of every second document, of all sites.
_PHRASE = S.BY_NAME["nessma"].boilerplate
_WITH_PHRASE_SQL = f"""CASE WHEN (doc_id // 5) % 2 = 0
  THEN '{_PHRASE} ' || art_content || ' {_PHRASE} x{_PHRASE}' ELSE art_content END"""


@query("strip_boilerplate", f"""
  SELECT doc_id, site,
         CASE WHEN site = 'nessma'
              THEN {Q.strip("replace(" + Q.collapse('art_content') + ", '" + S.BY_NAME['nessma'].boilerplate + "', '')")}
              ELSE {Q.collapse('art_content')} END AS art_content
  FROM (SELECT doc_id, site, {_WITH_PHRASE_SQL} AS art_content FROM ({B.ARTICLES_SQL}))""")
def q_strip_boilerplate(spark, sf_dir):
    a = B.articles_from_documents(_docs(spark, sf_dir, "doc_id", "text", "source"))
    marked = F.concat(F.lit(f"{_PHRASE} "), F.col("art_content"), F.lit(f" {_PHRASE} x{_PHRASE}"))
    a = a.withColumn("art_content", F.when(F.floor(F.col("doc_id") / 5) % 2 == 0, marked).otherwise(F.col("art_content")))
    return a.select("doc_id", "site", X.clean_body(F.col("art_content"), F.col("site")).alias("art_content"))


# --- D1-D6 -------------------------------------------------------------------

def _events(spark, sf_dir):
    return B.table(spark, sf_dir, "events", "event_id", "ts")


@query("date_strict", """
  SELECT event_id, variant, date_text,
         try_strptime(replace(trim(date_text), 'à', ' '), '%d/%m/%Y %H:%M') AS parsed
  FROM (SELECT event_id, unnest([0, 1]) AS variant,
               unnest([strftime(ts, '%d/%m/%Y') || ' à ' || strftime(ts, '%H:%M'),
                       strftime(ts, '%-d/%-m/%Y') || ' À ' || strftime(ts, '%-H:%M')]) AS date_text
        FROM events)""")
def q_date_strict(spark, sf_dir):
    e = _events(spark, sf_dir)
    texts = F.array(F.concat(F.date_format("ts", "dd/MM/yyyy"), F.lit(" à "), F.date_format("ts", "HH:mm")),
                    F.concat(F.date_format("ts", "d/M/yyyy"), F.lit(" À "), F.date_format("ts", "H:mm")))
    return (e.select("event_id", F.posexplode(texts).alias("variant", "date_text"))
             .select("event_id", F.col("variant").cast("bigint").alias("variant"), "date_text",
                     D.parse_strict_dmy_hm(F.col("date_text")).alias("parsed")))


def _render_free(ts):
    """Spellings of one timestamp: French, Arabic (Maghreb names, Arabic-Indic
    digits), English, numeric day-first; with weekdays, hamza-less Arabic
    months, AM/PM; the last has the hour only."""
    month = F.month(ts)
    fr = F.element_at(F.array(*[F.lit(m) for m in D.MONTHS_FR]), month)
    ar = F.element_at(F.array(*[F.lit(m) for m in D.MONTHS_AR_MAGHREB]), month)
    en = F.element_at(F.array(*[F.lit(m.capitalize()) for m in D.MONTHS_EN]), month)
    day, year, hm = F.date_format(ts, "d"), F.date_format(ts, "yyyy"), F.date_format(ts, "HH:mm")
    arabic = lambda c: F.translate(c, "0123456789", D.ARABIC_INDIC_DIGITS)
    return F.array(
        F.concat_ws(" ", day, fr, year, F.lit("à"), hm),
        F.concat_ws(" ", arabic(day), ar, arabic(year), F.lit("-"), hm),
        F.concat(en, F.lit(" "), day, F.lit(", "), year, F.lit(" "), hm),
        F.concat(F.date_format(ts, "dd/MM/yyyy"), F.lit(" "), hm),
        F.concat_ws(" ", _named(D.WEEKDAYS_FR, F.weekday(ts) + 1), day, fr, year, F.lit("à"), F.date_format(ts, "H'h'mm")),
        F.concat(_named(D.WEEKDAYS_AR, F.weekday(ts) + 1), F.lit("، "), arabic(day), F.lit(" "),
                 F.translate(_named(D.MONTHS_AR, month), "أإ", "اا"), F.lit(" "), arabic(year), F.lit(" "), hm),
        F.concat(_named([w.capitalize() for w in D.WEEKDAYS_EN], F.weekday(ts) + 1), F.lit(", "), en, F.lit(" "), day, F.lit(", "), year,
                 F.lit(" "), F.date_format(ts, "h:mm a")),
        F.concat_ws(" ", day, fr, year, F.date_format(ts, "H'h'")))


def _named(names, number):
    return F.element_at(F.array(*map(F.lit, names)), number)


_FREE_SQL = ("[strftime(ts, '%-d') || ' ' || (" + str(D.MONTHS_FR) + ")[month(ts)] || ' ' || strftime(ts, '%Y') "
             "|| ' à ' || strftime(ts, '%H:%M'), "
             f"translate(strftime(ts, '%-d'), '0123456789', '{D.ARABIC_INDIC_DIGITS}') || ' ' || ("
             + str(D.MONTHS_AR_MAGHREB) + ")[month(ts)] || ' ' || "
             f"translate(strftime(ts, '%Y'), '0123456789', '{D.ARABIC_INDIC_DIGITS}') || ' - ' || strftime(ts, '%H:%M'), "
             "(" + str([m.capitalize() for m in D.MONTHS_EN]) + ")[month(ts)] || ' ' || strftime(ts, '%-d') || ', ' "
             "|| strftime(ts, '%Y') || ' ' || strftime(ts, '%H:%M'), "
             "strftime(ts, '%d/%m/%Y') || ' ' || strftime(ts, '%H:%M'), "
             f"({D.WEEKDAYS_FR})[isodow(ts)] || ' ' || strftime(ts, '%-d') || ' ' || ({D.MONTHS_FR})[month(ts)] || ' ' || strftime(ts, '%Y') "
             "|| ' à ' || strftime(ts, '%-H') || 'h' || strftime(ts, '%M'), "
             f"({D.WEEKDAYS_AR})[isodow(ts)] || '، ' || translate(strftime(ts, '%-d'), '0123456789', '{D.ARABIC_INDIC_DIGITS}') || ' ' "
             f"|| translate(({D.MONTHS_AR})[month(ts)], 'أإ', 'اا') || ' ' || translate(strftime(ts, '%Y'), '0123456789', '{D.ARABIC_INDIC_DIGITS}') "
             "|| ' ' || strftime(ts, '%H:%M'), "
             f"({[w.capitalize() for w in D.WEEKDAYS_EN]})[isodow(ts)] || ', ' || ({[m.capitalize() for m in D.MONTHS_EN]})[month(ts)] || ' ' "
             "|| strftime(ts, '%-d') || ', ' || strftime(ts, '%Y') || ' ' || strftime(ts, '%-I:%M %p'), "
             f"strftime(ts, '%-d') || ' ' || ({D.MONTHS_FR})[month(ts)] || ' ' || strftime(ts, '%Y') || ' ' || strftime(ts, '%-H') || 'h']")


@query("date_multilingual", f"""
  SELECT event_id, variant, date_text, CASE WHEN variant = 7 THEN date_trunc('hour', ts) ELSE date_trunc('minute', ts) END AS parsed
  FROM (SELECT event_id, ts, unnest(range(0, 8)) AS variant, unnest({_FREE_SQL}) AS date_text FROM events)""")
def q_date_multilingual(spark, sf_dir):
    e = _events(spark, sf_dir)
    return (e.select("event_id", F.posexplode(_render_free(F.col("ts"))).alias("variant", "date_text"))
             .select("event_id", F.col("variant").cast("bigint").alias("variant"), "date_text",
                     D.parse_free(F.col("date_text")).alias("parsed")))


@query("date_iso_or_free", f"""
  SELECT event_id, variant, date_text, CASE WHEN variant = 0 THEN ts ELSE date_trunc('minute', ts) END AS parsed
  FROM (SELECT event_id, ts, unnest([0, 1]) AS variant,
               unnest([strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), ({_FREE_SQL})[1]]) AS date_text FROM events)""")
def q_date_iso_or_free(spark, sf_dir):
    e = _events(spark, sf_dir)
    texts = F.array(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), _render_free(F.col("ts"))[0])
    return (e.select("event_id", F.posexplode(texts).alias("variant", "date_text"))
             .select("event_id", F.col("variant").cast("bigint").alias("variant"), "date_text",
                     D.parse_iso_or_free(F.col("date_text")).alias("parsed")))


@query("json_time", """
  SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S')
         || CASE WHEN strftime(ts, '%f') <> '000000' THEN '.' || strftime(ts, '%f') ELSE '' END AS rendered
  FROM events""")
def q_json_time(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", D.render_ts(F.col("ts")).alias("rendered"))


# --- P1 / P2 / D5 / U1 / A2 / S4 / K1 / K2 -----------------------------------------

@query("add_lineage", f"""
  SELECT doc_id, site, art_category, inactive, country_code, scrapped_by, art_source, art_creation_date
  FROM ({B.ARTICLES_SQL})""")
def q_add_lineage(spark, sf_dir):
    d = _docs(spark, sf_dir, "doc_id").withColumn("site", S.site_of(F.col("doc_id")))
    out = L.add_lineage(L.add_constants(d), run_ts=B.TEST_RUN_TS)
    return out.select("doc_id", "site", "art_category", "inactive", "country_code", "scrapped_by",
                      "art_source", "art_creation_date")


@query("article_counts", f"""
  SELECT site, count(*) AS n_articles FROM ({B.ARTICLES_SQL}) GROUP BY site""")
def q_article_counts(spark, sf_dir):
    a = B.articles_from_documents(_docs(spark, sf_dir, "doc_id", "text", "source"))
    return C.count_by_site(a, "n_articles")


_JSON_COLS = ("art_url, art_title, art_published_at, art_type, art_content, art_category, inactive, "
              "country_code, scrapped_by, art_source, art_creation_date")
_ARTICLES_AS_JSON_SQL = f"""
  SELECT site, art_url, art_title, strftime(art_published_at, '%Y-%m-%d %H:%M:%S') AS art_published_at,
         art_type, art_content, art_category, inactive, country_code, scrapped_by, art_source,
         strftime(art_creation_date, '%Y-%m-%d %H:%M:%S') AS art_creation_date
  FROM ({B.ARTICLES_SQL})"""


@query("json_roundtrip", f"SELECT {_JSON_COLS} FROM ({_ARTICLES_AS_JSON_SQL})")
def q_json_roundtrip(spark, sf_dir):
    """K2 combined JSON sink then S4 scan: the values survive the boundary."""
    a = B.articles_from_documents(_docs(spark, sf_dir, "doc_id", "text", "source"))
    path = scratch_path(spark, "articles-json")
    J.write_articles_json(a.select(*L.ARTICLE_FIELDS), path, partition_by=None)
    return J.read_articles_json(spark, path)


@query("json_arrays", f"SELECT {_JSON_COLS} FROM ({_ARTICLES_AS_JSON_SQL})")
def q_json_arrays(spark, sf_dir):
    """K2 as the reference writes it, one array a file, then S4 by byte ranges."""
    a = B.articles_from_documents(_docs(spark, sf_dir, "doc_id", "text", "source"))
    path = scratch_path(spark, "articles-arrays")
    JA.write_json_arrays(J.to_json_record(a.select(*L.ARTICLE_FIELDS)), path)
    return JA.read_json_arrays(spark, path, J.ARTICLE_JSON, range_bytes=1 << 20)


@query("union_sites", f"""
  SELECT CAST(list_position({list(S.UNION_ORDER)}, site) - 1 AS INTEGER) AS source_ord, {_JSON_COLS}
  FROM ({_ARTICLES_AS_JSON_SQL})""")
def q_union_sites(spark, sf_dir):
    """K1 per-site JSON sink (one write), S4 scan of all sites with partition
    discovery, U1 order: only webdo files carry art_type; others get NULL."""
    a = B.articles_from_documents(_docs(spark, sf_dir, "doc_id", "text", "source"))
    path = scratch_path(spark, "site-json")
    J.write_articles_json(a.select("site", *L.ARTICLE_FIELDS), path, partition_by="site")
    return C.append_order(J.read_site_json(spark, path)).select("source_ord", *L.ARTICLE_FIELDS)


# --- N4 / N5 / P3 / P4 / C1 / C2 / S5 --------------------------------------------

# Test lexicon (word -> integer weight) chosen among words that occur in the
# driver's invented text; a real deployment passes its own lexicon or model.
FIXTURE_LEXICON = {"rewh": 2, "orre": 1, "inoran": -1, "thatin": -2, "ononst": 1, "hehely": -1,
                   "orantion": 2, "and": 1, "of": -1, "to": 1, "der": 1, "und": -1, "that": -1,
                   "license": -2, "licensed": -1, "version": 1, "que": 1, "de": -1, "sich": 2,
                   "under": -2, "the": 0}
# Fixed test key: the public Fernet specification's example key.
FIXTURE_KEY = "cw_0x689RpI-jtRR7oE8h_eQsKImvJapLeSbXpwF4e4="

_LEX_SQL = "(VALUES " + ", ".join(f"('{k}', {v})" for k, v in FIXTURE_LEXICON.items()) + ") AS lex(word, weight)"
_SCORED_SQL = f"""
  SELECT c.doc_id, c.sentence_no, c.chunk_no, c.persons, c.chunk,
         CAST(coalesce(h.n, 0) AS BIGINT) AS hits,
         CAST(CASE WHEN coalesce(h.n, 0) = 0 THEN 3
                   WHEN 5 * h.s < -3 * h.n THEN 1
                   WHEN 5 * h.s < -h.n THEN 2
                   WHEN 5 * h.s <= h.n THEN 3
                   WHEN 5 * h.s <= 3 * h.n THEN 4 ELSE 5 END AS BIGINT) AS stars
  FROM ({Q.DOC_CHUNKS}) c
  LEFT JOIN (SELECT doc_id, sentence_no, chunk_no, sum(weight) AS s, count(*) AS n
             FROM (SELECT doc_id, sentence_no, chunk_no,
                          unnest(regexp_extract_all(lower(chunk), '\\p{{L}}+')) AS w FROM ({Q.DOC_CHUNKS})) t
             JOIN {_LEX_SQL} ON t.w = lex.word
             GROUP BY ALL) h
  USING (doc_id, sentence_no, chunk_no)"""
_LABEL_SQL = "CASE stars " + " ".join(
    f"WHEN {i} THEN '{v}'" for i, v in enumerate(SE.STAR_LABELS.values(), start=1)) + " END"


def _mentions_clear(spark, sf_dir, with_meta: bool):
    docs = _docs(spark, sf_dir, "doc_id", "text", "source")
    arts = B.articles_from_documents(docs) if with_meta else docs.withColumnRenamed("text", "art_content")
    keep = [c for c in arts.columns if c not in ("art_content", "source")]
    rows, _ = MJ.mention_rows(arts.select(*keep, "art_content"), SE.LexiconScorer(FIXTURE_LEXICON))
    return rows


@query("chunk_sentiment", f"SELECT doc_id, sentence_no, chunk_no, hits, stars FROM ({_SCORED_SQL})")
def q_chunk_sentiment(spark, sf_dir):
    pc = M.person_context(_docs(spark, sf_dir, "doc_id", "text"), text_col="text", keep=["doc_id"])
    return SE.LexiconScorer(FIXTURE_LEXICON).score(pc).select("doc_id", "sentence_no", "chunk_no", "hits", "stars")


@query("star_label", f"SELECT doc_id, sentence_no, chunk_no, {_LABEL_SQL} AS sentiment FROM ({_SCORED_SQL})")
def q_star_label(spark, sf_dir):
    pc = M.person_context(_docs(spark, sf_dir, "doc_id", "text"), text_col="text", keep=["doc_id"])
    return SE.add_sentiment(pc, SE.LexiconScorer(FIXTURE_LEXICON)).select(
        "doc_id", "sentence_no", "chunk_no", "sentiment")


_META_COLS = ("doc_id, site, art_url, art_title, art_published_at, art_type, art_category, inactive, "
              "country_code, scrapped_by, art_source, art_creation_date")


@query("attach_metadata", f"""
  SELECT {_META_COLS}, sentence_no, chunk_no, array_to_string(persons, ',') AS Persons,
         chunk AS Context, {_LABEL_SQL} AS Sentiment
  FROM ({_SCORED_SQL}) m JOIN ({B.ARTICLES_SQL}) a USING (doc_id)""")
def q_attach_metadata(spark, sf_dir):
    """P3 (content dropped) + P4 (metadata carried through, no join)."""
    return _mentions_clear(spark, sf_dir, with_meta=True)


@query("encrypt_roundtrip", f"""
  SELECT doc_id, sentence_no, chunk_no, array_to_string(persons, ',') AS Persons, chunk AS Context,
         {_LABEL_SQL} AS Sentiment,
         CAST(((57 + 16 * (strlen(chunk) // 16 + 1) + 2) // 3) * 4 AS BIGINT) AS context_token_len,
         'gAAAAA' AS token_prefix
  FROM ({_SCORED_SQL})""")
def q_encrypt_roundtrip(spark, sf_dir):
    """C1 then C2 on the three mention fields: decrypt(encrypt(x)) == x."""
    clear = _mentions_clear(spark, sf_dir, with_meta=False)
    enc = CR.encrypt_columns(clear, ["Persons", "Context", "Sentiment"], FIXTURE_KEY)
    return enc.select("doc_id", "sentence_no", "chunk_no",
                      *[CR.decrypt(F.col(c), FIXTURE_KEY).alias(c) for c in ("Persons", "Context", "Sentiment")],
                      F.length("Context").cast("bigint").alias("context_token_len"),
                      F.substring("Context", 1, 6).alias("token_prefix"))


@query("decrypt_invalid", f"""
  SELECT doc_id, '{CR.INVALID_TOKEN_MESSAGE}' AS tampered, '{CR.INVALID_TOKEN_MESSAGE}' AS other_key,
         text AS stray_character, '{CR.INVALID_TOKEN_MESSAGE}' AS not_a_token
  FROM documents""")
def q_decrypt_invalid(spark, sf_dir):
    """C2 failure paths: a changed body character, another key, a text that is
    no token. A character outside the alphabet is skipped, as url-safe
    base64 decoding does."""
    d = _docs(spark, sf_dir, "doc_id", "text").withColumn("plain", F.col("text"))
    tok = CR.encrypt_columns(d, ["text"], FIXTURE_KEY).withColumnRenamed("text", "tok")
    c30 = F.substring("tok", 30, 1)
    tampered = F.overlay("tok", F.when(c30 == "A", F.lit("B")).otherwise(F.lit("A")), 30, 1)
    other = "TUFMe0YvZm9MTGM4V2R2bnFrWU5ZdjVRb1ZqNGhDTWM="
    return tok.select("doc_id", CR.decrypt(tampered, FIXTURE_KEY).alias("tampered"),
                      CR.decrypt(F.col("tok"), other).alias("other_key"),
                      CR.decrypt(F.concat(F.lit("!"), F.col("tok")), FIXTURE_KEY).alias("stray_character"),
                      CR.decrypt(F.col("plain"), FIXTURE_KEY).alias("not_a_token"))


@query("sample_mention", f"""
  SELECT doc_id, sentence_no, chunk_no, array_to_string(persons, ',') AS Persons, chunk AS Context,
         {_LABEL_SQL} AS Sentiment
  FROM ({_SCORED_SQL}) ORDER BY doc_id, sentence_no, chunk_no LIMIT 1""")
def q_sample_mention(spark, sf_dir):
    """S5 find_one + decrypt: the first mention. It is taken from the unscored
    chunks, so one row is scored, encrypted and decrypted."""
    pc = M.person_context(_docs(spark, sf_dir, "doc_id", "text"), text_col="text", keep=["doc_id"])
    one = SE.add_sentiment(J.sample(pc, ["doc_id", "sentence_no", "chunk_no"]), SE.LexiconScorer(FIXTURE_LEXICON))
    clear = one.select("doc_id", "sentence_no", "chunk_no", M.persons_string(F.col("persons")).alias("Persons"),
                       F.col("chunk").alias("Context"), F.col("sentiment").alias("Sentiment"))
    enc = CR.encrypt_columns(clear, ["Persons", "Context", "Sentiment"], FIXTURE_KEY)
    return enc.select("doc_id", "sentence_no", "chunk_no",
                      *[CR.decrypt(F.col(c), FIXTURE_KEY).alias(c) for c in ("Persons", "Context", "Sentiment")])


# --- S1 / S2 / S3 / X1-X9 / A1 -------------------------------------------------------

def _crawl(spark, sf_dir):
    return B.crawl_from_pages(B.table(spark, sf_dir, "pages", "page_id", "url", "html"))


_TEMPLATE_SQL = B._case("list_template")


def _frontier(spark, sf_dir):
    """S1 with depth = number of landed pages per site."""
    depth = C.count_by_site(_crawl(spark, sf_dir), "n_pages")
    return FR.frontier(depth)


@query("frontier_urls", f"""
  SELECT site, page_no, replace({_TEMPLATE_SQL}, '{{i}}', CAST(page_no AS VARCHAR)) AS url
  FROM (SELECT site, unnest(range(1, count(*) + 1)) AS page_no FROM ({B.CRAWL_SQL}) GROUP BY site)""")
def q_frontier_urls(spark, sf_dir):
    return _frontier(spark, sf_dir)


@query("crawl_pages", f"""
  SELECT r.site, r.url, c.status_code, CAST(length(c.html) AS BIGINT) AS html_chars
  FROM (SELECT site, replace({_TEMPLATE_SQL}, '{{i}}', CAST(page_no AS VARCHAR)) AS url
        FROM (SELECT site, unnest(range(1, count(*) + 1)) AS page_no FROM ({B.CRAWL_SQL}) GROUP BY site)
        UNION ALL SELECT site, url FROM ({B.CRAWL_SQL})) r
  LEFT JOIN ({B.CRAWL_SQL}) c ON r.url = c.url""")
def q_crawl_pages(spark, sf_dir):
    """Requested URLs (list frontier + article URLs) left-joined to the
    landed crawl; a NULL status is a failed fetch."""
    crawl = _crawl(spark, sf_dir)
    requests = _frontier(spark, sf_dir).select("site", "url").unionByName(crawl.select("site", "url"))
    lengths = crawl.withColumn("html_chars", F.length("html").cast("bigint"))
    return FR.fetch(requests, lengths, "status_code", "html_chars").select("site", "url", "status_code", "html_chars")


@query("status_ok", f"SELECT page_id, site, url FROM ({B.CRAWL_SQL}) WHERE status_code = 200")
def q_status_ok(spark, sf_dir):
    return FR.status_ok(_crawl(spark, sf_dir)).select("page_id", "site", "url")


_LINKS_SQL = f"""
  SELECT site, page_id AS page_no, CAST(i + 1 AS BIGINT) AS card_no, hrefs[i + 1] AS href
  FROM (SELECT site, page_id, hrefs, unnest(range(0, len(hrefs))) AS i
        FROM (SELECT site, page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS hrefs
              FROM ({B.CRAWL_SQL})))"""


def _links(spark, sf_dir):
    list_pages = _crawl(spark, sf_dir).select("site", F.col("page_id").alias("page_no"), "html")
    return X.extract_links(list_pages, B.pages_profiles())


@query("page_links", f"SELECT site, page_no, card_no, href, false AS failed FROM ({_LINKS_SQL})")
def q_page_links(spark, sf_dir):
    """X1 on every landed page (list pages are parsed whatever their status)."""
    return _links(spark, sf_dir)


@query("page_links_by_class", f"SELECT site, page_no, card_no, href, false AS failed FROM ({_LINKS_SQL})")
def q_page_links_by_class(spark, sf_dir):
    """X1 with class selectors, as the five sites have them."""
    pages = B.with_classes(_crawl(spark, sf_dir)).select("site", F.col("page_id").alias("page_no"), "html")
    return X.extract_links(pages, B.classed_profiles())


# Some list pages have no container (bindings.with_broken_pages); a
# site's listing ends there. The oracle states the rule as a running flag.
_BROKEN_SQL = f"""
  SELECT page_id, url, status_code, site,
         CASE WHEN page_id % 97 = 96 THEN replace(replace(html, '<nav>', '<section>'), '</nav>', '</section>')
              WHEN page_id % 7 = 1 THEN replace(replace(html, '<h1>', '<h2>'), '</h1>', '</h2>')
              WHEN page_id % 7 = 3 THEN replace(replace(html, '<article>', '<section>'), '</article>', '</section>')
              ELSE html END AS html
  FROM ({B.CRAWL_SQL})"""
_UNTIL_SQL = f"""
  SELECT site, page_no, card_no, href FROM ({_LINKS_SQL}) l
  SEMI JOIN (SELECT page_id FROM (
      SELECT page_id, max(CASE WHEN html LIKE '%<nav>%' THEN 0 ELSE 1 END)
                        OVER (PARTITION BY site ORDER BY page_id) AS stopped FROM ({_BROKEN_SQL})) WHERE stopped = 0) ok
    ON ok.page_id = l.page_no"""


def _broken_links(spark, sf_dir):
    pages = B.with_broken_pages(_crawl(spark, sf_dir)).select("site", F.col("page_id").alias("page_no"), "html")
    return X.extract_links(pages, B.pages_profiles())


@query("links_until_error", _UNTIL_SQL)
def q_links_until_error(spark, sf_dir):
    return X.links_until_error(_broken_links(spark, sf_dir)).select("site", "page_no", "card_no", "href")


@query("links_failed", f"""
  SELECT site, page_id AS page_no, 0::BIGINT AS card_no FROM ({_BROKEN_SQL}) WHERE html NOT LIKE '%<nav>%'""")
def q_links_failed(spark, sf_dir):
    """The failure flag, one row for each page without the container."""
    return _broken_links(spark, sf_dir).where("failed").select("site", "page_no", "card_no")


@query("absolute_links", f"""
  SELECT site, page_no, card_no, {B._case('link_prefix')} || href AS art_url FROM ({_LINKS_SQL})""")
def q_absolute_links(spark, sf_dir):
    return X.absolute_links(_links(spark, sf_dir).where("not failed")).select(
        "site", "page_no", "card_no", "art_url")


@query("link_counts", f"SELECT site, count(*) AS n_links FROM ({_UNTIL_SQL}) GROUP BY site")
def q_link_counts(spark, sf_dir):
    return C.count_by_site(X.links_until_error(_broken_links(spark, sf_dir)), "n_links")


def _fields(spark, sf_dir):
    pages = FR.status_ok(_crawl(spark, sf_dir))
    return X.extract_fields(pages, B.pages_profiles())


_TITLE_SQL = f"lower({Q.collapse(B.html_text_sql(chr(39).join(['regexp_extract(html, ', '(?s)<h1>(.*?)</h1>', ', 1)'])))})"


@query("page_title", f"""
  SELECT site, url AS art_url, {_TITLE_SQL} AS art_title FROM ({B.CRAWL_SQL}) WHERE status_code = 200""")
def q_page_title(spark, sf_dir):
    """X4 (+T1, T3): first h1, visible text, whitespace collapsed, lower case."""
    return _fields(spark, sf_dir).select("site", "art_url",
                                         T.lower(T.collapse_ws("title_raw")).alias("art_title"))


@query("body_paragraphs", f"""
  SELECT site, url AS art_url, {B.paragraphs_sql('html')} AS art_content
  FROM ({B.CRAWL_SQL}) WHERE status_code = 200""")
def q_body_paragraphs(spark, sf_dir):
    """Paragraphs of <article> but the last, text nodes stripped, joined."""
    return _fields(spark, sf_dir).select("site", "art_url",
                                         X.clean_body(F.col("body_raw"), F.col("site")).alias("art_content"))


@query("fields_by_class", f"""
  SELECT site, url AS art_url, {_TITLE_SQL} AS art_title, {B.paragraphs_sql('html')} AS art_content
  FROM ({B.CRAWL_SQL}) WHERE status_code = 200""")
def q_fields_by_class(spark, sf_dir):
    """X4 and X6c with class selectors, as the five sites have them."""
    fields = X.extract_fields(FR.status_ok(B.with_classes(_crawl(spark, sf_dir))), B.classed_profiles())
    return fields.select("site", "art_url", T.lower(T.collapse_ws("title_raw")).alias("art_title"),
                         X.clean_body(F.col("body_raw"), F.col("site")).alias("art_content"))


@query("reject_split", f"""
  SELECT site, url AS art_url,
         CASE WHEN html NOT LIKE '%<h1>%' THEN 'missing title'
              WHEN html NOT LIKE '%<article>%<p>%</article>%' THEN 'missing body' END AS reject_reason
  FROM ({_BROKEN_SQL}) WHERE status_code = 200""")
def q_reject_split(spark, sf_dir):
    """Accepted rows (reason NULL) plus rejects with their reason."""
    pages = FR.status_ok(B.with_broken_pages(_crawl(spark, sf_dir)))
    fields = X.extract_fields(pages, B.pages_profiles())
    return X.flag_fields(fields, B.pages_profiles()).select("site", "art_url", "reject_reason")


# Elements found by class, put into the pages by
# bindings.with_class_elements; these go through the element tree.
_ARTICLE_TEXT_SQL = B.html_text_sql("regexp_extract(html, '(?s)<article>(.*?)</article>', 1)")
_CLASS_SQL = f"SELECT *, {Q.strip(_ARTICLE_TEXT_SQL)} AS body FROM ({B.CRAWL_SQL}) WHERE status_code = 200"


def _class_fields(spark, sf_dir, body_kind):
    pages = FR.status_ok(B.with_class_elements(_crawl(spark, sf_dir)))
    return X.extract_fields(pages, B.class_profiles(body_kind))


@query("page_date", f"""
  SELECT site, url AS art_url, TIMESTAMP '{B.PUBLISHED_BASE}' + to_minutes(page_id) AS art_published_at FROM ({_CLASS_SQL})""")
def q_page_date(spark, sf_dir):
    """The date element's text, parsed."""
    return _class_fields(spark, sf_dir, "one").select("site", "art_url", D.parse_free(F.col("date_text")).alias("art_published_at"))


@query("page_category", f"""
  SELECT site, url AS art_url, 'topic ' || CAST(page_id % 7 AS VARCHAR) AS art_type FROM ({_CLASS_SQL})""")
def q_page_category(spark, sf_dir):
    """The category element's text."""
    return _class_fields(spark, sf_dir, "one").select("site", "art_url", F.col("type_raw").alias("art_type"))


@query("body_one", f"SELECT site, url AS art_url, body FROM ({_CLASS_SQL})")
def q_body_one(spark, sf_dir):
    """All visible text of one element found by its whole class attribute."""
    return _class_fields(spark, sf_dir, "one").select("site", "art_url", F.col("body_raw").alias("body"))


@query("body_two", f"""
  SELECT site, url AS art_url, 'No ' || CAST(page_id AS VARCHAR) || body AS body FROM ({_CLASS_SQL})""")
def q_body_two(spark, sf_dir):
    """The texts of two elements, glued."""
    return _class_fields(spark, sf_dir, "two").select("site", "art_url", F.col("body_raw").alias("body"))


# S1, S2, X1-X3, X9 in one job: list pages are built from the pages' own URLs
# (ten links each), and the articles are exactly the listed ones.
_PER_LIST = 10
_LISTED_SQL = f"""
  SELECT site, url, page_id // 5 // {_PER_LIST} + 1 AS page_no FROM ({B.CRAWL_SQL})"""
_DEPTH_SQL = f"SELECT site, max(page_no) AS depth FROM ({_LISTED_SQL}) GROUP BY site"


def _list_crawl(crawl):
    """Landed list pages and article pages of the same tables."""
    page_no = (F.floor(F.floor(F.col("page_id") / 5) / _PER_LIST) + 1).cast("bigint")
    links = crawl.select("site", "page_id", page_no.alias("page_no"), "url")
    item = F.concat(F.lit('<li><a href="'), F.replace(F.col("url"), F.lit("&"), F.lit("&amp;")), F.lit('">x</a></li>'))
    lists = (links.groupBy("site", "page_no").agg(F.array_sort(F.collect_list(F.struct("page_id", item.alias("li")))).alias("li"))
                  .withColumn("html", F.concat(F.lit("<nav><ul>"), F.array_join(F.col("li.li"), ""), F.lit("</ul></nav>"))))
    depth = lists.groupBy("site").agg(F.max("page_no").alias("n_pages"))
    tmpl, prefix = B.site_lookup(F.col("site"), "list_template"), B.site_lookup(F.col("site"), "link_prefix")
    url = F.replace(tmpl, F.lit("{i}"), F.col("page_no").cast("string"))
    # a template without a page number has one landed page, the first
    landed = lists.where(tmpl.contains("{i}") | (F.col("page_no") == 1)).select("site", url.alias("url"), F.lit(200).alias("status_code"), "html")
    articles = crawl.select("site", F.concat(prefix, F.col("url")).alias("url"), "status_code", "html")
    return depth, landed.unionByName(articles)


@query("articles_from_links", f"""
  WITH listed AS (SELECT site, url, page_no FROM ({_LISTED_SQL})),
  requests AS (SELECT l.site, {B._case('link_prefix', 'l.site')} || l.url AS art_url
               FROM ({_DEPTH_SQL}) d, unnest(range(1, d.depth + 1)) r(n)
               JOIN listed l ON l.site = d.site
                AND l.page_no = CASE WHEN {B._case('list_template', 'd.site')} LIKE '%{{i}}%' THEN r.n ELSE 1 END),
  pages AS (SELECT {B._case('link_prefix')} || url AS art_url, status_code, html FROM ({B.CRAWL_SQL}))
  SELECT r.site, r.art_url, {_TITLE_SQL} AS art_title, {B.paragraphs_sql('html')} AS art_content
  FROM requests r JOIN pages p USING (art_url) WHERE p.status_code = 200""")
def q_articles_from_links(spark, sf_dir):
    """Frontier -> list pages -> links -> stop rule -> article pages -> fields.
    A site whose template has no page number lists its first page again and
    again, and so repeats its articles."""
    depth, crawl = _list_crawl(_crawl(spark, sf_dir))
    arts, _ = AJ.crawl_job(depth, crawl, B.pages_profiles(), run_ts=B.TEST_RUN_TS)
    return arts.select("site", "art_url", "art_title", "art_content")


@query("articles_from_pages", f"""
  SELECT site, url AS art_url, {_TITLE_SQL} AS art_title, CAST(NULL AS TIMESTAMP) AS art_published_at,
         CAST(NULL AS VARCHAR) AS art_type, {B.paragraphs_sql('html')} AS art_content,
         '{S.ART_CATEGORY}' AS art_category, {str(S.INACTIVE).lower()} AS inactive,
         '{S.COUNTRY_CODE}' AS country_code, {B._case('scrapped_by')} AS scrapped_by,
         {B._case('art_source')} AS art_source, TIMESTAMP '{B.TEST_RUN_TS}' AS art_creation_date
  FROM ({B.CRAWL_SQL}) WHERE status_code = 200""")
def q_articles_from_pages(spark, sf_dir):
    """The extraction job end to end (translation aside): status filter,
    fields, cleaning, dates, constants, lineage. No date or category element
    exists in these pages, so both are NULL and the rows are kept."""
    arts, _ = AJ.articles_job(_crawl(spark, sf_dir), B.pages_profiles(), run_ts=B.TEST_RUN_TS)
    return arts.select("site", *L.ARTICLE_FIELDS)


# --- N7 translation memory --------------------------------------------------------

def _memory(spark, sf_dir):
    """A memory left by an earlier run: the documents that have quality labels
    were translated then (by the marker provider below)."""
    d = _docs(spark, sf_dir, "doc_id", "text", "lang").filter(F.col("lang") != "en")
    seen = B.table(spark, sf_dir, "labels", "doc_id").distinct()
    return (d.join(seen, "doc_id", "left_semi")
             .select(TR.tm_key(F.col("lang"), F.col("text")).alias("key"),
                     F.concat(F.lit("["), F.col("lang"), F.lit("->en] "), F.col("text")).alias("text_en"))
             .dropDuplicates(["key"]))


_TM_SQL = """
  SELECT DISTINCT sha256(lang || chr(1) || text) AS key, '[' || lang || '->en] ' || text AS text_en
  FROM documents WHERE lang <> 'en' AND doc_id IN (SELECT doc_id FROM labels)"""


@query("translate_hits", f"""
  SELECT d.doc_id, d.lang, CASE WHEN d.lang = 'en' THEN d.text ELSE tm.text_en END AS text_en,
         tm.text_en IS NOT NULL AS from_memory
  FROM documents d LEFT JOIN ({_TM_SQL}) tm
    ON d.lang <> 'en' AND tm.key = sha256(d.lang || chr(1) || d.text)""")
def q_translate_hits(spark, sf_dir):
    d = _docs(spark, sf_dir, "doc_id", "text", "lang")
    out = TR.apply_memory(d, _memory(spark, sf_dir), "text", "lang")
    return out.select("doc_id", "lang", "text_en", "from_memory")


@query("translate_misses", f"""
  SELECT key, any_value(lang) AS lang, CAST(count(*) AS BIGINT) AS n_rows
  FROM (SELECT sha256(lang || chr(1) || text) AS key, lang FROM documents WHERE lang <> 'en')
  WHERE key NOT IN (SELECT key FROM ({_TM_SQL}))
  GROUP BY key""")
def q_translate_misses(spark, sf_dir):
    d = _docs(spark, sf_dir, "doc_id", "text", "lang")
    return TR.memory_misses(d, _memory(spark, sf_dir), "text", "lang").select("key", "lang", "n_rows")


def _marker():
    """The provider of these queries: marks a text with its language."""
    return lambda texts, lang: [f"[{lang}->en] {t}" for t in texts]


@query("translate_writeback", """
  SELECT doc_id, lang, CASE WHEN lang = 'en' THEN text ELSE '[' || lang || '->en] ' || text END AS text_en,
         lang <> 'en' AS from_memory
  FROM documents""")
def q_translate_writeback(spark, sf_dir):
    """N7 whole: memory hits, each distinct miss translated once and appended
    to the stored memory, English passed through."""
    d = _docs(spark, sf_dir, "doc_id", "text", "lang")
    done, _ = TR.translate_with_memory(d, _memory(spark, sf_dir), "text", "lang", _marker, scratch_path(spark, "memory"))
    return done.select("doc_id", "lang", "text_en", "from_memory")


# --- N2a gazetteer -----------------------------------------------------------------

# Test gazetteer: names that occur in the driver's invented text, with a
# one-word name inside a two-word one to exercise leftmost-longest matching.
FIXTURE_NAMES = ["Stteen Erachtz", "Stteen", "Apache License", "General Public License",
                 "Thshea Stteä", "Of Thblewh", "Erachtz", "under the GNU General Public-License", "Rights' reserved"]


def _gazetteer_sql() -> str:
    g = GazetteerTagger(FIXTURE_NAMES)
    names = "[" + ", ".join("'" + n.replace("'", "''") + "'" for n in g.names) + "]"

    def gram(k):
        return f"array_to_string(toks[i + 1 : i + {k}], ' ')"

    longest = "CASE " + " ".join(
        f"WHEN i + {k} <= len(toks) AND list_contains({names}, lower({gram(k)})) THEN {k}"
        for k in range(g.max_words, 0, -1)) + " ELSE 0 END"
    step = (f"CASE WHEN i >= acc.nxt AND ({longest}) > 0 THEN "
            f"{{'nxt': i + ({longest}), 'out': list_append(acc.out, array_to_string(toks[i + 1 : i + ({longest})], ' '))}} "
            f"ELSE acc END")
    return f"""
  SELECT doc_id, sentence_no, array_to_string(persons, ',') AS persons, CAST(len(persons) AS BIGINT) AS n_persons
  FROM (SELECT doc_id, sentence_no,
               (list_reduce(range(0, len(toks)), lambda acc, i: {step},
                            {{'nxt': 0::BIGINT, 'out': []::VARCHAR[]}})).out AS persons
        FROM (SELECT doc_id, sentence_no, regexp_extract_all(sents[sentence_no + 1], '\\p{{L}}+') AS toks
              FROM ({Q.DOC_SENTENCES})))
  WHERE len(persons) > 0"""


@query("persons_gazetteer", _gazetteer_sql())
def q_persons_gazetteer(spark, sf_dir):
    tagged = GazetteerTagger(FIXTURE_NAMES).tag(_docs(spark, sf_dir, "doc_id", "text"), "text")
    hits = M.sentences_with_persons(tagged, ["doc_id"])
    return hits.select("doc_id", "sentence_no", M.persons_string(F.col("persons")).alias("persons"),
                       F.size("persons").cast("bigint").alias("n_persons"))



@query("mentions_store", f"""
  SELECT {_META_COLS}, sentence_no, chunk_no, array_to_string(persons, ',') AS Persons,
         chunk AS Context, {_LABEL_SQL} AS Sentiment
  FROM ({_SCORED_SQL}) m JOIN ({B.ARTICLES_SQL}) a USING (doc_id)""")
def q_mentions_store(spark, sf_dir):
    """The whole mentions job: encrypted rows appended to the store table
    (K3, partitioned by art_source), read back and decrypted (S5's check)."""
    docs = _docs(spark, sf_dir, "doc_id", "text", "source")
    arts = B.articles_from_documents(docs).drop("source")
    path = scratch_path(spark, "mentions")
    MJ.mentions_job(arts, FIXTURE_KEY, SE.LexiconScorer(FIXTURE_LEXICON), out_path=path)
    stored = spark.read.parquet(path)
    return stored.select(*[c for c in stored.columns if c not in MJ.MENTION_FIELDS],
                         *[CR.decrypt(F.col(c), FIXTURE_KEY).alias(c) for c in MJ.MENTION_FIELDS])


# N2, a name table of any size: the first words of all documents, as names of two
# and three words that contain and overlap each other.
_NAME_TABLE_SQL = """
  SELECT DISTINCT lower(array_to_string(n, ' ')) AS g
  FROM (SELECT unnest([ws[1:2], ws[2:3], ws[1:3]]) AS n FROM (SELECT regexp_extract_all(text, '\\p{L}+') AS ws FROM documents))
  WHERE len(n) > 1"""


# Sentences' words ``toks`` and the places of the table's names in them.
_NAMES_FOUND_SQL = f"""
  names AS ({_NAME_TABLE_SQL}),
  s AS (SELECT doc_id, sentence_no, regexp_extract_all(sents[sentence_no + 1], '\\p{{L}}+') AS toks FROM ({Q.DOC_SENTENCES})),
  g AS (SELECT doc_id, sentence_no, i, k, lower(array_to_string(toks[i + 1 : i + k], ' ')) AS g
        FROM (SELECT *, unnest(range(0, len(toks))) AS i FROM s), (VALUES (2), (3)) v(k) WHERE i + k <= len(toks)),
  c AS (SELECT doc_id, sentence_no, list(struct_pack(i, k) ORDER BY i) AS c
        FROM (SELECT doc_id, sentence_no, i, max(k) AS k FROM g SEMI JOIN names USING (g) GROUP BY ALL) GROUP BY ALL)"""


@query("persons_automaton", f"""
  WITH {_NAMES_FOUND_SQL}
  SELECT doc_id, sentence_no, array_to_string(persons, ',') AS persons, CAST(len(persons) AS BIGINT) AS n_persons
  FROM (SELECT doc_id, sentence_no,
               list_reduce(c, lambda acc, x: CASE WHEN x.i >= acc.nxt THEN
                   {{'nxt': x.i + x.k, 'out': list_append(acc.out, array_to_string(toks[x.i + 1 : x.i + x.k], ' '))}} ELSE acc END,
                   {{'nxt': 0::BIGINT, 'out': []::VARCHAR[]}}).out AS persons
        FROM c JOIN s USING (doc_id, sentence_no))""")
def q_persons_automaton(spark, sf_dir):
    """N2 with the names in a table: one automaton, matched on the map side."""
    docs = _docs(spark, sf_dir, "doc_id", "text")
    hits = M.sentences_with_persons(AutomatonTagger(_name_table(docs)).tag(docs, "text"), ["doc_id"])
    return hits.select("doc_id", "sentence_no", M.persons_string(F.col("persons")).alias("persons"),
                       F.size("persons").cast("bigint").alias("n_persons"))


def _name_table(docs):
    start = F.regexp_extract("text", r"^(?:\P{L}*+\p{L}++){0,3}", 0)      # only the first three words are looked for
    words = F.regexp_extract_all(start, F.lit(WORD), 0)
    return (docs.select(words.alias("w")).select(F.explode(F.array(F.slice("w", 1, 2), F.slice("w", 2, 2), F.slice("w", 1, 3))).alias("n"))
            .where(F.size("n") > 1).select(F.array_join("n", " ").alias("name")))


# N2 by a hidden Markov model, counted from the table's names in all texts. Tags and
# paths are strings of the digits 0 to 2; 3 is before and after a sentence.
def _step_sql(now: int) -> str:
    """Cost and path of the cheapest way on to tag ``now``."""
    def way(before):
        return f"{{'c': acc[{before + 1}].c + st.s{before}{now} + x.e[{now + 1}], 'p': acc[{before + 1}].p || '{now}'}}"
    least = f"least({', '.join(f'acc[{b + 1}].c + st.s{b}{now}' for b in range(SQ.TAGS))})"
    first, second, third = (way(b) for b in range(SQ.TAGS))
    return (f"CASE WHEN acc[1].c + st.s0{now} = {least} THEN {first} WHEN acc[2].c + st.s1{now} = {least} THEN {second} ELSE {third} END")


def _sequence_sql() -> str:
    never = {(SQ.OUTSIDE, SQ.LATER), (SQ.EDGE, SQ.LATER)}
    steps = ", ".join(f"{SQ.NEVER if (a, b) in never else f'max(cost) FILTER (before = {a} AND tag = {b})'} AS s{a}{b}"
                      for a in range(SQ.TAGS + 1) for b in range(SQ.TAGS + 1))
    return f"""
  WITH {_NAMES_FOUND_SQL},
  k AS (SELECT doc_id, sentence_no,
               list_reduce(c, lambda acc, x: CASE WHEN x.i >= acc.nxt THEN {{'nxt': x.i + x.k, 'out': acc.out || repeat('0', CAST(x.i - acc.nxt AS BIGINT)) || '1' || repeat('2', CAST(x.k - 1 AS BIGINT))}}
                           ELSE acc END, {{'nxt': 0::BIGINT, 'out': ''}}).out AS tags FROM c),
  w AS (SELECT doc_id, sentence_no, i, toks[i + 1] AS w, CAST(coalesce(nullif(substr(tags, CAST(i + 1 AS BIGINT), 1), ''), '0') AS INT) AS tag
        FROM (SELECT *, unnest(range(0, len(toks))) AS i FROM s LEFT JOIN k USING (doc_id, sentence_no))),
  x AS (SELECT doc_id, sentence_no, i, tag, substr(md5(w), 1, {SQ.HEX}) AS bucket,
               CASE WHEN regexp_matches(w, '^\\p{{Lu}}$') THEN 0 WHEN regexp_matches(w, '^\\p{{Lu}}+$') THEN 1 WHEN regexp_matches(w, '^\\p{{Lu}}') THEN 2 ELSE 3 END
                 + CASE WHEN i = 0 THEN 4 ELSE 0 END AS shape,
               coalesce(lag(tag) OVER o, 3) AS before, lead(tag) OVER o IS NULL AS last
        FROM w WINDOW o AS (PARTITION BY doc_id, sentence_no ORDER BY i)),
  pairs AS (SELECT before, tag, count(*) AS n FROM (SELECT before, tag FROM x UNION ALL SELECT tag, 3 FROM x WHERE last) GROUP BY ALL),
  st AS (SELECT {steps} FROM (SELECT before, tag, CAST(floor(-1000 * ln((coalesce(n, 0) + 1.0) / (sum(coalesce(n, 0)) OVER (PARTITION BY before) + {SQ.TAGS + 1})) + 0.5) AS BIGINT) AS cost
                 FROM (SELECT CAST(a.range AS INT) AS before, CAST(b.range AS INT) AS tag FROM range(4) a, range(4) b) LEFT JOIN pairs USING (before, tag))),
  often AS (SELECT bucket FROM x GROUP BY bucket HAVING count(*) >= {SQ.RARE}),
  y AS (SELECT x.*, CASE WHEN o.bucket IS NULL THEN CAST(shape AS VARCHAR) ELSE 'w' || x.bucket END AS sym FROM x LEFT JOIN often o USING (bucket)),
  size AS (SELECT (SELECT count(*) FROM often) + {SQ.SHAPES} AS symbols, {', '.join(f'count(*) FILTER (tag = {t}) AS n{t}' for t in range(SQ.TAGS))} FROM x),
  e AS (SELECT sym, [{', '.join(f"CAST(floor(-1000 * ln((count(*) FILTER (tag = {t}) + {SQ.SMOOTH}) / (any_value(n{t}) + {SQ.SMOOTH} * any_value(symbols))) + 0.5) AS BIGINT)" for t in range(SQ.TAGS))}] AS e
        FROM y, size GROUP BY sym),
  z AS (SELECT doc_id, sentence_no, list({{'e': e}} ORDER BY i) AS es FROM y JOIN e USING (sym) GROUP BY ALL),
  v AS (SELECT doc_id, sentence_no, st, list_reduce(es[2:], lambda acc, x: [{', '.join(_step_sql(t) for t in range(SQ.TAGS))}],
               [{', '.join(f"{{'c': st.s3{t} + es[1].e[{t + 1}], 'p': '{t}'}}" for t in range(SQ.TAGS))}]) AS best FROM z, st),
  f AS (SELECT doc_id, sentence_no, list_reduce(best, lambda a, b: CASE WHEN b.c < a.c THEN b ELSE a END).p AS path
        FROM (SELECT doc_id, sentence_no, [{', '.join(f"{{'c': best[{t + 1}].c + st.s{t}3, 'p': best[{t + 1}].p}}" for t in range(SQ.TAGS))}] AS best FROM v)),
  m AS (SELECT doc_id, sentence_no, i, substr(path, CAST(i + 1 AS BIGINT), 1) AS t, toks[i + 1] AS w
        FROM (SELECT *, unnest(range(0, len(toks))) AS i FROM f JOIN s USING (doc_id, sentence_no))),
  n AS (SELECT *, sum(CASE WHEN t = '1' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, sentence_no ORDER BY i) AS no FROM m)
  SELECT doc_id, sentence_no, string_agg(name, ',' ORDER BY no) AS persons, count(*) AS n_persons
  FROM (SELECT doc_id, sentence_no, no, string_agg(w, ' ' ORDER BY i) AS name FROM n WHERE t <> '0' GROUP BY ALL) GROUP BY ALL"""


@query("persons_sequence", _sequence_sql())
def q_persons_sequence(spark, sf_dir):
    """N2 by a hidden Markov model counted where the names of a table stand."""
    docs = _docs(spark, sf_dir, "doc_id", "text")
    model = SQ.SequenceModel.learn(SQ.tagged_sentences(AutomatonTagger(_name_table(docs)).spans(docs, "text")))
    hits = M.sentences_with_persons(SQ.SequenceTagger(model).tag(docs, "text"), ["doc_id"])
    return hits.select("doc_id", "sentence_no", M.persons_string(F.col("persons")).alias("persons"),
                       F.size("persons").cast("bigint").alias("n_persons"))


@query("mentions_store_once", ORACLE["mentions_store"])
def q_mentions_store_once(spark, sf_dir):
    """K3 exactly once: an attempt that dies before its commit, the run, and the
    run started again store the mentions once."""
    docs = _docs(spark, sf_dir, "doc_id", "text", "source")
    arts = B.articles_from_documents(docs).drop("source")
    path, scorer = scratch_path(spark, "mentions-once"), SE.LexiconScorer(FIXTURE_LEXICON)
    enc, _ = MJ.mentions_job(arts, FIXTURE_KEY, scorer)
    enc.write.partitionBy("art_source").parquet(f"{path}/{TB.DATA}/{TB.ATTEMPT}=run-1-dead")
    for _ in range(2):
        MJ.mentions_job(arts, FIXTURE_KEY, scorer, out_path=path, run_id="run-1")
    stored = TB.read_committed(spark, path, enc.schema)
    return stored.select(*[c for c in stored.columns if c not in MJ.MENTION_FIELDS],
                         *[CR.decrypt(F.col(c), FIXTURE_KEY).alias(c) for c in MJ.MENTION_FIELDS])


@query("counts_while_writing", f"""
  SELECT 'links' AS kind, site, n_links AS n FROM ({ORACLE["link_counts"]})
  UNION ALL SELECT 'articles', site, n_articles FROM ({ORACLE["article_counts"]})""")
def q_counts_while_writing(spark, sf_dir):
    """A1, A2: counted while the links and the articles are written."""
    links = X.links_until_error(_broken_links(spark, sf_dir))
    articles = B.articles_from_documents(_docs(spark, sf_dir, "doc_id", "text", "source"))
    n_links = C.write_with_counts(links, scratch_path(spark, "counted-links"))
    n_articles = C.write_with_counts(articles, scratch_path(spark, "counted-articles"))
    return n_links.select(F.lit("links").alias("kind"), "site", "n").union(n_articles.select(F.lit("articles"), "site", "n"))


LANDINGS = 2


def _landed(df, key, path):
    """Lands a table in ``LANDINGS`` parts, dealt by a hash, and yields after each."""
    for k in range(LANDINGS):
        df.where(F.pmod(F.xxhash64(key), F.lit(LANDINGS)) == k).write.mode("append").parquet(path)
        yield k


@query("links_until_error_stream", _UNTIL_SQL)
def q_links_until_error_stream(spark, sf_dir):
    """X3, W2 over a stream: list pages land out of order, the query stops and goes
    on between the landings, and the first failures are remembered."""
    pages = B.with_broken_pages(_crawl(spark, sf_dir)).select("site", F.col("page_id").cast("bigint").alias("page_no"), "html")
    landing, log, progress = (scratch_path(spark, f"listing-{x}") for x in ("pages", "log", "progress"))
    for _ in _landed(pages, "page_no", landing):
        _finish(ST.start_links_stream(spark, landing, log, progress, B.pages_profiles()))
    return ST.links_so_far(spark, log)


@query("crawl_pages_stream", ORACLE["crawl_pages"])
def q_crawl_pages_stream(spark, sf_dir):
    """S2 as a stream-stream join: requests wait for their pages; a last row much
    later on both sides lets those go that still wait."""
    crawl = _crawl(spark, sf_dir)
    base, hour = F.lit("2024-01-01 00:00:00").cast("timestamp"), 3600

    def at(key, hours):
        return base + F.make_dt_interval(secs=(F.pmod(F.xxhash64(key), F.lit(hour)) + hours * hour).cast("decimal(18,6)"))
    requests = (_frontier(spark, sf_dir).select("site", "url", at("page_no", 0).alias("requested_at"))
                .unionByName(crawl.select("site", "url", at("page_id", 0).alias("requested_at"))))
    pages = crawl.select("url", "status_code", F.length("html").cast("bigint").alias("html_chars"), at("page_id", 1).alias("fetched_at"))
    asked, landed, out, progress = (scratch_path(spark, f"fetch-{x}") for x in ("requests", "pages", "out", "progress"))
    end = spark.range(1).select((base + F.expr("INTERVAL 3 DAYS")).alias("at"))
    requests_end = end.select(F.lit(None).cast("string").alias("site"), F.lit("last request").alias("url"), F.col("at").alias("requested_at"))
    pages_end = end.select(F.lit("last page").alias("url"), *(F.lit(None).cast(pages.schema[c].dataType).alias(c) for c in ("status_code", "html_chars")), F.col("at").alias("fetched_at"))

    def run():
        _finish(ST.start_fetch_stream(spark.readStream.schema(requests.schema).parquet(asked), spark.readStream.schema(pages.schema).parquet(landed),
                                      out, progress, "status_code", "html_chars", salts=8))
    for _ in zip(_landed(requests, "url", asked), _landed(pages, "fetched_at", landed), strict=True):
        run()
    requests_end.write.mode("append").parquet(asked)
    pages_end.write.mode("append").parquet(landed)
    run()
    return spark.read.parquet(out).select("site", "url", "status_code", "html_chars")


def _finish(query):
    query.awaitTermination()


@query("chunk_stars_learned")
def q_chunk_stars_learned(spark, sf_dir):
    """N4 by an ordinal model fitted on all labelled documents: toxic ones have one
    or two stars, others three or four, the higher of the two if of good quality."""
    docs, labels = _docs(spark, sf_dir, "doc_id", "text"), B.table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    stars = labels.select("doc_id", (3 - 2 * F.col("toxic") + F.col("quality")).alias("stars"))
    model = OR.OrdinalModel.fit(docs.join(stars, "doc_id"), levels=4)
    chunks = M.person_context(docs, text_col="text", keep=["doc_id"])
    return OR.OrdinalScorer(model).score(chunks).select("doc_id", "sentence_no", "chunk_no", "hits", "stars")


# U1 with sites that write the same fields in other types, more fields, or no JSON.
_SHAPE = "CASE WHEN doc_id % 10 = 9 THEN 'd' WHEN doc_id % 3 = 0 THEN 'a' WHEN doc_id % 3 = 1 THEN 'b' ELSE 'c' END"
_SHAPED_SQL = f"""
  SELECT doc_id, {_SHAPE} AS site, doc_id AS id, CASE WHEN {_SHAPE} = 'b' THEN n_chars || ' signs' ELSE CAST(n_chars AS VARCHAR) END AS chars,
         CASE WHEN {_SHAPE} = 'c' THEN '["' || lang || '"]' ELSE lang END AS lang,
         CASE WHEN {_SHAPE} = 'b' THEN doc_id + 0.5 WHEN {_SHAPE} = 'c' THEN doc_id END AS part, CASE WHEN {_SHAPE} = 'c' THEN source END AS extra
  FROM documents"""


def _shaped(spark, sf_dir):
    docs = _docs(spark, sf_dir, "doc_id", "n_chars", "lang", "source").withColumn("site", F.expr(_SHAPE))
    chars, text = F.col("n_chars"), F.concat(F.col("n_chars").cast("string"), F.lit(" signs"))
    wrote = {"a": (chars.alias("chars"), "lang"),
             "b": (text.alias("chars"), "lang", (F.col("doc_id") + F.lit(0.5).cast("decimal(2,1)")).alias("part")),
             "c": (chars.alias("chars"), F.array("lang").alias("lang"), F.col("doc_id").alias("part"), F.col("source").alias("extra"))}
    json = F.lit("{cut off")
    for site, fields in wrote.items():
        json = F.when(F.col("site") == site, F.to_json(F.struct(F.col("doc_id").alias("id"), *fields))).otherwise(json)
    return docs.select("doc_id", "site", json.alias("json"))


@query("union_shapes", f"""
  SELECT doc_id, site, id, chars, lang, CAST(part AS DOUBLE) AS part, extra, NULL AS unread FROM ({_SHAPED_SQL}) WHERE site <> 'd'
  UNION ALL SELECT doc_id, site, NULL, NULL, NULL, NULL, NULL, '{{cut off' FROM ({_SHAPED_SQL}) WHERE site = 'd'""")
def q_union_shapes(spark, sf_dir):
    """U1 over unlike records: the schema is gathered from them, and widened."""
    rows = _shaped(spark, sf_dir)
    union = SH.union_shapes(rows, SH.shape_report(rows))
    return union.select("doc_id", "site", "fields.id", "fields.chars", "fields.lang", F.col("fields.part").cast("double").alias("part"), "fields.extra", "unread")


@query("shape_report", f"""
  WITH s AS (SELECT * FROM ({_SHAPED_SQL}) WHERE site <> 'd')
  SELECT site, field, kinds, n, type FROM (
    SELECT site, 'id' AS field, 'bigint' AS kinds, count(id) AS n, 'bigint' AS type FROM s GROUP BY site
    UNION ALL SELECT site, 'chars', CASE WHEN site = 'b' THEN 'string' ELSE 'bigint' END, count(chars), 'string' FROM s GROUP BY site
    UNION ALL SELECT site, 'lang', CASE WHEN site = 'c' THEN 'json' ELSE 'string' END, count(lang), 'string' FROM s GROUP BY site
    UNION ALL SELECT site, 'part', CASE WHEN site = 'b' THEN 'decimal' ELSE 'bigint' END, count(part), 'decimal(20,1)' FROM s GROUP BY site
    UNION ALL SELECT site, 'extra', 'string', count(extra), 'string' FROM s GROUP BY site) WHERE n > 0""")
def q_shape_report(spark, sf_dir):
    """What each site wrote for each field, and what the union reads it as."""
    return SH.shape_report(_shaped(spark, sf_dir))


def _retyped(text):
    """Texts as somebody else typed them, one edit to three away by their number."""
    one = F.concat(F.substring(text, 1, 4), F.expr("substring(text, 6)"))
    two = F.concat(F.lit("x"), F.regexp_replace(text, r"\.$", "?"))
    return F.when(F.col("doc_id") % 4 == 1, one).when(F.col("doc_id") % 4 == 2, two).when(F.col("doc_id") % 4 == 3, F.concat(F.lit("abc"), text)).otherwise(text)


@query("translate_near")
def q_translate_near(spark, sf_dir):
    """N7 with near matches: texts up to two edits from a remembered one."""
    docs = _docs(spark, sf_dir, "doc_id", "text", "lang")
    seen = B.table(spark, sf_dir, "labels", "doc_id").distinct()
    memory = (docs.where("lang <> 'en'").join(seen, "doc_id", "left_semi")
              .select("lang", "text", F.concat(F.lit("["), "lang", F.lit("->en] "), "text").alias("text_en")))
    asked = docs.withColumn("text", _retyped(F.col("text")))
    return NM.apply_near_memory(asked, memory, "text", "lang").select("doc_id", "lang", "text_en", F.col("distance").cast("bigint").alias("distance"))
