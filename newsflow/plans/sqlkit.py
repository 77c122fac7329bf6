"""SQL fragments (DuckDB dialect) that mirror the column functions, used to
write the independent oracle queries. They share only the constants
(character classes, patterns) with the Spark side, never the code path.
"""

from __future__ import annotations

from newsflow.functions.text import CHUNK_LEN, WS_CHARS, WS_CLASS
from newsflow.operators.tagging import PERSON_RULE
from newsflow.operators.tagging import SENT_BREAK_PORTABLE as SENT_BREAK

WS_SET = "(" + "||".join(f"chr({ord(c)})" for c in WS_CHARS) + ")"


def strip(x: str) -> str:
    return f"trim({x}, {WS_SET})"


def collapse(x: str) -> str:
    return strip(f"regexp_replace({x}, '{WS_CLASS}+', ' ', 'g')")


def sentences(x: str) -> str:
    return f"string_split(regexp_replace({x}, '{SENT_BREAK}', '\\1' || chr(1), 'g'), chr(1))"


def persons(x: str) -> str:
    return f"regexp_extract_all({x}, '{PERSON_RULE}')"


def context(sents: str, i: str) -> str:
    members = f"{sents}[greatest({i} - 1, 0) + 1 : least({i} + 2, len({sents}))]"
    return f"replace(array_to_string(list_transform({members}, lambda x: {strip('x')}), ' '), chr(10), '')"


# Sentences of every document, 0-based sentence_no (CTE body).
DOC_SENTENCES = f"""
  SELECT doc_id, sents, unnest(range(0, len(sents))) AS sentence_no
  FROM (SELECT doc_id, {sentences('text')} AS sents FROM documents)
"""

# Sentences with at least one person, with context (CTE body).
DOC_HITS = f"""
  SELECT doc_id, sentence_no, persons, {context('sents', 'sentence_no')} AS context
  FROM (SELECT doc_id, sents, sentence_no, {persons('sents[sentence_no + 1]')} AS persons
        FROM ({DOC_SENTENCES}))
  WHERE len(persons) > 0
"""

# One row per chunk of each context (CTE body over DOC_HITS).
DOC_CHUNKS = f"""
  SELECT doc_id, sentence_no, persons, o // {CHUNK_LEN} AS chunk_no,
         substring(context, o + 1, {CHUNK_LEN}) AS chunk
  FROM (SELECT *, unnest(range(0, length(context), {CHUNK_LEN})) AS o FROM ({DOC_HITS}))
"""
