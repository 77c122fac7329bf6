"""newsflow: news-article pipeline as Spark jobs.

Main entry points (DataFrame in, DataFrame out):

* ``articles_job(crawl, ...)`` / ``listing_job(depth, crawl, ...)`` - extraction
* ``mentions_job(articles, key, scorer, ...)`` / ``mention_rows(...)`` - persons,
  context, sentiment, encryption
* ``person_context(articles, ...)`` - the shuffle-free context/chunk operator
* ``encrypt_columns`` / ``decrypt`` - Fernet-compatible columns
* taggers, scorers and the translation memory in ``newsflow.operators``
"""

from newsflow.functions.crypto import decrypt, encrypt_columns
from newsflow.operators.mentions import person_context
from newsflow.operators.sentiment import LexiconScorer, LexiconTableScorer, ModelScorer
from newsflow.operators.tagging import GazetteerTableTagger, GazetteerTagger, ModelTagger, RuleTagger
from newsflow.operators.translate import apply_memory, memory_misses, translate_with_memory
from newsflow.plans.articles_job import articles_job, listing_job
from newsflow.plans.mentions_job import mention_rows, mentions_job

__all__ = [
    "articles_job", "listing_job", "mentions_job", "mention_rows", "person_context",
    "encrypt_columns", "decrypt", "RuleTagger", "GazetteerTagger", "GazetteerTableTagger", "ModelTagger",
    "LexiconScorer", "LexiconTableScorer", "ModelScorer", "apply_memory", "memory_misses",
    "translate_with_memory",
]
