"""Issue-shaped view over a table of documents: the input of the registered queries.

Each document becomes one raw record. Its number decides which special case of the
cleaning rules it carries: form titles, excluded pages, boilerplate descriptions,
timestamps of every precision, unreadable closing times, missing authors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echolot.config import IngestConfig
from echolot.schemas import RAW_SCHEMA

# Word weights and label rules made of words that occur in the documents.
DOCUMENT_LEXICON = {"the": 1, "of": -1, "la": 2, "de": -2, "thor": 3, "erin": -3}
DOCUMENT_RULES = (
    ("Architektur", "ther"),
    ("Betrieb", "thon"),
    ("Daten", "thre"),
    ("EU", "des"),
    ("Standards", "thor"),
    ("Strategie", "thor"),
)
DOCUMENT_CONFIG = IngestConfig(lexicon=DOCUMENT_LEXICON, label_rules=DOCUMENT_RULES)

# The same text serves both engines.
TITLE = """CASE
  WHEN doc_id % 4 = 0 THEN concat('Feedback für die Seite /', source, '/')
  WHEN doc_id % 20 = 1 THEN 'Feedback für die Seite /'
  WHEN doc_id % 20 = 2 THEN 'Feedback für die Seite /wtf'
  WHEN doc_id % 20 = 6 THEN concat('Feedback für die Seite\t\xa0/', lang, '//\t')
  WHEN doc_id % 20 = 10 THEN 'feedback für die Seite /klein'
  WHEN doc_id % 20 = 14 THEN 'Feedback für die Seite /wtf/'
  ELSE split_part(text, chr(10), 1) END"""
DESCRIPTION = """CASE
  WHEN doc_id % 25 = 3 THEN 'Test'
  WHEN doc_id % 25 = 4 THEN ''
  WHEN doc_id % 50 = 5 THEN NULL
  WHEN doc_id % 50 = 30 THEN 'test'
  WHEN doc_id % 50 = 31 THEN 'TEST'
  WHEN doc_id % 50 = 32 THEN '**Feedback:** <br>'
  WHEN doc_id % 7 = 0 THEN concat('**Feedback:** <br>', text, ' Beitrag der Musterwerk GmbH')
  WHEN doc_id % 7 = 1 THEN concat('**Feedback:** <br>', text, ' Beitrag der nordlicht GmbH')
  WHEN doc_id % 7 = 2 THEN concat('**Feedback:** <br>', text, ' Unsere AGB und Diese SERVICES gelten.')
  WHEN doc_id % 7 = 3 THEN concat('**Feedback:** <br>', text, ' für die Muster Digital Services GmbH.')
  WHEN doc_id % 7 = 4 THEN concat('**Feedback:** <br>', text, ' von Müller & Söhne AG, Ulm')
  ELSE concat('**Feedback:** <br>', text) END"""
STATE = "CASE WHEN doc_id % 3 = 0 THEN 'closed' ELSE 'opened' END"
FRACTION = """CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN '.1' WHEN 2 THEN '.080'
  ELSE '.080123' END"""
AUTHOR_STATE = "CASE WHEN doc_id % 40 = 7 THEN 'blocked' ELSE 'active' END"


def _iso(hours: str) -> str:
    moment = f"timestampadd(HOUR, CAST({hours} AS INT), timestamp_ntz'2025-11-01 00:00:00')"
    return f"date_format({moment}, \"yyyy-MM-dd'T'HH:mm:ss\")"


CREATED_HOURS = "(doc_id * 37) % 2160"
UPDATED_HOURS = f"{CREATED_HOURS} + n_chars % 72"
CLOSED_HOURS = f"{CREATED_HOURS} + 100"


def raw_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records, in the schema of a landed page."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    raw = documents.select(
        (F.col("doc_id") + 1).alias("iid"),
        F.expr(TITLE).alias("title"),
        F.expr(DESCRIPTION).alias("description"),
        F.expr(STATE).alias("state"),
        F.expr(f"concat({_iso(CREATED_HOURS)}, {FRACTION}, 'Z')").alias("created_at"),
        F.expr(f"concat({_iso(UPDATED_HOURS)}, 'Z')").alias("updated_at"),
        F.expr(
            f"""CASE WHEN doc_id % 30 = 0 THEN 'bad'
            WHEN doc_id % 3 = 0 THEN concat({_iso(CLOSED_HOURS)}, 'Z') END"""
        ).alias("closed_at"),
        F.expr(
            f"""named_struct('id', nullif(doc_id % 40, 39),
            'name', concat('author', doc_id % 40), 'state', {AUTHOR_STATE})"""
        ).alias("author"),
        F.expr("n_chars % 7").alias("user_notes_count"),
        F.expr("n_chars % 11").alias("upvotes"),
        F.expr("n_chars % 3").alias("downvotes"),
        F.expr(
            """named_struct('short', concat('#', doc_id + 1), 'relative',
            concat('#', doc_id + 1), 'full', concat('group/project#', doc_id + 1))"""
        ).alias("references"),
    )
    return raw.select(*RAW_SCHEMA.fieldNames())
