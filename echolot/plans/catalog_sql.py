"""The registered queries again as SQL for a second engine (DuckDB)."""

from __future__ import annotations

from echolot.config import (
    BOILERPLATE,
    CLEAN_COLUMNS,
    EXCLUDED_DESCRIPTIONS,
    EXCLUDED_IIDS,
    EXCLUDED_PAGES,
    FORM_PREFIX,
    HOME_PAGE,
    LABEL_VOCABULARY,
    NON_FORM_PAGE,
    UNCLEAR,
)
from echolot.functions.text import PYTHON_WHITE_SPACE, WHITE_SPACE
from echolot.plans import catalog as q
from echolot.plans.document_issues import (
    AUTHOR_STATE,
    CLOSED_HOURS,
    CREATED_HOURS,
    DESCRIPTION,
    DOCUMENT_LEXICON,
    DOCUMENT_RULES,
    FRACTION,
    STATE,
    TITLE,
    UPDATED_HOURS,
)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_text(v) if isinstance(v, str) else str(v) for v in values) + ")"


def _moment(hours: str) -> str:
    return f"(TIMESTAMP '2025-11-01 00:00:00' + to_hours(CAST({hours} AS INTEGER)))"


def _iso(hours: str, fraction: str = "''") -> str:
    return f"concat(strftime({_moment(hours)}, '%Y-%m-%dT%H:%M:%S'), {fraction}, 'Z')"


def _values(rows) -> str:
    return ", ".join(_in(row) for row in rows)


# The organisation rule again, as this engine writes it: capitalised names, else lower-case ones.
NAMED = (
    r"(?:^|[^\pL\pN])(?:(?:[Dd]e[rmns]|[Dd]ie|[Dd]as|[Vv]on|[Ff]ür|[Bb]ei) )?"
    r"((?:[\p{Lu}\pN][\pL\pN&-]* (?:& )?){1,6}?(?:GmbH|AG|SE|e\.V\.))(?:[^\pL\pN]|$)"
)
LOWER_NAMED = (
    r"(?:^|[^\pL\pN])(?:[Dd]e[rmns]|[Dd]ie|[Dd]as|[Vv]on|[Ff]ür|[Bb]ei) "
    r"(\p{Ll}[\pL\pN&-]* (?:GmbH|AG|SE|e\.V\.))(?:[^\pL\pN]|$)"
)
FRACTION_MICROS = "CASE doc_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 100000 WHEN 2 THEN 80000 ELSE 80123 END"

RAW = f"""
raw AS (
  SELECT doc_id + 1 AS iid, {TITLE} AS title, {DESCRIPTION} AS description, {STATE} AS state,
    {_iso(CREATED_HOURS, FRACTION)} AS created_text,
    {_iso(UPDATED_HOURS)} AS updated_text,
    CASE WHEN doc_id % 30 = 0 THEN 'bad'
      WHEN doc_id % 3 = 0 THEN {_iso(CLOSED_HOURS)} END AS closed_text,
    {_moment(CREATED_HOURS)} + to_microseconds({FRACTION_MICROS}) AS created_at,
    {_moment(UPDATED_HOURS)} AS updated_at,
    CASE WHEN doc_id % 3 = 0 AND doc_id % 30 <> 0 THEN {_moment(CLOSED_HOURS)} END AS closed_at,
    nullif(doc_id % 40, 39) AS author_id, concat('author', doc_id % 40) AS author_name,
    {AUTHOR_STATE} AS author_state,
    n_chars % 7 AS user_notes_count, n_chars % 11 AS upvotes, n_chars % 3 AS downvotes,
    concat('group/project#', doc_id + 1) AS "references"
  FROM documents),
clean AS (
  SELECT * FROM raw WHERE iid NOT IN {_in(EXCLUDED_IIDS)}
  QUALIFY row_number() OVER (PARTITION BY title, description ORDER BY created_at, iid) = 1),
described AS (
  SELECT *, replace(description, {_text(BOILERPLATE)}, '') AS desc_clean,
    starts_with(title, {_text(FORM_PREFIX)}) AS is_from_form,
    CASE WHEN starts_with(title, {_text(FORM_PREFIX)})
      THEN trim(substr(title, {len(FORM_PREFIX) + 1}), {_text(WHITE_SPACE)})
      ELSE {_text(NON_FORM_PAGE)} END AS form_page
  FROM clean),
prepared AS (
  SELECT *, CAST(CASE WHEN year(created_at) = 2026 THEN 2 ELSE 1 END AS TINYINT)
    AS feedback_round
  FROM described WHERE desc_clean NOT IN {_in(EXCLUDED_DESCRIPTIONS)}),
toks AS (
  SELECT iid, unnest(regexp_split_to_array(lower(desc_clean), '[^\\p{{L}}]+')) AS tok
  FROM prepared),
lines AS (
  SELECT iid, concat(' ', array_to_string(regexp_split_to_array(lower(desc_clean), '[^\\p{{L}}]+'), ' '), ' ') AS line
  FROM prepared),
lexicon(tok, w) AS (VALUES {_values(DOCUMENT_LEXICON.items())}),
rules(label, tok) AS (VALUES {_values(DOCUMENT_RULES)}),
vocabulary(label) AS (VALUES {_values((label,) for label in LABEL_VOCABULARY)}),
scores AS (
  SELECT iid, greatest(-1.0, least(1.0, CAST(sum(w) AS DOUBLE) / count(*))) AS s
  FROM toks JOIN lexicon USING (tok) GROUP BY iid),
found AS (
  SELECT iid, list_sort(list(DISTINCT label)) AS ls
  FROM toks JOIN rules USING (tok) GROUP BY iid),
enriched AS (
  SELECT p.*, coalesce(s, 0.0) AS sentiment, ls,
    coalesce(
      nullif(regexp_extract(concat_ws(chr(10), title, desc_clean), {_text(NAMED)}, 1), ''),
      nullif(regexp_extract(concat_ws(chr(10), title, desc_clean), {_text(LOWER_NAMED)}, 1), ''),
      {_text(UNCLEAR)}) AS org
  FROM prepared p LEFT JOIN scores USING (iid) LEFT JOIN found USING (iid)),
post AS (
  SELECT * REPLACE (
    CASE WHEN form_page = '/' THEN {_text(HOME_PAGE)}
      WHEN form_page LIKE '%/' THEN substr(form_page, 1, length(form_page) - 1)
      ELSE form_page END AS form_page),
    coalesce(ls, [{_text(UNCLEAR)}]) AS labels
  FROM enriched WHERE form_page NOT IN {_in(EXCLUDED_PAGES)}),
exploded AS (SELECT iid, sentiment, unnest(labels) AS label FROM post),
fresh AS (SELECT * FROM raw WHERE created_at > TIMESTAMP '2025-12-31 23:59:59'),
fresh_clean AS (
  SELECT * FROM fresh WHERE iid NOT IN {_in(EXCLUDED_IIDS)}
  QUALIFY row_number() OVER (PARTITION BY title, description ORDER BY created_at, iid) = 1),
fresh_prepared AS (
  SELECT *, coalesce(starts_with(title, {_text(FORM_PREFIX)})
    AND trim(substr(title, {len(FORM_PREFIX) + 1}), {_text(WHITE_SPACE)})
      IN {_in(EXCLUDED_PAGES)}, false) AS excluded_page
  FROM fresh_clean
  WHERE replace(description, {_text(BOILERPLATE)}, '') NOT IN {_in(EXCLUDED_DESCRIPTIONS)}),
passages AS (
  SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}]+')) AS tok
  FROM benchmark)
"""

JOINED_LABELS = "array_to_string(labels, '|') AS labels"
FOUND_LABELS = "coalesce(array_to_string(ls, '|'), '') AS labels"
PAIRED = "unnest(list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1])))"
SENTIMENT = "round(sentiment, 6) AS sentiment"


def _filtered(condition: str) -> str:
    return f"SELECT iid, form_page FROM post WHERE {condition}"


def _counts(column: str) -> str:
    return f"SELECT {column}, count(*) AS n_issues FROM post GROUP BY {column}"


def _facet(column: str) -> str:
    return f"SELECT DISTINCT {column} FROM post WHERE {column} IS NOT NULL ORDER BY 1"


FILTERED = f"""list_contains(labels, {_text(q.FILTER.labels[0])})
  AND form_page IN {_in(q.FILTER.pages)}
  AND sentiment BETWEEN {q.FILTER.sentiment[0]} AND {q.FILTER.sentiment[1]}
  AND feedback_round IN {_in(q.FILTER.rounds)}
  AND regexp_matches(lower(desc_clean), {_text(q.FILTER.search.lower())})"""

PAIRS = """SELECT a.label AS label_a, b.label AS label_b, count(*) AS n_issues
  FROM exploded a JOIN exploded b USING (iid) WHERE a.label < b.label GROUP BY ALL"""

# The processed table after the closed issues came again with other values.
EDITED = """edited AS (
  SELECT iid, created_at, is_from_form, form_page, author_id, author_name,
    CASE WHEN state = 'closed' THEN -sentiment ELSE sentiment END AS sentiment,
    CASE WHEN state = 'closed' THEN concat('neu ', org) ELSE org END AS org,
    CASE WHEN state = 'closed' THEN list_append(labels, 'EU') ELSE labels END AS labels FROM post)"""
FIGURES = " UNION ALL ".join(
    f"""SELECT '{dimension}' AS dimension, CAST({value} AS VARCHAR) AS value, count(*) AS n_issues,
      round(avg(sentiment), 6) AS mean_sentiment FROM {rows} GROUP BY ALL"""
    for dimension, value, rows in (
        ("day", "CAST(created_at AS DATE)", "edited"),
        ("form", "is_from_form", "edited"),
        ("page", "form_page", "edited"),
        ("author", "author_name", "edited"),
        ("author_id", "author_id", "edited"),
        ("org", "org", "edited"),
        ("label", "label", "(SELECT sentiment, unnest(labels) AS label FROM edited)"),
    )
)

# Fields of a landed record with the kinds of their values, and when a record has them.
KINDS = " UNION ALL ".join(
    f"""SELECT '{field}' AS field, {f"'{expected}'" if expected else "CAST(NULL AS VARCHAR)"} AS expected,
      '{found}' AS found, count(*) AS n FROM raw WHERE iid % 50 <> 9 AND {condition} HAVING count(*) > 0"""
    for field, expected, found, condition in (
        ("iid", "long", "BIGINT", "iid % 10 <> 3"),
        ("iid", "long", "STRING", "iid % 10 = 3"),
        ("title", "string", "STRING", "title IS NOT NULL"),
        ("description", "string", "STRING", "description IS NOT NULL"),
        ("state", "string", "STRING", "true"),
        ("created_at", "string", "STRING", "true"),
        ("updated_at", "string", "STRING", "updated_text IS NOT NULL"),
        ("closed_at", "string", "STRING", "closed_text IS NOT NULL"),
        ("author", "struct", "OBJECT", "true"),
        ("author.id", "long", "BIGINT", "author_id IS NOT NULL"),
        ("author.name", "string", "STRING", "true"),
        ("author.state", "string", "STRING", "true"),
        ("author.pic", None, "STRING", "iid % 10 = 4"),
        ("user_notes_count", "long", "BIGINT", "user_notes_count IS NOT NULL"),
        ("upvotes", "long", "BIGINT", "iid % 10 <> 2 AND upvotes IS NOT NULL"),
        ("upvotes", "long", "STRING", "iid % 10 = 2 AND upvotes IS NOT NULL"),
        ("downvotes", "long", "BIGINT", "downvotes IS NOT NULL"),
        ("references", "struct", "OBJECT", "true"),
        ("references.short", "string", "STRING", "true"),
        ("references.relative", "string", "STRING", "true"),
        ("references.full", "string", "STRING", "true"),
        ("weight", None, "BIGINT", "iid % 10 = 1"),
    )
)
RESCUED_FIELD = "CASE iid % 10 WHEN 1 THEN 'weight' WHEN 2 THEN 'upvotes' WHEN 4 THEN 'author.pic' END"

SELECTS = {
    "read_issue_pages": """SELECT iid, title, description, state, created_text AS created_at,
      updated_text AS updated_at, closed_text AS closed_at, author_id, author_name,
      user_notes_count, upvotes, downvotes, "references" AS reference FROM raw""",
    "stage_roundtrip": """SELECT iid, created_at, closed_at, author_name, desc_clean, form_page
      FROM prepared""",
    "write_partition_roundtrip": f"""SELECT iid, form_page, feedback_round,
      CASE feedback_round WHEN 1 THEN DATE '{q.OLD_DATE}' ELSE DATE '{q.NEW_DATE}' END
      AS processing_date FROM prepared""",
    "load_issues": f"""SELECT iid, state, updated_at, form_page, CAST(NULL AS TINYINT)
      AS feedback_round, DATE '{q.OLD_DATE}' AS processing_date FROM prepared UNION ALL
      SELECT iid, state, updated_at, form_page, feedback_round, DATE '{q.NEW_DATE}'
      FROM prepared WHERE state = 'closed'""",
    "union_align_schemas": """SELECT NULL AS feedback_round, form_page, iid, org,
      NULL AS sentiment FROM post UNION ALL
      SELECT feedback_round, NULL, iid, org, sentiment FROM post""",
    "latest_per_issue": f"""SELECT iid, state,
      CASE WHEN state = 'closed' THEN updated_at + INTERVAL 1 DAY ELSE updated_at END
      AS updated_at,
      CASE WHEN state = 'closed' THEN DATE '{q.NEW_DATE}' ELSE DATE '{q.OLD_DATE}' END
      AS processing_date FROM clean""",
    "load_label_vocab": "SELECT DISTINCT concat(source, ' ', lang) AS label FROM documents",
    "run_state": """SELECT strftime(max(created_at), '%Y-%m-%dT%H:%M:%S.%fZ')
      AS last_successful_run, count(*) AS last_fetched_issues,
      (SELECT count(*) FROM fresh_prepared WHERE NOT excluded_page) AS total_issues_processed
      FROM fresh""",
    "run_state_saved": """SELECT max(created_at) AS last_successful_run, count(*) AS fetched,
      (SELECT count(*) FROM fresh_prepared WHERE NOT excluded_page) AS processed FROM fresh""",
    "run_without_new_issues": """SELECT count(*) AS fetched, CAST(0 AS BIGINT) AS new,
      CAST(0 AS BIGINT) AS saved, CAST(1 AS BIGINT) AS dates FROM raw""",
    "read_new_landings": """SELECT iid, title, description, created_text AS created_at FROM raw
      WHERE iid % 10 = 0""",
    "infer_issue_pages": """SELECT iid, title, closed_text AS closed_at, upvotes, author_id FROM raw""",
    "drifting_pages": """SELECT iid, title, description,
      CASE WHEN iid % 10 <> 2 THEN upvotes END AS upvotes, author_id, CAST(NULL AS VARCHAR) AS reason,
      CASE iid % 10 WHEN 1 THEN concat('weight=', iid) WHEN 2 THEN concat('upvotes="', upvotes, ' up"')
        WHEN 4 THEN 'author.pic="p"' ELSE '' END AS drift
      FROM raw WHERE iid % 50 <> 9 UNION ALL
      SELECT NULL, NULL, NULL, NULL, NULL, CASE iid % 50 WHEN 9 THEN 'page' ELSE 'record' END, ''
      FROM raw WHERE iid % 50 IN (9, 19)""",
    "page_field_kinds": KINDS,
    "quarantined_run": f"""WITH fit AS (SELECT * FROM fresh WHERE iid % 50 <> 9),
      fit_clean AS (SELECT * FROM fit WHERE iid NOT IN {_in(EXCLUDED_IIDS)}
        QUALIFY row_number() OVER (PARTITION BY title, description ORDER BY created_at, iid) = 1)
      SELECT 'fetched' AS reason, CAST(NULL AS VARCHAR) AS field, count(*) AS n FROM raw WHERE iid % 50 <> 9
      UNION ALL SELECT 'new', NULL, count(*) FROM fit
      UNION ALL SELECT 'saved', NULL, count(*) FROM fit_clean
        WHERE replace(description, {_text(BOILERPLATE)}, '') NOT IN {_in(EXCLUDED_DESCRIPTIONS)}
        AND NOT coalesce(starts_with(title, {_text(FORM_PREFIX)})
          AND trim(substr(title, {len(FORM_PREFIX) + 1}), {_text(WHITE_SPACE)}) IN {_in(EXCLUDED_PAGES)}, false)
      UNION ALL SELECT 'bad', NULL, count(*) FROM raw WHERE iid % 50 IN (9, 19)
      UNION ALL SELECT 'rescued', NULL, count(*) FROM fit WHERE iid % 10 IN (1, 2, 4)
      UNION ALL SELECT 'page', NULL, count(*) FROM raw WHERE iid % 50 = 9 HAVING count(*) > 0
      UNION ALL SELECT 'record', NULL, count(*) FROM raw WHERE iid % 50 = 19 HAVING count(*) > 0
      UNION ALL SELECT 'field', {RESCUED_FIELD}, count(*) FROM fit WHERE iid % 10 IN (1, 2, 4) GROUP BY 2""",
    "two_step_runs": f"""SELECT iid, created_at, author_name, CAST(2 AS TINYINT) AS feedback_round,
      CASE WHEN created_text <= '{q.SECOND_NIGHT}' THEN DATE '{q.OLD_DATE}' ELSE DATE '{q.NEW_DATE}' END
      AS processing_date FROM fresh_prepared WHERE NOT excluded_page""",
    "snapshot_merge": f"""SELECT iid, state,
      CASE WHEN state = 'closed' THEN updated_at + INTERVAL 1 DAY ELSE updated_at END
      AS updated_at,
      CASE WHEN state = 'closed' THEN DATE '{q.NEW_DATE}' ELSE DATE '{q.OLD_DATE}' END
      AS processing_date FROM clean""",
    "backfill_round": f"""SELECT iid, created_at, form_page, feedback_round,
      DATE '{q.OLD_DATE}' AS processing_date FROM prepared UNION ALL
      SELECT iid, created_at, form_page, CAST(9 AS TINYINT), DATE '{q.NEW_DATE}'
      FROM prepared WHERE iid % 3 = 0""",
    "stage_counts": """SELECT 'fetched' AS stage, (SELECT count(*) FROM raw) AS n
      UNION ALL SELECT 'new', (SELECT count(*) FROM fresh)
      UNION ALL SELECT 'prepared', (SELECT count(*) FROM fresh_prepared)
      UNION ALL SELECT 'saved', (SELECT count(*) FROM fresh_prepared WHERE NOT excluded_page)""",
    "incremental_new_issues": """SELECT iid, created_at FROM raw
      WHERE created_at > TIMESTAMP '2026-01-01 12:00:00'""",
    "flatten_author": "SELECT iid, author_id, author_name, author_state FROM raw",
    "parse_timestamps": "SELECT iid, created_at, updated_at, closed_at FROM raw",
    "exclude_ids": f"SELECT iid, title FROM raw WHERE iid NOT IN {_in(EXCLUDED_IIDS)}",
    "dedupe_issues": """SELECT iid, title, description, created_at FROM raw QUALIFY row_number()
      OVER (PARTITION BY title, description ORDER BY created_at, iid) = 1""",
    "clean_issues": "SELECT "
    + ", ".join(f'"{column}"' for column in CLEAN_COLUMNS)
    + " FROM clean",
    "clean_description": f"""SELECT iid, replace(description, {_text(BOILERPLATE)}, '')
      AS desc_clean FROM raw""",
    "form_source": f"""SELECT iid, title, starts_with(title, {_text(FORM_PREFIX)})
      AS is_from_form, CASE WHEN starts_with(title, {_text(FORM_PREFIX)})
      THEN trim(substr(title, {len(FORM_PREFIX) + 1}), {_text(WHITE_SPACE)})
      ELSE {_text(NON_FORM_PAGE)} END AS form_page FROM raw""",
    "prepare_issues": """SELECT iid, desc_clean, is_from_form, form_page, created_at
      FROM prepared""",
    "default_labels": f"""SELECT iid, CASE WHEN author_id IS NOT NULL
      THEN coalesce(array_to_string(ls, '|'), {_text(UNCLEAR)}) END AS labels FROM enriched""",
    "exclude_pages": f"""SELECT iid, form_page FROM prepared
      WHERE form_page NOT IN {_in(EXCLUDED_PAGES)}""",
    "normalize_pages": f"""SELECT iid, CASE WHEN form_page = '/' THEN {_text(HOME_PAGE)}
      WHEN form_page LIKE '%/' THEN substr(form_page, 1, length(form_page) - 1)
      ELSE form_page END AS form_page FROM prepared""",
    "feedback_round": """SELECT iid, created_at,
      CAST(CASE WHEN year(created_at) = 2026 THEN 2 ELSE 1 END AS TINYINT) AS feedback_round
      FROM raw""",
    "postprocess_issues": f"""SELECT iid, title, state, created_at, author_name, desc_clean,
      is_from_form, form_page, {SENTIMENT}, {JOINED_LABELS}, org, feedback_round FROM post""",
    "sentiment_scores": f"SELECT iid, {SENTIMENT} FROM enriched",
    "sentiment_scores_by_join": """SELECT p.iid, round(coalesce(s.s, 0.0), 6) AS sentiment
      FROM prepared p LEFT JOIN (
        SELECT iid, greatest(-1.0, least(1.0,
          CAST(sum(length(tok) % 5 - 2) AS DOUBLE) / count(*))) AS s
        FROM toks JOIN passages USING (tok) GROUP BY iid) s USING (iid)""",
    "keyword_labels": f"SELECT iid, {FOUND_LABELS} FROM enriched",
    "keyword_labels_by_join": """SELECT p.iid, coalesce(array_to_string(f.ls, '|'), '') AS labels
      FROM prepared p LEFT JOIN (
        SELECT iid, list_sort(list(DISTINCT concat('length ', length(tok)))) AS ls
        FROM toks JOIN passages USING (tok) GROUP BY iid) f USING (iid)""",
    "keyword_phrases": f"""SELECT p.iid, {FOUND_LABELS} FROM prepared p LEFT JOIN (
      SELECT iid, list_sort(list(DISTINCT label)) AS ls FROM lines
      JOIN (VALUES {_values(q.PHRASES)}) r(label, phrase) ON contains(line, concat(' ', phrase, ' '))
      GROUP BY iid) f USING (iid)""",
    "keyword_phrases_by_join": f"""SELECT p.iid, {FOUND_LABELS} FROM prepared p LEFT JOIN (
      SELECT iid, list_sort(list(DISTINCT concat('length ', length(tok)))) AS ls
      FROM (SELECT iid, {PAIRED} AS tok FROM (
        SELECT iid, string_split(trim(line), ' ') AS w FROM lines))
      JOIN (SELECT DISTINCT {PAIRED} AS tok FROM (
        SELECT list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}]+'), lambda x: x <> '') AS w
        FROM benchmark)) USING (tok)
      GROUP BY iid) f USING (iid)""",
    "validate_labels": f"""SELECT iid, coalesce(array_to_string(list_filter(list_transform(
      string_split(concat(' EU,', state, ',,eu , Daten\t,Unklar,', CASE WHEN upvotes > 5
        THEN 'Low Code, EU' ELSE 'Low  Code,Open Source' END), ','),
      lambda part: trim(part, {_text(PYTHON_WHITE_SPACE)})),
      lambda label: label IN {_in(LABEL_VOCABULARY)}), '|'), '') AS labels FROM raw""",
    "org_attribution": "SELECT iid, org FROM enriched",
    "build_prompts": f"""SELECT iid,
      concat('Labels?', repeat(chr(10), 3), 'Labels:', chr(10), {_text(", ".join(LABEL_VOCABULARY))},
        chr(10), chr(10), 'Issue:', chr(10), desc_clean, chr(10)) AS label_prompt,
      concat('Organisation?', repeat(chr(10), 3), 'Titel:', chr(10), title, chr(10), chr(10),
        'Inhalt:', chr(10), desc_clean, chr(10)) AS org_prompt FROM prepared""",
    "pending_enrichment": """SELECT iid, form_page, feedback_round FROM prepared
      WHERE feedback_round = 2""",
    "assemble_enriched": f"""SELECT iid, form_page, {SENTIMENT}, {FOUND_LABELS}, org
      FROM enriched""",
    "pluggable_scorer": """SELECT iid, CAST(CASE WHEN form_page = '/src5/' THEN 0.0
      ELSE length(desc_clean) % 3 - 1.0 END AS DOUBLE) AS sentiment FROM prepared""",
    "scorer_failures": """SELECT iid, CAST(CASE WHEN form_page = '/src5/' THEN 0.0
      ELSE length(desc_clean) % 3 - 1.0 END AS DOUBLE) AS sentiment,
      CAST(CASE WHEN form_page = '/src5/' THEN 1 ELSE 0 END AS BIGINT) AS failed FROM prepared""",
    "filter_labels_all": _filtered(
        " AND ".join(f"list_contains(labels, {_text(label)})" for label in q.TOGETHER)
    ),
    "filter_page": _filtered(f"form_page IN {_in(q.PAGES)}"),
    "filter_sentiment": _filtered(f"sentiment BETWEEN {q.RANGE[0]} AND {q.RANGE[1]}"),
    "filter_author": _filtered(f"author_name IN {_in(q.AUTHORS)}"),
    "search_text": _filtered(f"regexp_matches(lower(desc_clean), {_text(q.SEARCH.lower())})"),
    "search_literal": _filtered("contains(lower(desc_clean), 'the.')"),
    "filter_org": _filtered(f"org IN {_in(q.ORGS)}"),
    "filter_round": _filtered("feedback_round = 2"),
    "filtered_issues": _filtered(FILTERED),
    "facet_labels": "SELECT DISTINCT label FROM exploded WHERE label IS NOT NULL ORDER BY 1",
    "facet_pages": _facet("form_page"),
    "facet_authors": _facet("author_name"),
    "facet_orgs": _facet("org"),
    "facet_rounds": _facet("feedback_round"),
    "sample_issues": f"""SELECT iid, title, desc_clean, org FROM post
      ORDER BY md5(concat('{q.SAMPLE_SEED}:', iid)), iid LIMIT {q.SAMPLE_SIZE}""",
    "issue_cards": """SELECT iid, title, desc_clean, form_page,
      array_to_string(labels, ', ') AS labels, printf('%.2f', sentiment) AS sentiment,
      author_name FROM post""",
    "overview_metrics": """SELECT count(*) AS n_issues, round(avg(sentiment), 6)
      AS mean_sentiment, count(DISTINCT author_id)
      + CAST(bool_or(author_id IS NULL) AS INTEGER) AS n_authors FROM post""",
    "issues_per_day": """SELECT CAST(created_at AS DATE) AS day, count(*) AS n_issues FROM post
      GROUP BY 1""",
    "label_counts": "SELECT label, count(*) AS n_issues FROM exploded GROUP BY label",
    "form_counts": _counts("is_from_form"),
    "sentiment_by_label": """SELECT label, round(avg(sentiment), 6) AS mean_sentiment
      FROM exploded GROUP BY label""",
    "sentiment_by_page": """SELECT form_page, round(avg(sentiment), 6) AS mean_sentiment
      FROM post GROUP BY form_page""",
    "issues_by_author": _counts("author_name"),
    "issues_by_org": _counts("org"),
    "issues_by_org_captioned": """SELECT org AS "Organisation", count(*) AS "Anzahl Issues"
      FROM post GROUP BY org""",
    "merged_overview": f"""WITH {EDITED} SELECT count(*) AS n_issues,
      round(avg(sentiment), 6) AS mean_sentiment, count(DISTINCT author_id)
      + CAST(bool_or(author_id IS NULL) AS INTEGER) AS n_authors FROM edited""",
    "merged_figures": f"WITH {EDITED} {FIGURES}",
    "assigned_labels": "SELECT DISTINCT label FROM exploded",
    "unassigned_labels": """SELECT label FROM vocabulary
      WHERE label NOT IN (SELECT label FROM exploded)""",
    "label_support": """SELECT label, count(DISTINCT iid) AS n_issues FROM exploded
      GROUP BY label""",
    "label_cooccurrence": PAIRS,
    "labels_mostly_together": f"""SELECT label_a, label_b,
      round(p.n_issues / a.n, 6) AS share_a_with_b, round(p.n_issues / b.n, 6) AS share_b_with_a
      FROM ({PAIRS}) p
      JOIN (SELECT label, count(*) AS n FROM exploded GROUP BY 1) a ON a.label = label_a
      JOIN (SELECT label, count(*) AS n FROM exploded GROUP BY 1) b ON b.label = label_b
      WHERE p.n_issues / a.n > 0.8 AND p.n_issues / b.n > 0.8""",
    "schema_diff": """SELECT "column", in_old, in_new, type_old, type_new FROM (VALUES
      ('feedback_round', false, true, NULL, 'tinyint'),
      ('form_page', true, true, 'string', 'string'),
      ('iid', true, true, 'bigint', 'bigint'),
      ('state', true, true, 'string', 'string'),
      ('updated_at', true, true, 'timestamp_ntz', 'timestamp_ntz'))
      AS t("column", in_old, in_new, type_old, type_new)""",
    "incremental_stream": """SELECT form_page, count(*) AS n_issues FROM post
      GROUP BY form_page""",
    "incremental_stream_by_state": f"""SELECT iid, form_page, {SENTIMENT}, {JOINED_LABELS}, org,
      CASE iid % 2 WHEN 0 THEN DATE '{q.OLD_DATE}' ELSE DATE '{q.NEW_DATE}' END AS processing_date
      FROM post""",
}
# Copies of a text by the night that brought them, then as ever.
FIRST = "PARTITION BY title, description ORDER BY created_at, iid) = 1),\ndescribed"
BY_NIGHT = "PARTITION BY title, description ORDER BY iid % 2, created_at, iid) = 1),\ndescribed"



def _whole(select: str, common: str = RAW.strip()) -> str:
    """A select after the shared tables; one with tables of its own adds them to these."""
    return f"WITH {common}, {select[5:]}" if select.startswith("WITH ") else f"WITH {common}\n{select}"


SQL = {name: _whole(select) for name, select in SELECTS.items()}
SQL["incremental_stream_by_state"] = _whole(
    SELECTS["incremental_stream_by_state"], RAW.strip().replace(FIRST, BY_NIGHT)
)
