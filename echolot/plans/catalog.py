"""Registered queries: every operator over the whole issue view of the documents.

They meet the data as a real deployment does. The raw records are landed once per
application and sources, cleaning and enrichment start from there. The ingest processes
the landed records once, and filters, facets, metrics and quality checks read its table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from echolot.config import FIRST_WATERMARK, IssueFilter
from echolot.functions.iso_time import parse_strict
from echolot.functions.labels import validate_labels as valid_labels
from echolot.functions.terms import tokens
from echolot.operators import cleaning, enrichment, facets, metrics, predicates, quality
from echolot.plans import figures
from echolot.operators.scoring import FAILURES, add_scored, scored, scored_results
from echolot.plans.dashboard import publish_snapshot, read_snapshot
from echolot.plans.document_issues import DOCUMENT_CONFIG as CFG
from echolot.plans.document_issues import raw_issues as document_issues
from echolot.plans.ingest import process_issues, run_batch
from echolot.schemas import RAW_SCHEMA, issue_schema
from echolot.session import scratch_path
from echolot.sources import tables
from echolot.sources.backfill import backfill
from echolot.sources.drift import (
    BAD,
    QUARANTINE_SCHEMA,
    RESCUED,
    field_kinds,
    read_drifting_pages,
)
from echolot.sources.landing import literal_path, record_files, unread_files
from echolot.sources.pages import read_issue_pages, write_issue_pages
from echolot.sources.run_log import committed_runs, load_committed, start_run, write_run
from echolot.sources.run_state import RunState, load_run_state, save_run_state, state_frame
from echolot.sources.snapshot import merge_snapshot, read_current
from echolot.sources.vocabulary import load_label_vocab as load_vocab
from echolot.sources.vocabulary import vocabulary_frame
from echolot.streaming.incremental import run_stream

Query = Callable[[SparkSession, str], DataFrame]

OLD_DATE = date(2025, 12, 31)
NEW_DATE = date(2026, 1, 17)
LABELS = CFG.label_column

# Filter choices of the registered queries; the SQL uses the same values.
PAGES = ("/src4", "home")
AUTHORS = ("author3", "author11", "author39")
ORGS = ("Musterwerk GmbH",)
TOGETHER = ("Standards", "Strategie")
SEARCH = "TH[AE]N "
RANGE = (0.1, 0.5)
FILTER = IssueFilter(
    labels=("Daten",), pages=("Via OpenCode",), sentiment=(-0.5, 0.9), rounds=(1,), search="ther"
)
PHRASES = (
    ("Architektur", "the of"),
    ("Betrieb", "of the"),
    ("Daten", "the of the"),
    ("EU", "de la"),
    ("Low Code", "la de"),
    ("Open Source", "der die"),
    ("Standards", "thor"),
    ("Künstliche Intelligenz", "and the"),
)
SECOND_NIGHT = "2026-01-15T12"  # as the start of an ISO time
SAMPLE_SIZE = 5
SAMPLE_SEED = 42

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


_LANDED: dict[tuple[str, str, str], str] = {}


def _once(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], object]
) -> str:
    """Path of a table that this application derives once from a data directory."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _LANDED:
        path = scratch_path(spark, name)
        build(path)
        _LANDED[key] = path
    return _LANDED[key]


def raw_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed raw records. A table in few files becomes one in evenly sized files."""

    def land(path: str) -> None:
        records = document_issues(spark, sf_dir)
        if len(records.inputFiles()) < spark.sparkContext.defaultParallelism:
            records = records.hint("rebalance")
        records.write.parquet(path, compression=tables.COMPRESSION)

    landed = _once(spark, sf_dir, "raw-issues", land)
    return spark.read.schema(RAW_SCHEMA).parquet(landed)


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processed table: one ingested partition, published as the current snapshot."""

    def ingest(path: str) -> None:
        table = scratch_path(spark, "issues")
        tables.write_partition(process_issues(raw_issues(spark, sf_dir), CFG), table, NEW_DATE)
        publish_snapshot(spark, table, path, buckets=8)

    return read_snapshot(spark, _once(spark, sf_dir, "snapshot", ingest))


def typed_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_issues(spark, sf_dir).transform(cleaning.parse_timestamps)


def prepared_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = cleaning.clean_issues(raw_issues(spark, sf_dir), CFG)
    return cleaning.prepare_issues(clean, CFG)


def text_of(labels: Column | str) -> Column:
    """A label list as text, to compare lists across engines."""
    return F.array_join(labels, "|")


def rounded(df: DataFrame, column: str) -> DataFrame:
    """Float sums depend on the order of rows; six places do not."""
    return df.withColumn(column, F.round(column, 6))


# Sources and sinks


@query
def read_issue_pages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch_path(spark, "pages")
    write_issue_pages(raw_issues(spark, sf_dir), landing)
    return read_issue_pages(spark, landing).select(
        "iid",
        "title",
        "description",
        "state",
        "created_at",
        "updated_at",
        "closed_at",
        F.col("author.id").alias("author_id"),
        F.col("author.name").alias("author_name"),
        "user_notes_count",
        "upvotes",
        "downvotes",
        F.col("references.full").alias("reference"),
    )


@query
def stage_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = tables.write_stage(prepared_issues(spark, sf_dir), scratch_path(spark, "prepared"))
    return stage.select("iid", "created_at", "closed_at", "author_name", "desc_clean", "form_page")


@query
def write_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second write of the newer date replaces the first one and nothing else."""
    base = scratch_path(spark, "issues")
    prepared = cleaning.feedback_round(prepared_issues(spark, sf_dir), CFG)
    columns = ["iid", "form_page", "feedback_round"]
    rows = tables.write_stage(prepared.select(*columns), scratch_path(spark, "rounds"))
    tables.write_partition(rows.filter("feedback_round = 1"), base, OLD_DATE)
    tables.write_partition(rows, base, NEW_DATE)
    tables.write_partition(rows.filter("feedback_round = 2"), base, NEW_DATE)
    return spark.read.parquet(base).select(*columns, tables.PARTITION_COLUMN)


def _two_partitions(spark: SparkSession, sf_dir: str) -> str:
    """An older partition without the round, and a newer one with closed issues."""
    base = scratch_path(spark, "issues")
    columns = ["iid", "state", "updated_at", "form_page", "feedback_round"]
    rounds = cleaning.feedback_round(prepared_issues(spark, sf_dir), CFG).select(*columns)
    rows = tables.write_stage(rounds, scratch_path(spark, "rounds"))
    tables.write_partition(rows.drop("feedback_round"), base, OLD_DATE)
    tables.write_partition(rows.filter("state = 'closed'"), base, NEW_DATE)
    return base


@query
def load_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.load_issues(spark, _two_partitions(spark, sf_dir))


@query
def union_align_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = issues(spark, sf_dir)
    old = rows.select("iid", "form_page", "org")
    return tables.union_aligned([old, rows.select("iid", "org", "sentiment", "feedback_round")])


@query
def latest_per_issue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All issues in one partition; the closed ones again, updated, in a later one."""
    rows = cleaning.clean_issues(raw_issues(spark, sf_dir), CFG)
    rows = rows.select("iid", "state", "updated_at")
    old = rows.withColumn("processing_date", F.lit(OLD_DATE))
    later = F.col("updated_at") + F.expr("INTERVAL 1 DAY")
    new = rows.filter("state = 'closed'").withColumns(
        {"updated_at": later, "processing_date": F.lit(NEW_DATE)}
    )
    return tables.latest_per_issue(old.unionByName(new))


@query
def load_label_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vocabulary file with a label, a blank and a comment line per source and language."""
    path = scratch_path(spark, "vocabulary")
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    label = F.concat(F.lit(" "), "source", F.lit(" "), "lang", F.lit("\t"))
    lines = F.array(label, F.lit("  "), F.concat(F.lit("  # "), "lang"))
    documents.select(F.explode(lines).alias("value")).distinct().write.text(path)
    return load_vocab(spark, path)


@query
def run_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    fetched = cleaning.new_issues(typed_issues(spark, sf_dir), FIRST_WATERMARK)
    parsed = raw_issues(spark, sf_dir).withColumn("_created", parse_strict(F.col("created_at")))
    raw = cleaning.new_issues(parsed, FIRST_WATERMARK, "_created").drop("_created")
    return state_frame(fetched, process_issues(raw, CFG))


@query
def run_state_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of a run as the next one loads it: of two records the later one."""
    path = scratch_path(spark, "state")
    row = run_state(spark, sf_dir).first()
    save_run_state(spark, path, RunState(FIRST_WATERMARK, 1, 1))
    watermark = datetime.strptime(row.last_successful_run, "%Y-%m-%dT%H:%M:%S.%fZ")
    saved = RunState(watermark, row.last_fetched_issues, row.total_issues_processed)
    save_run_state(spark, path, saved)
    state = load_run_state(spark, path)
    values = (state.last_successful_run, state.last_fetched_issues, state.total_issues_processed)
    return spark.createDataFrame([values], "last_successful_run timestamp_ntz, fetched long, processed long")


@query
def run_without_new_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run over the same pages reads them, finds nothing new and writes nothing."""
    landing, table, state = (scratch_path(spark, name) for name in ("pages", "issues", "state"))
    write_issue_pages(raw_issues(spark, sf_dir), landing)
    run_batch(spark, landing, table, state, OLD_DATE, CFG)
    run = run_batch(spark, landing, table, state, NEW_DATE, CFG)
    dates = spark.read.parquet(table).agg(F.count_distinct(tables.PARTITION_COLUMN).alias("dates"))
    return dates.select(
        F.lit(run.fetched).cast("long").alias("fetched"),
        F.lit(run.new).cast("long").alias("new"),
        F.lit(run.saved).cast("long").alias("saved"),
        "dates",
    )


@query
def read_new_landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that landed after the manifest was written; the files before are not opened."""
    landing, manifest = scratch_path(spark, "pages"), scratch_path(spark, "manifest")
    raw = raw_issues(spark, sf_dir)
    write_issue_pages(raw.filter("iid % 10 <> 0"), landing)
    record_files(spark, unread_files(spark, landing, manifest), manifest)
    write_issue_pages(raw.filter("iid % 10 = 0"), landing, mode="append")
    new = [literal_path(file.path) for file in unread_files(spark, landing, manifest)]
    return read_issue_pages(spark, new).select("iid", "title", "description", "created_at")


@query
def infer_issue_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages with inferred types."""
    landing = scratch_path(spark, "pages")
    write_issue_pages(raw_issues(spark, sf_dir), landing)
    return read_issue_pages(spark, landing, schema=None).select(
        "iid", "title", "closed_at", "upvotes", F.col("author.id").alias("author_id")
    )


def drifting_landing(spark: SparkSession, sf_dir: str) -> str:
    """Pages of one record, many of them drifted: a new field, texts for numbers, cut pages, a number as record."""
    raw = raw_issues(spark, sf_dir)
    tenth, fiftieth = F.col("iid") % 10, F.col("iid") % 50
    pic = F.when(tenth == 4, F.lit("p"))
    record = F.to_json(
        F.struct(
            *[c for c in raw.columns if c != "author"],
            F.struct("author.*", pic.alias("pic")).alias("author"),
            F.when(tenth == 1, F.col("iid")).alias("weight"),
        )
    )
    # A quote inside a text is escaped, so only the fields themselves are met.
    record = F.when(tenth == 2, F.regexp_replace(record, '"upvotes":([0-9]+)', '"upvotes":"$1 up"')).otherwise(record)
    record = F.when(tenth == 3, F.regexp_replace(record, '"iid":([0-9]+)', '"iid":"$1"')).otherwise(record)
    rest = F.when(fiftieth == 9, "").when(fiftieth == 19, F.concat(F.lit(","), "iid", F.lit("]"))).otherwise("]")
    landing = scratch_path(spark, "pages")
    raw.select(F.concat(F.lit("["), record, rest).alias("value")).write.text(landing)
    return landing


@query
def drifting_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that drifted: what fits the schema, what was rescued, and why a record is bad."""
    drift = F.transform(RESCUED, lambda e: F.concat(e["field"], F.lit("="), e["value"]))
    good = F.col(BAD).isNull()
    return read_drifting_pages(spark, drifting_landing(spark, sf_dir)).select(
        *[F.when(good, F.col(name)).alias(name) for name in ("iid", "title", "description", "upvotes")],
        F.when(good, F.col("author.id")).alias("author_id"),
        F.col(f"{BAD}.reason").alias("reason"),
        F.array_join(drift, ";").alias("drift"),
    )


@query
def page_field_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which kinds of value all fields of the landed records hold."""
    return field_kinds(spark, drifting_landing(spark, sf_dir))


@query
def quarantined_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over drifted pages: its counts, and what its side table holds."""
    side = scratch_path(spark, "quarantine")
    run = run_batch(
        spark,
        drifting_landing(spark, sf_dir),
        scratch_path(spark, "issues"),
        scratch_path(spark, "state"),
        NEW_DATE,
        CFG,
        quarantine=side,
    )
    names = ("fetched", "new", "saved", "bad", "rescued")
    counts = spark.createDataFrame([(name, None, getattr(run, name)) for name in names], "reason string, field string, n long")
    rows = spark.read.schema(QUARANTINE_SCHEMA).parquet(side)
    return counts.unionByName(rows.groupBy("reason", "field").agg(F.count(F.lit(1)).alias("n")))


@query
def two_step_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two committed runs with keys and a manifest; a run between them was written, but never committed."""
    landing, table, log = (scratch_path(spark, name) for name in ("pages", "issues", "log"))
    raw = raw_issues(spark, sf_dir)
    early = F.col("created_at") <= SECOND_NIGHT
    lists = {"run_log": log, "manifest": log, "keys_path": log}
    write_issue_pages(raw.filter(early), landing)
    run_batch(spark, landing, table, "", OLD_DATE, CFG, **lists)
    write_run(load_committed(spark, table, log).drop(tables.PARTITION_COLUMN), table, start_run(committed_runs(spark, log), NEW_DATE))
    write_issue_pages(raw.filter(~early), landing, mode="append")
    run_batch(spark, landing, table, "", NEW_DATE, CFG, **lists)
    return load_committed(spark, table, log).select("iid", "created_at", "author_name", "feedback_round", "processing_date")


@query
def snapshot_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot of one partition, brought up to a later one with the closed issues, updated."""
    table, base = scratch_path(spark, "issues"), scratch_path(spark, "buckets")
    rows = cleaning.clean_issues(raw_issues(spark, sf_dir), CFG).select("iid", "state", "updated_at")
    rows = tables.write_stage(rows, scratch_path(spark, "versions"))
    tables.write_partition(rows, table, OLD_DATE)
    merge_snapshot(spark, table, base, rows.schema, buckets=8)
    later = F.col("updated_at") + F.expr("INTERVAL 1 DAY")
    tables.write_partition(rows.filter("state = 'closed'").withColumn("updated_at", later), table, NEW_DATE)
    merge_snapshot(spark, table, base, rows.schema)
    return read_current(spark, base, rows.schema).drop(tables.BATCH_COLUMN)


@query
def backfill_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partition from before the round existed gets it; the newer one, other values in it, stays."""
    base = scratch_path(spark, "issues")
    prepared = prepared_issues(spark, sf_dir).select("iid", "created_at", "form_page")
    rows = tables.write_stage(prepared, scratch_path(spark, "unnumbered"))
    tables.write_partition(rows, base, OLD_DATE)
    own = rows.withColumn("feedback_round", F.lit(9).cast("byte"))
    tables.write_partition(own.filter("iid % 3 = 0"), base, NEW_DATE)
    backfill(spark, base, "feedback_round", lambda df: cleaning.feedback_round(df, CFG))
    return tables.load_issues(spark, base)


@query
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of a whole batch run, observed while it writes."""
    landing = scratch_path(spark, "pages")
    write_issue_pages(raw_issues(spark, sf_dir), landing)
    run = run_batch(
        spark,
        landing,
        scratch_path(spark, "issues"),
        scratch_path(spark, "state"),
        NEW_DATE,
        CFG,
    )
    counts = [
        ("fetched", run.fetched),
        ("new", run.new),
        ("prepared", run.prepared),
        ("saved", run.saved),
    ]
    return spark.createDataFrame(counts, "stage string, n long")


# Cleaning


@query
def incremental_new_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = cleaning.new_issues(typed_issues(spark, sf_dir), datetime(2026, 1, 1, 12))
    return new.select("iid", "created_at")


@query
def flatten_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = cleaning.flatten_author(raw_issues(spark, sf_dir))
    return flat.select("iid", "author_id", "author_name", "author_state")


@query
def parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_issues(spark, sf_dir).select("iid", "created_at", "updated_at", "closed_at")


@query
def exclude_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.exclude_ids(raw_issues(spark, sf_dir), CFG).select("iid", "title")


@query
def dedupe_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    unique = cleaning.dedupe_issues(typed_issues(spark, sf_dir))
    return unique.select("iid", "title", "description", "created_at")


@query
def clean_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = cleaning.clean_issues(raw_issues(spark, sf_dir), CFG)
    return clean.withColumn("references", F.col("references.full"))


@query
def clean_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_description(raw_issues(spark, sf_dir), CFG).select("iid", "desc_clean")


@query
def form_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = cleaning.form_source(raw_issues(spark, sf_dir), CFG)
    return source.select("iid", "title", "is_from_form", "form_page")


@query
def prepare_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = prepared_issues(spark, sf_dir)
    return prepared.select("iid", "desc_clean", "is_from_form", "form_page", "created_at")


@query
def default_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty lists get the default; lists that are missing stay so."""
    labelled = enrichment.add_labels(prepared_issues(spark, sf_dir), CFG.label_rules)
    known = F.when(F.col("author_id").isNotNull(), F.col(LABELS))
    completed = cleaning.default_labels(labelled.withColumn(LABELS, known), CFG)
    return completed.select("iid", text_of(LABELS).alias("labels"))


@query
def exclude_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = cleaning.exclude_pages(prepared_issues(spark, sf_dir), CFG)
    return kept.select("iid", "form_page")


@query
def normalize_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = cleaning.normalize_pages(prepared_issues(spark, sf_dir), CFG)
    return named.select("iid", "form_page")


@query
def feedback_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounds = cleaning.feedback_round(typed_issues(spark, sf_dir), CFG)
    return rounds.select("iid", "created_at", "feedback_round")


@query
def postprocess_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole processing of raw records in one plan."""
    return process_issues(raw_issues(spark, sf_dir), CFG).select(
        "iid",
        "title",
        "state",
        "created_at",
        "author_name",
        "desc_clean",
        "is_from_form",
        "form_page",
        rounded_sentiment(),
        text_of(LABELS).alias("labels"),
        "org",
        "feedback_round",
    )


def rounded_sentiment() -> Column:
    return F.round("sentiment", 6).alias("sentiment")


# Enrichment


@query
def sentiment_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = enrichment.add_sentiment_scores(prepared_issues(spark, sf_dir), CFG.lexicon)
    return scores.select("iid", rounded_sentiment())


def _benchmark_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of the benchmark passages: a term table that grows with the data."""
    passages = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return passages.select(F.explode(tokens(F.col("text"))).alias("tok")).distinct()


@query
def sentiment_scores_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = _benchmark_words(spark, sf_dir).withColumn("w", F.length("tok") % 5 - 2)
    scores = enrichment.add_sentiment_scores(prepared_issues(spark, sf_dir), weights)
    return scores.select("iid", rounded_sentiment())


@query
def keyword_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = enrichment.add_labels(prepared_issues(spark, sf_dir), CFG.label_rules)
    return labelled.select("iid", text_of(LABELS).alias("labels"))


@query
def keyword_labels_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = _benchmark_words(spark, sf_dir).select(
        F.concat(F.lit("length "), F.length("tok").cast("string")).alias("label"), "tok"
    )
    labelled = enrichment.add_labels(prepared_issues(spark, sf_dir), rules)
    return labelled.select("iid", text_of(LABELS).alias("labels"))


@query
def keyword_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of one to three words that overlap each other and cross line breaks."""
    labelled = enrichment.add_labels(prepared_issues(spark, sf_dir), PHRASES)
    return labelled.select("iid", text_of(LABELS).alias("labels"))


@query
def keyword_phrases_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of neighbouring words of the benchmark passages as rules."""
    passages = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    words = passages.select(F.filter(tokens(F.col("text")), lambda w: w != "").alias("w"))
    pairs = F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.array_join(F.slice("w", i, 2), " "))
    phrases = words.filter(F.size("w") > 1).select(F.explode(pairs).alias("tok")).distinct()
    rules = phrases.select(F.concat(F.lit("length "), F.length("tok").cast("string")).alias("label"), "tok")
    labelled = enrichment.add_labels(prepared_issues(spark, sf_dir), rules)
    return labelled.select("iid", text_of(LABELS).alias("labels"))


@query
def validate_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers with spaces, repetitions, wrong case, empty parts and unknown labels."""
    raw = raw_issues(spark, sf_dir)
    answer = F.concat(
        F.lit(" EU,"),
        F.col("state"),
        F.lit(",,eu , Daten\t,Unklar,"),
        F.when(F.col("upvotes") > 5, "Low Code, EU").otherwise("Low  Code,Open Source"),
    )
    valid = text_of(valid_labels(answer, CFG.vocabulary))
    return raw.select("iid", valid.alias("labels"))


@query
def org_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    attributed = enrichment.add_organization_attribution(prepared_issues(spark, sf_dir))
    return attributed.select("iid", "org")


@query
def build_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = enrichment.build_prompts(
        prepared_issues(spark, sf_dir), CFG.vocabulary, "Labels?", "Organisation?"
    )
    return prompts.select("iid", "label_prompt", "org_prompt")


@query
def pending_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues of the second round, when the first one has its labels already."""
    rows = cleaning.feedback_round(prepared_issues(spark, sf_dir), CFG)
    rows = rows.select("iid", "form_page", "feedback_round")
    done = tables.write_stage(rows.filter("feedback_round = 1"), scratch_path(spark, "labels"))
    return enrichment.pending(rows, done)


@query
def assemble_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each enrichment in a side table of its own, joined at the end."""
    prepared = tables.write_stage(prepared_issues(spark, sf_dir), scratch_path(spark, "prepared"))

    def side(enriched: DataFrame, column: str) -> DataFrame:
        return tables.write_stage(enriched.select("iid", column), scratch_path(spark, column))

    whole = enrichment.assemble(
        prepared,
        side(enrichment.add_sentiment_scores(prepared, CFG.lexicon), "sentiment"),
        side(enrichment.add_labels(prepared, CFG.label_rules), LABELS),
        side(enrichment.add_organization_attribution(prepared), "org"),
    )
    return whole.select(
        "iid", "form_page", rounded_sentiment(), text_of(LABELS).alias("labels"), "org"
    )


def _length_scorer() -> Callable[[list[tuple]], Sequence[float]]:
    """A stand-in for a model: fails on form pages of the fifth source."""

    def score(rows: list[tuple]) -> list[float]:
        if any(page == "/src5/" for _, page in rows):
            raise ValueError("no answer")
        return [len(text) % 3 - 1.0 for text, _ in rows]

    return score


@query
def pluggable_scorer(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = scored(
        "desc_clean", "form_page", make_scorer=_length_scorer, returns="double", default=0.0
    )
    return prepared_issues(spark, sf_dir).select("iid", value.alias("sentiment"))


# Filters


@query
def scorer_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores with the number of failed calls of each row."""
    results = scored_results(
        "desc_clean", "form_page", make_scorer=_length_scorer, returns="double", default=0.0, batch_rows=7
    )
    rows = add_scored(prepared_issues(spark, sf_dir), "sentiment", results)
    return rows.select("iid", "sentiment", F.col(FAILURES).alias("failed"))


def _filtered(condition: Column) -> Query:
    return lambda spark, sf_dir: issues(spark, sf_dir).filter(condition).select("iid", "form_page")


@query
def filter_labels_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filtered(predicates.label_filter(TOGETHER))(spark, sf_dir)


@query
def filter_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filtered(predicates.page_filter(PAGES))(spark, sf_dir)


@query
def filter_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filtered(predicates.sentiment_filter(*RANGE))(spark, sf_dir)


@query
def filter_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filtered(predicates.author_filter(AUTHORS))(spark, sf_dir)


@query
def search_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filtered(predicates.search_filter(SEARCH))(spark, sf_dir)


@query
def search_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filtered(predicates.search_filter("The.", literal=True))(spark, sf_dir)


@query
def filter_org(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filtered(predicates.org_filter(ORGS))(spark, sf_dir)


@query
def filter_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filtered(predicates.round_filter((2,)))(spark, sf_dir)


@query
def filtered_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filtered(predicates.issue_predicate(FILTER))(spark, sf_dir)


# Facets, samples, cards


@query
def facet_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facets.facet(issues(spark, sf_dir), LABELS, explode=True, name="label")


@query
def facet_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facets.facet(issues(spark, sf_dir), "form_page")


@query
def facet_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facets.facet(issues(spark, sf_dir), "author_name")


@query
def facet_orgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facets.facet(issues(spark, sf_dir), "org")


@query
def facet_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facets.facet(issues(spark, sf_dir), "feedback_round")


@query
def sample_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = issues(spark, sf_dir).select("iid", "title", "desc_clean", "org")
    return facets.sample_issues(rows, SAMPLE_SIZE, SAMPLE_SEED)


@query
def issue_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facets.issue_cards(issues(spark, sf_dir))


# Metrics and groups


@query
def overview_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.overview_metrics(issues(spark, sf_dir)), "mean_sentiment")


@query
def issues_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.issues_per_day(issues(spark, sf_dir))


@query
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.count_by(issues(spark, sf_dir), LABELS, explode=True, name="label")


@query
def form_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.count_by(issues(spark, sf_dir), "is_from_form")


@query
def sentiment_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = metrics.mean_sentiment_by(issues(spark, sf_dir), LABELS, explode=True, name="label")
    return rounded(means, "mean_sentiment")


@query
def sentiment_by_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = metrics.mean_sentiment_by(issues(spark, sf_dir), "form_page", nulls_first=False)
    return rounded(means, "mean_sentiment")


@query
def issues_by_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.count_by(issues(spark, sf_dir), "author_name")


@query
def issues_by_org(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.count_by(issues(spark, sf_dir), "org")


@query
def issues_by_org_captioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facets.with_captions(issues_by_org(spark, sf_dir))


def _merged_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partials after two nights: all issues, then the closed ones again, with other values."""

    def publish(path: str) -> None:
        table, schema = scratch_path(spark, "issues"), issue_schema()
        tables.write_partition(process_issues(raw_issues(spark, sf_dir), CFG), table, OLD_DATE)
        merge_snapshot(spark, table, path, schema, buckets=8)
        figures.refresh_figures(spark, path, schema)
        rows = read_current(spark, path, schema).drop(tables.PARTITION_COLUMN, tables.BATCH_COLUMN)
        edited = rows.filter("state = 'closed'").withColumns(
            {
                "sentiment": -F.col("sentiment"),
                "org": F.concat(F.lit("neu "), "org"),
                LABELS: F.concat(LABELS, F.array(F.lit("EU"))),
            }
        )
        tables.write_partition(edited, table, NEW_DATE)
        merge_snapshot(spark, table, path, schema)
        figures.refresh_figures(spark, path, schema)

    return figures.read_figures(spark, _once(spark, sf_dir, "figures", publish))


@query
def merged_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(figures.overview(_merged_figures(spark, sf_dir)), "mean_sentiment")


@query
def merged_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All grouped figures from partials, one row per dimension and value."""
    merged = _merged_figures(spark, sf_dir).filter(F.col("dimension") != figures.ALL)
    grouped = merged.groupBy("dimension", "value").agg(
        F.sum("n").alias("n_issues"),
        (F.sum("scores") / F.sum("n_scores")).alias("mean_sentiment"),
    )
    return rounded(grouped, "mean_sentiment")


# Label and schema quality


@query
def assigned_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assigned_labels(issues(spark, sf_dir))


@query
def unassigned_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = vocabulary_frame(spark, CFG.vocabulary)
    return quality.unassigned_labels(issues(spark, sf_dir), vocabulary)


@query
def label_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.label_support(issues(spark, sf_dir))


@query
def label_cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.label_cooccurrence(issues(spark, sf_dir))


@query
def labels_mostly_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    together = quality.labels_mostly_together(issues(spark, sf_dir))
    return rounded(rounded(together, "share_a_with_b"), "share_b_with_a")


@query
def schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _two_partitions(spark, sf_dir)
    old, new = (
        spark.read.parquet(f"{base}/{tables.PARTITION_COLUMN}={day.isoformat()}")
        for day in (OLD_DATE, NEW_DATE)
    )
    return quality.schema_diff(old, new)


# Streaming


@query
def incremental_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages land in files, the stream ingests them in several batches, pages are counted.

    Which copy of an issue stays depends on the batch that saw it first; its page does
    not, because it follows from the title.
    """
    landing, table = scratch_path(spark, "pages"), scratch_path(spark, "issues")
    write_issue_pages(raw_issues(spark, sf_dir).repartition(8, "iid"), landing)
    stream = run_stream(
        spark,
        landing,
        table,
        scratch_path(spark, "checkpoint"),
        NEW_DATE,
        CFG,
        keys_path=scratch_path(spark, "keys"),
        max_files_per_trigger=4,
    )
    stream.awaitTermination()
    latest = tables.latest_per_issue(tables.load_issues(spark, table))
    return metrics.count_by(latest, "form_page")


@query
def incremental_stream_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two nights of landings; the second run restarts the stream from its checkpoint.

    Issues of the first night own their text, whoever brings it in the second one.
    """
    landing, table = scratch_path(spark, "pages"), scratch_path(spark, "issues")
    checkpoint = scratch_path(spark, "checkpoint")
    for night, day in enumerate((OLD_DATE, NEW_DATE)):
        pages = raw_issues(spark, sf_dir).filter(F.col("iid") % 2 == night)
        write_issue_pages(pages, landing, mode="append")
        run_stream(
            spark, landing, table, checkpoint, day, CFG, dedupe_by_state=True
        ).awaitTermination()
    return tables.load_issues(spark, table).select(
        "iid",
        "form_page",
        rounded_sentiment(),
        text_of(LABELS).alias("labels"),
        "org",
        tables.PARTITION_COLUMN,
    )


QUERIES["read_issue_pages"] = QUERIES.pop("read_issue_pages_query")
