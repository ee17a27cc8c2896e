from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from echolot.config import CLEAN_COLUMNS, IngestConfig
from echolot.operators import cleaning
from echolot.schemas import CLEAN_SCHEMA, RAW_SCHEMA

CFG = IngestConfig()
PREFIX = CFG.form_prefix


def raw_row(iid, title="t", description="d", created="2026-01-01T00:00:00Z", **fields):
    row = {
        "iid": iid,
        "title": title,
        "description": description,
        "state": "opened",
        "created_at": created,
        "updated_at": "2026-01-02T00:00:00Z",
        "closed_at": None,
        "author": {"id": 1, "name": "a", "state": "active"},
        "user_notes_count": 0,
        "upvotes": 0,
        "downvotes": 0,
        "references": {"short": "#1", "relative": "#1", "full": "g#1"},
    }
    return {**row, **fields}


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_SCHEMA)


def ids(df):
    return sorted(row.iid for row in df.select("iid").collect())


def test_clean_issues_has_the_fixed_schema(spark):
    clean = cleaning.clean_issues(raw(spark, raw_row(9)))
    assert tuple(clean.columns) == CLEAN_COLUMNS
    kinds = [(f.name, f.dataType) for f in clean.schema.fields]
    assert kinds == [(f.name, f.dataType) for f in CLEAN_SCHEMA.fields]


def test_excluded_ids(spark):
    rows = [raw_row(i, title=str(i)) for i in range(1, 12)]
    assert ids(cleaning.clean_issues(raw(spark, *rows))) == [9, 10, 11]


def test_dedupe_keeps_the_earliest_and_null_equals_null(spark):
    rows = [
        raw_row(10, "a", "x", "2026-01-03T00:00:00Z"),
        raw_row(11, "a", "x", "2026-01-02T00:00:00Z"),
        raw_row(12, "a", None),
        raw_row(13, "a", None),
        raw_row(14, "a", ""),
        raw_row(15, None, None),
        raw_row(16, None, None),
        raw_row(17, "", None),
    ]
    assert ids(cleaning.clean_issues(raw(spark, *rows))) == [11, 12, 14, 15, 17]


def test_content_key_tells_null_from_text(spark):
    rows = [raw_row(10, "a", None), raw_row(11, "a", ""), raw_row(12, "a", "null"), raw_row(13)]
    keys = raw(spark, *rows).select(cleaning.content_key().alias("k"))
    assert keys.distinct().count() == 4


def test_dedupe_against_history(spark):
    history = raw(spark, raw_row(10, "a", "x"), raw_row(11, "b", None))
    known = history.select(cleaning.content_key().alias("content_key"), "iid")
    rows = [raw_row(20, "a", "x"), raw_row(21, "b", None), raw_row(22, "c"), raw_row(23, "c")]
    assert ids(cleaning.clean_issues(raw(spark, *rows), known=known)) == [22]


def test_form_source_and_page_names(spark):
    titles = {
        20: f"{PREFIX}",
        21: f"{PREFIX} /",
        22: f"{PREFIX}\t/a/",
        23: f"{PREFIX} /a//",
        24: f"{PREFIX}\xa0/b \n",
        25: "feedback für die Seite /c",
        26: f" {PREFIX} /d",
        27: None,
    }
    df = raw(spark, *(raw_row(i, title) for i, title in titles.items()))
    df = cleaning.normalize_pages(cleaning.form_source(df))
    got = {row.iid: (row.is_from_form, row.form_page) for row in df.collect()}
    assert got == {
        20: (True, ""),
        21: (True, "home"),
        22: (True, "/a"),
        23: (True, "/a/"),
        24: (True, "/b"),
        25: (False, "Via OpenCode"),
        26: (False, "Via OpenCode"),
        27: (None, "Via OpenCode"),
    }


def test_excluded_descriptions(spark):
    texts = {20: None, 21: "", 22: "test", 23: "Test", 24: "TEST", 25: CFG.boilerplate, 26: "test "}
    df = raw(spark, *(raw_row(i, str(i), text) for i, text in texts.items()))
    assert ids(cleaning.prepare_issues(df)) == [24, 26]


def test_boilerplate_goes_everywhere_in_the_text(spark):
    df = raw(spark, raw_row(20, description=f"{CFG.boilerplate}a{CFG.boilerplate}b"))
    assert cleaning.clean_description(df).first().desc_clean == "ab"


def test_pages_are_excluded_before_they_are_named(spark):
    df = raw(
        spark,
        raw_row(20, f"{PREFIX} /wtf"),
        raw_row(21, f"{PREFIX} /wtf/"),
        raw_row(22, f"{PREFIX} /beteiligung?utm_source=chatgpt.com"),
    )
    df = cleaning.form_source(df).withColumn("labels_v1", F.array().cast("array<string>"))
    rows = cleaning.postprocess_issues(df).collect()
    assert [(row.iid, row.form_page, row.labels_v1) for row in rows] == [(21, "/wtf", ["Unklar"])]


def test_prepare_is_idempotent(spark):
    df = cleaning.prepare_issues(raw(spark, raw_row(20, description=f"{CFG.boilerplate}x")))
    again = cleaning.prepare_issues(df)
    assert df.collect() == again.collect()


def test_feedback_round(spark):
    df = spark.createDataFrame(
        [(1, datetime(2025, 12, 31, 23, 59, 59)), (2, datetime(2026, 1, 1)),
         (3, datetime(2027, 1, 1)), (4, None)],
        "iid long, created_at timestamp_ntz",
    )
    got = {row.iid: row.feedback_round for row in cleaning.feedback_round(df).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: None}
    assert dict(cleaning.feedback_round(df).dtypes)["feedback_round"] == "tinyint"


def test_watermark_is_strict_and_optional(spark):
    mark = datetime(2026, 1, 1, 0, 0, 0, 500000)
    df = spark.createDataFrame(
        [(1, mark), (2, mark.replace(microsecond=500001)), (3, datetime(2020, 1, 1))],
        "iid long, created_at timestamp_ntz",
    )
    assert ids(cleaning.new_issues(df, mark)) == [2]
    assert ids(cleaning.new_issues(df, None)) == [1, 2, 3]


def test_missing_creation_time_fails_or_drops(spark):
    df = spark.createDataFrame([(1, None)], "iid long, created_at timestamp_ntz")
    mark = datetime(2026, 1, 1)
    assert ids(cleaning.new_issues(df, mark, strict=False)) == []
    with pytest.raises(Exception, match="issue without created_at"):
        cleaning.new_issues(df, mark).collect()


def test_closing_time_is_optional_and_lenient(spark):
    df = raw(spark, raw_row(20, closed_at="bad"), raw_row(21, closed_at="2026-01-05T00:00:00Z"))
    closed = {row.iid: row.closed_at for row in cleaning.parse_timestamps(df).collect()}
    assert closed == {20: None, 21: datetime(2026, 1, 5)}
    assert "closed_at" not in cleaning.parse_timestamps(df.drop("closed_at")).columns
