"""Pages that drift from the schema: every value is kept, and no record ends the run."""

from __future__ import annotations

import json

import pytest
from test_cleaning import raw_row
from test_ingest import DAY1, DAY2, Deployment, row

from echolot.schemas import RAW_SCHEMA
from echolot.sources.drift import (
    BAD,
    RESCUED,
    TooManyBadRecords,
    field_kinds,
    read_drifting_pages,
    write_quarantine,
)
from echolot.sources.pages import read_issue_pages
from echolot.sources.tables import load_issues

GOOD = {"iid": 1, "title": "a", "created_at": "2026-01-01T00:00:00Z"}


def land(folder, *lines, name="1.json"):
    folder.mkdir(exist_ok=True)
    text = "\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines)
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


@pytest.fixture
def read(spark, tmp_path):
    def of(*lines, **options):
        rows = read_drifting_pages(spark, land(tmp_path / "pages", *lines), **options).collect()
        return [(r.iid, r[BAD] and tuple(r[BAD]), {e.field: e.value for e in r[RESCUED]}) for r in rows]

    return of


def test_without_drift_equal_to_the_plain_reader(spark, tmp_path):
    rows = [raw_row(i, f'title "{i}" ü\n', created=f"2026-01-0{i}T00:00:00.25Z") for i in range(1, 6)]
    path = land(tmp_path / "pages", rows[:3], [], "", rows[3], rows[4:])
    plain = read_issue_pages(spark, path)
    got = read_drifting_pages(spark, path)
    assert got.where(f"{BAD} IS NOT NULL OR size({RESCUED}) > 0").isEmpty()
    assert got.select(*RAW_SCHEMA.fieldNames()).schema == plain.schema
    assert sorted(got.select(*plain.columns).collect()) == sorted(plain.collect())


def test_unknown_fields_and_other_types_are_rescued(read):
    assert read(
        [
            {**GOOD, "weight": [1, {"k": None}], "author": {"id": 3, "pic": None}},
            {**GOOD, "iid": 2, "upvotes": "many", "downvotes": "4", "user_notes_count": 1.5, "title": 7},
            {**GOOD, "iid": 3, "author": "me", "references": [1], "author.pic": 9},
            {**GOOD, "iid": "4", "title": {"de": "x"}, "upvotes": True, "state": None},
        ]
    ) == [
        (1, None, {"weight": '[1,{"k":null}]', "author.pic": "null"}),
        (2, None, {"upvotes": '"many"', "user_notes_count": "1.5"}),
        (3, None, {"author": '"me"', "references": "[1]", "author.pic": "9"}),
        (4, None, {"upvotes": "true"}),
    ]


def test_values_read_as_the_types_of_the_columns(spark, tmp_path):
    path = land(tmp_path / "pages", [{**GOOD, "title": 7, "state": {"a": [1]}, "downvotes": "4", "upvotes": "04"}])
    got = read_drifting_pages(spark, path).first()
    assert (got.title, got.state, got.downvotes, got.upvotes) == ("7", '{"a":[1]}', 4, None)
    assert [tuple(e) for e in got[RESCUED]] == [("upvotes", '"04"')]


def test_bad_records_and_pages_keep_their_text(read):
    cut = '[{"iid": 9, "title": "cut'
    twice = '[{"iid": 1, "iid": 2}]'
    rows = read(cut, twice, [5, None, GOOD], {**GOOD, "iid": None}, [{**GOOD, "created_at": "soon"}], "null", "  ")
    assert sorted(rows, key=str) == sorted(
        [
            (None, ("page", cut), {}),
            (None, ("page", twice), {}),
            (None, ("record", "5"), {}),
            (None, ("record", "null"), {}),
            (1, None, {}),
            (None, ("required", json.dumps({**GOOD, "iid": None}, separators=(",", ":"), sort_keys=True)), {}),
            (1, ("required", '{"created_at":"soon","iid":1,"title":"a"}'), {}),
            (None, ("record", "null"), {}),
        ],
        key=str,
    )


def test_whole_file_pages_and_no_files(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "1.json").write_text(json.dumps([GOOD, {**GOOD, "iid": 2, "x": 1}], indent=2))
    rows = read_drifting_pages(spark, str(tmp_path / "p"), one_page_per_file=True)
    assert sorted((r.iid, len(r[RESCUED])) for r in rows.collect()) == [(1, 0), (2, 1)]
    assert read_drifting_pages(spark, []).count() == 0
    assert field_kinds(spark, []).count() == 0


def test_kinds_of_all_fields(spark, tmp_path):
    path = land(
        tmp_path / "pages",
        [GOOD, {**GOOD, "iid": "2", "author": {"id": 1, "pic": "u"}}, {**GOOD, "author": None, "extra": 0.5}],
        "broken",
    )
    got = {(r.field, r.expected, r.found): r.n for r in field_kinds(spark, path).collect()}
    assert got == {
        ("iid", "long", "BIGINT"): 2,
        ("iid", "long", "STRING"): 1,
        ("title", "string", "STRING"): 3,
        ("created_at", "string", "STRING"): 3,
        ("author", "struct", "OBJECT"): 1,
        ("author", "struct", "VOID"): 1,
        ("author.id", "long", "BIGINT"): 1,
        ("author.pic", None, "STRING"): 1,
        ("extra", None, "DECIMAL"): 1,
    }


def test_quarantine_is_written_once(spark, tmp_path):
    path = land(tmp_path / "pages", "cut", "cut", [{**GOOD, "x": 1}, {**GOOD, "iid": 2, "x": 1}])
    side = str(tmp_path / "side")
    for _ in range(2):
        write_quarantine(read_drifting_pages(spark, path), side)
    rows = spark.read.parquet(side)
    assert sorted((r.reason, r.iid or 0, r.field, r.content) for r in rows.collect()) == [
        ("field", 1, "x", "1"), ("field", 2, "x", "1"), ("page", 0, None, "cut"),
    ]
    land(tmp_path / "pages", {**GOOD, "iid": 3, "y": 2}, name="2.json")
    write_quarantine(read_drifting_pages(spark, path), side)
    assert spark.read.parquet(side).count() == 4


@pytest.fixture
def site(spark, tmp_path):
    return Deployment(spark, tmp_path)


def test_run_goes_on_past_drift(spark, site, tmp_path):
    side = str(tmp_path / "side")
    site.land("1", row(20, 1, upvotes="many"), row(21, 2, extra=[1]), row(22, 3), {"iid": 23}, 5)
    (site.landing / "2.json").write_text('[{"iid": 30')
    with pytest.raises(Exception, match="(?i)malformed|failfast|parse"):
        site.run(DAY1)
    run = site.run(DAY1, quarantine=side)
    assert (run.fetched, run.new, run.saved, run.bad, run.rescued) == (3, 3, 3, 3, 2)
    assert site.ids() == [20, 21, 22]
    assert load_issues(spark, site.table).filter("iid = 20").first().upvotes is None
    reasons = sorted(r.reason for r in spark.read.parquet(side).collect())
    assert reasons == ["field", "field", "page", "record", "required"]
    again = site.run(DAY2, quarantine=side)
    assert (again.new, again.bad, spark.read.parquet(side).count()) == (0, 3, 5)


def test_too_many_bad_records_publish_nothing(spark, site, tmp_path):
    side = str(tmp_path / "side")
    site.land("1", row(20, 1), row(21, 2), row(22, 3), "text")
    with pytest.raises(TooManyBadRecords) as failed:
        site.run(DAY1, quarantine=side, max_bad_share=0.2)
    assert (failed.value.bad, failed.value.records) == (1, 4)
    assert site.ids() == [] and spark.read.parquet(side).count() == 1
    assert site.run(DAY1, quarantine=side, max_bad_share=0.25).saved == 3


def test_another_watermark_column_may_lack(spark, site, tmp_path):
    from dataclasses import replace

    from test_ingest import CFG

    site.land("1", row(20, 1, updated_at="2026-01-11T00:00:00Z"), row(21, 2, updated_at=None))
    run = site.run(DAY1, cfg=replace(CFG, watermark_column="updated_at"), quarantine=str(tmp_path / "side"))
    assert (run.new, run.bad) == (1, 1)
