"""What the physical plans must and must not hold."""

from __future__ import annotations

import re

import pytest

from echolot.config import IssueFilter
from echolot.operators import cleaning, enrichment, metrics, predicates, quality
from echolot.plans.catalog import QUERIES
from echolot.plans.document_issues import DOCUMENT_CONFIG as CFG
from echolot.plans.ingest import process_issues
from echolot.schemas import ISSUE_SCHEMA, RAW_SCHEMA
from echolot.sources.tables import latest_per_issue

SF = "/root/testdata/sf0.001"


def plan(df, mode="simple"):
    modes = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    return df._jdf.queryExecution().explainString(modes.fromString(mode))


def exchanges(text):
    return len(re.findall(r"Exchange (?:hash|range)partitioning", text))


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "raw")
    spark.createDataFrame([], RAW_SCHEMA).write.parquet(path)
    return spark.read.schema(RAW_SCHEMA).parquet(path)


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "table")
    spark.createDataFrame([], ISSUE_SCHEMA).write.parquet(path)
    return spark.read.schema(ISSUE_SCHEMA).parquet(path)


def test_ingest_shuffles_once_and_trims_copies_first(raw):
    text = plan(process_issues(raw, CFG))
    assert exchanges(text) == 1
    assert text.index("row_number(), 1, Final") < text.index("row_number(), 1, Partial")
    assert text.count("split(lower(") == 1
    assert "Join" not in text and "Python" not in text


def test_exclusions_run_before_the_shuffle(raw):
    text = plan(process_issues(raw, CFG))
    below = text[text.index("Exchange hashpartitioning") :]
    assert "IN (,test,Test)" in below and "/wtf" in below
    assert re.search(r"PushedFilters: \[.*iid", below)


def test_history_adds_no_shuffle_of_the_issues(spark, raw, tmp_path):
    path = str(tmp_path / "keys")
    spark.createDataFrame([("k", 1)], "content_key string, iid long").write.parquet(path)
    known = spark.read.parquet(path).hint("merge")
    text = plan(cleaning.clean_issues(raw, CFG, known))
    assert exchanges(text) == 2  # the issues and the keys
    assert "SortMergeJoin" in text and "LeftAnti" in text


def test_latest_version_trims_before_its_shuffle(table):
    text = plan(latest_per_issue(table, order=["updated_at"]))
    assert exchanges(text) == 1
    assert "row_number(), 1, Partial" in text


def test_filters_reach_the_scan_of_a_table(table):
    f = IssueFilter(pages=("/a",), authors=("x",), orgs=("o",), rounds=(1,), labels=("EU",))
    text = plan(table.filter(predicates.issue_predicate(f)).select("iid"), "formatted")
    pushed = re.search(r"PushedFilters: (.*)", text).group(1)
    for column in ("sentiment", "form_page", "author_name", "org", "feedback_round"):
        assert column in pushed
    assert re.search(r"ReadSchema: struct<[^>]*iid", text)
    assert "description" not in text


def test_group_bys_read_one_column_and_aggregate_first(table):
    text = plan(metrics.count_by(table, "org"))
    assert re.search(r"ReadSchema: struct<org:string>", text)
    assert "partial_count" in text
    text = plan(metrics.mean_sentiment_by(table, "labels_v1", explode=True, name="label"))
    assert "partial_avg" in text and "desc_clean" not in text


def test_overview_has_no_expand(table):
    text = plan(metrics.overview_metrics(table))
    assert "Expand" not in text and "partial_count" in text


def test_pair_statistics_do_not_join(table):
    text = plan(quality.labels_mostly_together(table))
    assert "Join" not in text
    assert re.search(r"ReadSchema: struct<labels_v1:array<string>>", text)


def test_side_tables_shuffle_the_issues_once(spark, table, tmp_path):
    sides = []
    for name in ("a", "b", "c"):
        path = str(tmp_path / name)
        spark.createDataFrame([(1, 1)], f"iid long, {name} int").write.parquet(path)
        sides.append(spark.read.parquet(path).hint("merge"))
    assert exchanges(plan(enrichment.assemble(table, *sides))) == 4


def test_sample_keeps_few_rows_per_task(table):
    from echolot.operators.facets import sample_issues

    for seed in (None, 1):
        assert "TakeOrderedAndProject" in plan(sample_issues(table, 5, seed))


def test_no_registered_query_multiplies_tables(spark):
    slow = {"incremental_stream", "stage_counts", "schema_diff"}
    for name, query in QUERIES.items():
        if name in slow:
            continue
        text = plan(query(spark, SF))
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name
        assert "BatchEvalPython" not in text, name
