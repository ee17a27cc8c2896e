"""What Python holds at once while pages land and while the stream de-duplicates."""

from __future__ import annotations

import json

from echolot.sources.pages import ARROW_ROWS, write_issue_pages
from echolot.streaming.owners import STATE_CONF


def test_python_gets_one_page_at_a_time(spark, tmp_path):
    def sized(batches):
        for batch in batches:
            yield batch.assign(n=len(batch))

    before = spark.conf.get(ARROW_ROWS)
    rows = spark.range(0, 50, 1, 1).mapInPandas(sized, "id long, n long")
    write_issue_pages(rows, str(tmp_path / "pages"), page_size=7)
    pages = [json.loads(line.value) for line in spark.read.text(str(tmp_path / "pages")).collect()]
    assert sorted(len(page) for page in pages) == [1] + [7] * 7
    assert sorted(r["id"] for page in pages for r in page) == list(range(50))
    assert max(r["n"] for page in pages for r in page) <= 7
    assert spark.conf.get(ARROW_ROWS) == before


def test_the_streams_records_pass_python_in_small_batches():
    assert int(STATE_CONF[ARROW_ROWS]) <= 1000
