"""Every query with SQL against DuckDB on the smallest data."""

from __future__ import annotations

import pytest
from rows import same_rows

from tickforge.jobs import catalog

SLOW = {"quality_json"}


@pytest.mark.parametrize("name", [n for n, (_, text) in catalog.ENTRIES.items() if text])
def test_query_equals_sql(spark, tiny, duck, name):
    same_rows(catalog.queries()[name](spark, tiny).toPandas(), duck.sql(catalog.ENTRIES[name][1]).df())


def test_report_is_json(spark, tiny):
    import json

    rows = catalog.queries()["quality_json"](spark, tiny).collect()
    report = json.loads(rows[0]["value"])
    assert rows[0]["key"].startswith("quality:") and 0 <= report["overall_quality_score"] <= 100
    assert len(report["recommendations"]) <= 5 and 50 <= len(report["feature_quality_scores"]) <= 56  # columns without any value have no score


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
