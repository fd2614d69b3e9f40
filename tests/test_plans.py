"""Shapes that no registered query may have."""

import pytest

import __spark_entry__ as spark_entry
from tests.helpers import plan
from tests.test_oracle import SF_DIR

STORED = {
    "bronze_schema_merge", "compact_bronze", "pack_summaries", "incremental_silver", "silver_rebuild",
    "refresh_cycle", "gold_catalog", "load_marts_orders", "load_marts_clicks",
    "stream_ingest_bronze", "stream_quarantine", "stream_summary_log",
    "stream_revenue_per_minute", "stream_dedup",
}


OWN = {q.__name__ for q in spark_entry._QUERIES}


@pytest.mark.parametrize("name", sorted(OWN - STORED))
def test_no_cross_join_no_python_no_single_task_window(spark, name):
    text = plan(spark_entry.queries()[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "MapInArrow"):
        assert node not in text
    lines = text.splitlines()
    for line, below in zip(lines, lines[1:]):
        if "Window [" in line:
            assert "windowspecdefinition(" in line
        if "Exchange SinglePartition" in line:
            # Only already aggregated rows, one per task, may meet in one task.
            assert "Aggregate(" in below and ("partial_" in below or "merge_" in below)


def test_updates_are_matched_by_equality(spark):
    for name in ("silver_upsert", "silver_upsert_clicks"):
        text = plan(spark_entry.queries()[name](spark, SF_DIR))
        assert "LeftAnti" in text
