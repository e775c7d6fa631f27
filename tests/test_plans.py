"""What no plan may contain, and what some plans must."""

import os
import re

import pytest

from brightweir.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")

# Queries whose plan is only the read of a table they have written.
WRITTEN = {"idempotent_upsert", "entity_mapping_log", "export_roundtrip", "stream_fresh_ingest", "stream_news_ingest", "stream_quarantine", "stream_source_counts", "table_counts"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in WRITTEN])
def test_no_pairwise_or_single_task_operators(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert forbidden not in text, forbidden
    # One task sees all rows only after they have been aggregated or cut to a limit.
    for position in (m.start() for m in re.finditer("Exchange SinglePartition", text)):
        assert re.search(r"Aggregate|TakeOrdered|Limit", text[position : position + 600])


@pytest.mark.parametrize(
    "name, columns",
    [
        ("token_budget", {"text", "lang", "source"}),
        ("dedup_accounting", {"doc_id", "text", "source"}),
        ("freshness_filter", {"event_id", "ts", "user_id", "event_type"}),
        ("html_strip_tags", {"page_id", "html"}),
        ("date_format_iso", {"event_id", "ts"}),
    ],
)
def test_scans_read_only_what_is_needed(spark, name, columns):
    text = plan(QUERIES[name](spark, SF))
    for schema in re.findall(r"ReadSchema: struct<(.*?)>\n", text + "\n"):
        assert {part.split(":")[0] for part in schema.split(",")} <= columns


def test_freshness_reaches_the_scan(spark):
    assert "GreaterThanOrEqual(ts," in plan(QUERIES["freshness_filter"](spark, SF))
