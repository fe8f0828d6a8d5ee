"""Scale properties of the physical plans, as regression guards."""

import pytest

import __spark_entry__ as entry

from conftest import SF0001

QUERIES = entry.queries()
# the optional training-data queries are tested in a folder of their own
BATCH = sorted(n for n in QUERIES if not n.startswith(("stream_", "sink_", "src_", "parse_", "op")) and n != "pipeline")
# bounded single-task steps: top-k over k rows; a running value over a table of
# one row for 30 days
SINGLE_TASK_OK = {
    "topk_global", "late_record_split", "late_window_split", "allowed_lateness", "lateness_firings", "uv_sliding", "uv_approx",
}


def plan(spark, name):
    return QUERIES[name](spark, SF0001)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_pairs_and_no_single_task(spark, name):
    p = plan(spark, name)
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p
    if name not in SINGLE_TASK_OK:
        assert "SinglePartition" not in p


@pytest.mark.parametrize("name", ["hot_items", "hot_items_sql", "hot_urls"])
def test_top_n_limits_before_the_shuffle(spark, name):
    p = plan(spark, name)
    assert "WindowGroupLimit" in p and "Partial" in p


@pytest.mark.parametrize("name", ["hot_items", "pv_sliding", "uv_sliding", "uv_hashed_bitmap", "topk_global"])
def test_page_view_filter_reaches_the_scan(spark, name):
    assert "EqualTo(event_type,view)" in plan(spark, name)


def test_word_count_reads_only_text(spark):
    assert "ReadSchema: struct<text:string>" in plan(spark, "word_count")
