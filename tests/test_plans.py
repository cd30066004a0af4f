"""Physical-plan checks: per-group limit pushed down, anti join, no row-at-a-time Python."""

import re

from gazette import config as C
from gazette.operators import ingest
from gazette.plans import catalog
from gazette.sources import bindings as B


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feed_limit_plans_as_window_group_limit(spark, sf):
    p = _plan(ingest.feed_top_n(B.entries(spark, sf), C.TEST_SETTINGS.max_articles_per_feed))
    assert "WindowGroupLimit" in p


def test_seen_filter_is_an_anti_join(spark, sf):
    p = _plan(catalog.QUERIES["seen_anti"](spark, sf))
    assert "LeftAnti" in p


def test_scan_prunes_columns(spark, sf):
    p = _plan(catalog.QUERIES["reading_minutes"](spark, sf))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p


def test_no_row_at_a_time_python(spark, sf):
    for name in ("deep_read_pick", "page_manifest", "replay_seen", "clean_summary", "week_articles"):
        assert "BatchEvalPython" not in _plan(catalog.QUERIES[name](spark, sf)), name


def test_no_aggregate_carries_article_text(spark, sf):
    df = catalog.QUERIES["deep_read_pick"](spark, sf)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    aggregates = [line for line in plan.splitlines() if "Aggregate" in line]
    assert aggregates and not any(re.search(r"\b(full_text|text)#", line) for line in aggregates)


def test_totals_need_no_ranking(spark, sf):
    plan = _plan(catalog.QUERIES["digest_totals"](spark, sf))
    assert "Window" not in plan and "rangepartitioning" not in plan
