"""Plan shapes: the properties the design relies on, read from .explain()."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from rentlens.plans import registry
from tests.conftest import SF_SMALL

QUERIES = {name: E.queries()[name] for name in registry.queries()}
# Queries over parsed cards: the pages are parsed once, into a written table.
PARSED = {"accumulate", "carry_forward", "html_cards", "html_rejects", "page_agents", "page_cutoff", "union_sources"}
# Writers, streams and the exact preview run jobs when they are called.
EAGER = PARSED | {"append_with_id", "append_rerun", "ingest_run", "level_cross_join", "row_limit", "table_roundtrip",
                  "upsert_buckets", "upsert_versions"}


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_or_nested_loop(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in EAGER and not n.startswith("stream_")))
def test_building_a_query_starts_no_job_but_schema_reads(spark, name):
    QUERIES[name](spark, SF_SMALL)  # the captured inputs exist from here on
    sc = spark.sparkContext
    sc.setJobGroup(f"build-{name}", name)
    try:
        QUERIES[name](spark, SF_SMALL)
    finally:
        sc.setJobGroup("", "")
    tracker = sc.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(f"build-{name}")]
    stages = [tracker.getStageInfo(s) for j in jobs if j for s in j.stageIds]
    assert all(s.name.startswith("parquet at") for s in stages if s)


def test_flagship_scan_is_pruned_and_pushed(spark):
    p = plan(QUERIES["price_by_beds_selected"](spark, SF_SMALL))
    assert "PartitionFilters: [((area" in p
    assert "GreaterThanOrEqual(price,300)" in p and "LessThanOrEqual(price,50000)" in p
    assert "ReadSchema: struct<price:int,n_beds:double>" in p
    assert "partial_avg(price" in p  # map-side combine before the shuffle


def test_upsert_latest_is_partial_aggregate(spark):
    p = plan(QUERIES["upsert_by_key"](spark, SF_SMALL))
    assert "partial_max_by" in p


def test_selection_and_cutoff_are_broadcast(spark):
    for name in ("listing_detail", "exclude_null_months", "html_cards"):
        assert "BroadcastHashJoin" in plan(QUERIES[name](spark, SF_SMALL)), name


def test_mom_window_runs_on_monthly_aggregate(spark):
    p = plan(QUERIES["price_change_mom"](spark, SF_SMALL), "simple")
    window_at = p.index("Window [")
    agg_at = p.index("HashAggregate(keys=[area")
    assert window_at < agg_at  # the window sits above (after) the aggregate in the tree


@pytest.mark.parametrize("name", sorted(PARSED | {"ingest_run"}))
def test_pages_are_parsed_once(spark, name, monkeypatch):
    from rentlens.sources import html_pages

    parses, extract = [], html_pages.extract_cards
    monkeypatch.setattr(html_pages, "extract_cards", lambda pages: parses.append(1) or extract(pages))
    df = QUERIES[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    assert parses == [1] and "MapInArrow" not in plan(df)


def test_overview_has_one_scan_and_one_partial_aggregate(spark):
    p = plan(QUERIES["dashboard_overview"](spark, SF_SMALL), "simple")
    assert p.count("FileScan") == 1 and p.count("Exchange") == 1 and "Expand" in p
    p = plan(QUERIES["dashboard_overview_areas"](spark, SF_SMALL))
    assert "PartitionFilters: [area" in p or "PartitionFilters: [((area" in p
    assert "location:string" not in p and "amenities:string" not in p  # columns of the sheets asked for only
