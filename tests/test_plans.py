"""Physical plans: what is pushed down, pruned, broadcast and shuffled."""

from __future__ import annotations

import re

import pytest

from sluice.operators import scan
from sluice.operators.rollup import keyed, rollup, rollup_all
from sluice.plans import dashboard, ledger, registry
from sluice.sinks import store
from sluice.sources.tables import kpi_events

#: Queries that read a running total, the only one of these plans that needs Python.
IN_ORDER = {"statement", "account_statement", "creation_statement"}
QUERIES = registry.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_joins_and_no_row_at_a_time_python(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert "SortAggregate" not in text and "MapInArrow" not in text and "FlatMapGroups" not in text


@pytest.mark.parametrize("name", ["kpi_rows", "latest_store", "postings", "balances"])
def test_served_queries_make_nothing_again(spark, small, name):
    """The second time nothing is written: the stored rollups and verdicts are there."""
    QUERIES[name](spark, small)
    before = {*dashboard._stores.values(), *ledger._ledgers.values()}
    QUERIES[name](spark, small)
    assert {*dashboard._stores.values(), *ledger._ledgers.values()} == before
    assert "account" not in str(QUERIES["postings"](spark, small).inputFiles())


def test_single_rollup_is_one_shuffle(spark, small):
    text = plan(rollup(kpi_events(spark, small), "STATE", "PT10M"))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text)
    assert schema is None or "event_type" not in schema.group(1)


def test_all_rollups_read_the_events_once(spark, small):
    text = plan(rollup_all(kpi_events(spark, small)))
    assert text.count("FileScan parquet") == 1
    assert text.count("Exchange hashpartitioning") == 2


SERVED = ("prefix_scan", "range_scan", "scan_day", "scan_month", "latest_store", "latest_state", "latest_region", "page_after",
          "kpi_rows", "dashboard_totals", "chart_series", "kpi_day_month", "kpi_day_month_compat")


@pytest.mark.parametrize("name", SERVED)
def test_served_queries_read_the_store_once_and_no_raw_event(spark, small, name):
    df = QUERIES[name](spark, small)
    files = df.inputFiles()
    assert files and not [f for f in files if "events.parquet" in f]
    # The totals read the counts as well, to join and to prune.
    assert plan(df).count("FileScan parquet") <= (3 if name == "dashboard_totals" else 1)
    of_day = {f.split("event_date=")[1][:10] for f in files if "/rollups/" in f}
    if name in ("prefix_scan", "latest_state", "latest_region", "kpi_rows"):
        assert of_day == {"2024-01-15"}
    if name in ("range_scan", "scan_day", "scan_month"):
        assert not of_day
    if name == "range_scan":
        assert {f.split("day=")[1][:10] for f in files} == {"2024-01-10", "2024-01-11", "2024-01-12"}


def test_totals_cut_before_the_shuffle(spark, small):
    assert "WindowGroupLimit" in plan(QUERIES["dashboard_totals"](spark, small))


def test_newest_rows_are_a_top_k(spark, small):
    for name in ("latest_store", "latest_state", "latest_region", "chart_series", "page_after"):
        assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, small))


def test_day_reaches_the_parquet_reader(spark, small):
    pushed = re.search(r"PushedFilters: \[([^\]]*)", plan(rollup(kpi_events(spark, small, "2024-01-15"), "STATE", "PT1H"))).group(1)
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


def test_filter_sets_are_pushed_down(spark, small):
    text = QUERIES["filter_sets"](spark, small)._jdf.queryExecution().executedPlan()
    pushed = text.collectLeaves().head().metadata().apply("PushedFilters")
    for part in ("In(o_orderstatus", "In(o_orderpriority", "GreaterThan(o_orderdate", "LessThan(o_orderdate"):
        assert part in pushed


def test_store_reads_prune_partitions(spark, small, tmp_path):
    path = str(tmp_path / "store")
    store.write_store(keyed(rollup_all(kpi_events(spark, small), ["STATE", "REGION"], ["PT1H", "PT10M"])), path)
    rows = scan.by_period(scan.by_key(store.read_store(spark, path), "NORTHEAST", "BA"), "PT1H", "2024-01-15")
    leaf = rows._jdf.queryExecution().executedPlan().collectLeaves().head()
    pruned = leaf.metadata().apply("PartitionFilters")
    assert all(c in pruned for c in ("grain", "period", "event_date"))
    assert "EqualTo(state,BA)" in leaf.metadata().apply("PushedFilters")
    assert rows.count() == QUERIES["prefix_scan"](spark, small).count()
    few = scan.keys_only(store.read_store(spark, path))
    assert "kpi1" not in few._jdf.queryExecution().executedPlan().collectLeaves().head().metadata().apply("ReadSchema")
