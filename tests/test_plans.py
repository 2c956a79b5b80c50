"""Plan-shape checks: the properties the scale notes rely on."""

import re

import pytest

import __spark_entry__ as entry_mod
from fleetreports.plans.explain import physical_plan
from tests.oracle import core

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def plans(spark):
    return {name: physical_plan(entry_mod.queries()[name](spark, SF)) for name in core(entry_mod.queries())}


def read_schema(plan):
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan)


def test_stateless_queries_do_not_shuffle(plans):
    for name in ("active_reports", "north", "render_reports"):
        assert "Exchange" not in plans[name], name


def test_latest_per_unit_limits_before_the_exchange(plans):
    for name in ("trains_last_stop", "top5_delayed", "top5_delayed_current"):
        plan = plans[name]
        partial = plan.index("WindowGroupLimit [id], [lastupdate DESC NULLS LAST, seq DESC NULLS LAST], row_number(), 1, Partial")
        exchange = plan.index("Exchange hashpartitioning(id")
        assert exchange < partial, name  # the partial limit sits below (after, in text) the exchange


def test_global_top_n_is_take_ordered(plans):
    assert "TakeOrderedAndProject(limit=5" in plans["top5_delayed"]


def test_windowed_top_n_limits_on_both_exchanges(plans):
    plan = plans["top5_delayed_window"]
    assert plan.count("Partial") >= 2 and plan.count("Exchange hashpartitioning") == 2
    assert "row_number(), 5, Partial" in plan


def test_average_is_two_phase_and_pruned(plans):
    plan = plans["avg_delay_1m"]
    assert "partial_avg(delay)" in plan and plan.count("Exchange") == 1
    assert read_schema(plan) == ["ts:timestamp_ntz,value:double,props:string"]


def test_gap_shuffles_once_on_small_inputs(plans):
    plan = plans["avg_report_gap"]
    assert plan.count("Exchange") == 1 and "Exchange hashpartitioning(id" in plan
    assert all("event_type" not in s for s in read_schema(plan))


def test_hot_unit_gap_splits(plans):
    plan = plans["avg_report_gap_hot_unit"]
    assert "Union" in plan and "LeftAnti" in plan
    # the hot unit's positions are read back from the materialized, tagged table
    assert any("_tag:bigint" in s and "_part:bigint" in s for s in read_schema(plan))


def test_report_table_scans_push_filters(spark, scratch_dir):
    from fleetreports.plans import queries as q
    from fleetreports.sources import Ingested, event_reports, read_report_table, write_report_tables

    reports = event_reports(spark, "/root/testdata/sf0.001")
    write_report_tables(Ingested(reports, reports.limit(0).selectExpr("'' AS value", "'' AS reason", "seq")),
                        scratch_dir)
    table = read_report_table(spark, scratch_dir)
    trains = physical_plan(q.trains_last_stop(table))
    assert "PushedFilters: [IsNotNull(isinactive), IsNotNull(vtype), EqualTo(isinactive,false), EqualTo(vtype,5)]" \
        in trains
    # only the used columns are read (ingest and day are partition columns, free per file)
    assert "FileScan parquet [id,vtype,linename,laststopid,isinactive,lastupdate,seq,ingest,day]" in trains
    top = physical_plan(q.top_delayed(table))
    assert "GreaterThan(delay,0.0)" in top
