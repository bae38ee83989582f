"""Plan-shape guards: the scale properties checked with ``explain`` stay true."""

import pytest

from sluice.plans import catalog

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    df = catalog.REGISTRY[name][0](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["split_line", "filter_row", "time_expr_column", "render_line_typed",
                                  "rows_to_cells", "filter_day_range", "union_sources"])
def test_stateless_queries_do_not_shuffle(spark, name):
    assert "Exchange" not in plan(spark, name)


def test_day_range_reaches_the_scan(spark):
    p = plan(spark, "filter_day_range")
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p and "LessThan(ts," in p


def test_projection_is_pruned(spark):
    p = plan(spark, "filter_remove_field")
    assert "ReadSchema: struct<p_partkey:bigint,p_brand:string,p_size:int>" in p


def test_top_k_limits_each_task_before_the_shuffle(spark):
    p = plan(spark, "scan_sql_window")
    assert p.count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", ["upsert_replace", "upsert_ignore", "to_bulk_docs", "cells_to_rows"])
def test_dedup_and_pivot_combine_map_side(spark, name):
    p = plan(spark, name)
    assert "partial_" in p            # map-side combine before the shuffle
    assert "Window" not in p          # no per-key window that would gather a hot key
