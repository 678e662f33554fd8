"""Plan shape: no cross joins, no Python in the plan, pushdown and pruning reach the scan."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from martforge.plans.catalog import QUERIES

from .conftest import SMALL_SF

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_or_python(spark, name):
    text = plan(E.queries()[name](spark, SMALL_SF))
    for word in FORBIDDEN:
        assert word not in text, f"{name}: {word}"


def test_due_orders_filter_reaches_scan(spark):
    text = plan(E.queries()["ind_due_orders"](spark, SMALL_SF))
    pushed = [line for line in text.splitlines() if "PushedFilters" in line]
    assert any("o_orderdate" in line and "o_totalprice" in line for line in pushed), pushed


def test_incremental_filter_reaches_scan(spark):
    text = plan(E.queries()["incremental_by_modified"](spark, SMALL_SF))
    assert any("PushedFilters" in line and "Or(GreaterThanOrEqual(ts" in line for line in text.splitlines())


def test_top3_is_a_window_group_limit(spark):
    assert "WindowGroupLimit" in plan(E.queries()["ind_top3_by_lead_time"](spark, SMALL_SF))


def test_latest_per_key_combines_map_side(spark):
    text = plan(E.queries()["latest_per_key"](spark, SMALL_SF))
    assert "partial_max" in text
    assert "Window" not in text


def test_time_mart_reads_only_needed_columns(spark):
    text = plan(E.queries()["mart_tempo"](spark, SMALL_SF))
    schemas = [line for line in text.splitlines() if "ReadSchema" in line]
    assert "struct<l_orderkey:bigint,l_partkey:bigint,l_shipdate:timestamp_ntz>" in "".join(schemas), schemas
    assert "struct<p_partkey:bigint>" in "".join(schemas), schemas


def test_indicator_pre_aggregates_before_join(spark):
    text = plan(E.queries()["ind_qty_by_order_date"](spark, SMALL_SF))
    # the per-order sum is planned below the join
    assert text.index("partial_sum") > text.index("Join")  # formatted plans list the tree top-down
