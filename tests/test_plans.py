"""Plan shape: no Python UDFs and no nested-loop joins in the registered queries."""

import pytest

from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", ["top_parts", "sales", "customer_ratio", "open_sales", "lead_times",
                                 "tfidf", "top_terms_per_cluster", "with_margins", "jobs",
                                 "material_requirements", "mandrel_ratio"])
def test_plan_is_jvm_only(spark, key):
    plan = queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_scan_prunes_columns(spark):
    plan = queries()["entity_scan"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "l_discount" not in plan


def test_one_row_stats_are_the_only_nested_loop(spark):
    """histogram attaches its one-row min/max aggregate by broadcast; nothing else is nested-loop."""
    plan = queries()["histogram"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    for line in plan.splitlines():
        if "BroadcastNestedLoopJoin" in line:
            assert "BuildRight" in line


def test_lookup_is_left_semi(spark):
    plan = queries()["lookup_in"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan


def test_customer_ratio_reads_sales_once(spark):
    """Per-customer sums are written once; the substring pairs come from an equi-join."""
    plan = queries()["customer_ratio"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") <= 1 and "BroadcastNestedLoopJoin" not in plan


def test_jobs_has_no_full_outer_join(spark):
    """A full outer join can neither be split on a hot key nor sent to all."""
    plan = queries()["jobs"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan and "LeftAnti" in plan and "LeftOuter" in plan


def test_size_sheets_read_the_sales_once(spark, monkeypatch):
    """Both sheets come from one demand table: sales and open lines are read for it, not once a sheet."""
    from partflow.operators import orders

    read = []
    for name in ("sales", "open_sales"):
        plain = getattr(orders, name)
        monkeypatch.setattr(orders, name, lambda *a, _plain=plain, _name=name, **k: read.append(_name) or _plain(*a, **k))
    out = queries()["write_size_sheets"](spark, SF)
    assert sorted(read) == ["open_sales", "sales"]
    assert {r.sheet for r in out.select("sheet").distinct().collect()} == {"sizes", "Materials"}
