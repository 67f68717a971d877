"""Bucketed entity tables: the sales join runs without an exchange."""

import os

import pytest

from partflow.operators import orders
from partflow.session import scratch_path
from partflow.sources.layout import CatalogEntities, save_bucketed
from partflow.sources.staging import Tables

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_bucketed_sales_join_has_no_exchange(spark):
    t = Tables(spark, SF)
    save_bucketed(t.entity("ar_invoices"), "pf_invoices", ["invoiceNumber"], 8, scratch_path(spark, "inv"))
    save_bucketed(t.entity("ar_invoice_details"), "pf_details", ["invoiceNumber"], 8, scratch_path(spark, "det"))
    src = CatalogEntities(spark, {"ar_invoices": "pf_invoices", "ar_invoice_details": "pf_details"})
    prev = (spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        co = orders.sales(src, "1995-06-30", null_safe_keys=False)
        plan = co._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        shuffled = orders.sales(src, "1995-06-30")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" in shuffled   # null-safe keys re-partition on (coalesce(k), isnull(k))
        assert co.count() == orders.sales(t, "1995-06-30").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev[0])
        spark.conf.set("spark.sql.adaptive.enabled", prev[1])
