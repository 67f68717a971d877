"""Header/detail operators on hand fixtures."""

from frames import rows
from partflow.operators import orders


def test_h4_lead_times_text_vs_date_order(spark):
    p = spark.createDataFrame([
        ("1999-01-01T08:00:00", "1999-01-05T12:00:00", "a", "V1"),
        ("2024-01-01T08:00:00", "2024-01-10T12:00:00", "a", "V1"),
        ("2024-01-01T08:00:00", "2099-01-01T12:00:00", "a", None)],
        "dateEntered string, dateFinished string, partNumber string, vendorCode string")
    assert rows(orders.lead_times(p)) == [("a", 4, "99-01-05")]
    assert rows(orders.lead_times(p, order="date")) == [("a", 9, "24-01-10")]


def test_h10_open_sales_split(spark, dict_source):
    lines = spark.createDataFrame(
        [("p1", 5.0, "Open", 1), ("p1", 3.0, "Open", 2), ("p1", 4.0, "Open", 3), ("p1", 9.0, "Closed", 2)],
        "partNumber string, quantityToMake double, status string, orderNumber bigint")
    ords = spark.createDataFrame([(1, "HOUSEDH"), (2, "X"), (3, None)], "orderNumber bigint, customerCode string")
    src = dict_source({"order_line_items": lines, "orders": ords})
    parts = spark.createDataFrame([("p1",), ("p2",)], "partNumber string")
    assert rows(orders.open_sales(src, parts)) == [("p1", 5.0, 7.0), ("p2", None, None)]


def test_h11_open_purchases_fill_then_first(spark, dict_source):
    po = spark.createDataFrame(
        [(1, 1, "p1", 10.0, None, None, "Open"), (1, 2, "p1", 5.0, 2.0, "bolt", "Open")],
        "purchaseOrderNumber bigint, itemNumber int, partNumber string, quantityOrdered double, "
        "quantityReceived double, partDescription string, status string")
    df = spark.createDataFrame([("p1",)], "partNumber string")
    out = orders.open_purchases(dict_source({"purchase_order_line_items": po}), df)
    assert rows(out) == [("p1", 13.0, "0")]


def test_sales_is_filtered_inner_join(spark, dict_source):
    inv = spark.createDataFrame([(1, "2020-01-01T00:00:00", "c1"), (2, "2019-01-01T00:00:00", "c2")],
                                "invoiceNumber bigint, invoiceDate string, customerCode string")
    det = spark.createDataFrame([("p", 1), ("q", 2), ("r", 3)], "partNumber string, invoiceNumber bigint")
    out = orders.sales(dict_source({"ar_invoices": inv, "ar_invoice_details": det}), "2019-06-01",
                       detail_fields="partNumber,invoiceNumber")
    assert rows(out) == [("p", 1, "2020-01-01T00:00:00", "c1")]


def test_flows_return_every_column(spark):
    """Header/detail flows carry the entities' whole column lists; clashes get suffixes."""
    from partflow.schemas import ENTITY_SCHEMAS
    from partflow.sources.staging import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    names = {k: set(v.names) for k, v in ENTITY_SCHEMAS.items()}
    got = orders.purchases(t, "1995-06-30").columns
    assert set(got) == (names["purchase_order_line_items"] - {"purchaseOrderNumber", "status"}) | (names["purchase_orders"] - {"status"}) | {
        "status_x", "status_y"} and len(got) == len(set(got))
    items = orders.order_items(t, "1995-06-30")
    assert set(items.columns) == (names["orders"] | names["order_line_items"]) - {"status", "uniqueID"} | {
        f"{c}_{s}" for c in ("status", "uniqueID") for s in "xy"}
    jobs, materials, lines = orders.jobs(t, "1995-06-30", items)
    clash = {"vendorCode", "description", "workCenter", "burdenRate", "laborRate"}
    assert set(jobs.columns) == names["order_routings"] | {f"{c}_estimate" for c in clash} | {"setupTime", "cycleTime", "lastModDate"}
    assert set(materials.columns) == names["job_materials"] and set(lines.columns) == names["materials"]
    assert set(orders.sales(t, "1995-06-30").columns) == names["ar_invoice_details"] | names["ar_invoices"]
