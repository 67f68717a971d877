"""Entity tables derived from the driver's TPC-H-like parquet tables.

Each function maps the base tables to one ERP entity (invoices, order lines,
purchase orders, routings, bills of material, ...). They are ordinary lazy
DataFrames, so projections and filters of later operators are pushed through
them into the parquet scans by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.schemas import ENTITY_SCHEMAS

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


class Tables:
    """Lazy access to ``{sf_dir}/{name}.parquet`` and the staged entities."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def entity(self, name: str) -> DataFrame:
        return ENTITIES[name](self)


def _status(c: str) -> Column:
    return F.when(F.col(c) == "O", "Open").otherwise("Closed")


def _filled(df: DataFrame, entity: str, key: Column) -> DataFrame:
    """``df`` with the entity's other columns, each from a row key by its kind: number, date text or other text (at times null)."""
    k = key.cast("bigint")
    for f in ENTITY_SCHEMAS[entity].fields:
        if f.name in df.columns:
            continue
        if f.dataType.typeName() == "double":
            value = (k % 101).cast("double") / 4
        elif "Date" in f.name:
            value = F.concat(F.lit("2001-0"), (1 + k % 9).cast("string"), F.lit("-1"), (k % 10).cast("string"), F.lit("T00:00:00"))
        else:
            value = F.when(k % 19 != 0, F.concat(F.lit(f.name + "-"), (k % 17).cast("string")))
        df = df.withColumn(f.name, value)
    return df.drop("__k")


def _line_key() -> Column:
    return (F.col("l_orderkey") * 7 + F.col("l_linenumber")).alias("__k")


def _iso(c: str, clock: str) -> Column:
    """Timestamp column -> ISO date-time text, as an ERP API returns it."""
    return F.concat(F.col(c).cast("date").cast("string"), F.lit("T" + clock))


def stg_part(t: Tables) -> DataFrame:
    p = t.base("part")
    kind = (F.when(F.col("p_type") == "SMALL", "BK")
            .when(F.col("p_type") == "PROMO", "15X").otherwise("PN"))
    word = F.split_part(F.col("p_name"), F.lit(" "), F.lit(2))
    category = (F.when(word == "widget", "Mandrels").when(word == "ring", "Inner Race")
                .when(word == "rod", "Compression Tools").when(word == "gear", "Jaw Clutch Center")
                .when(word == "plate", "Adjustable Bent Housings").when(word == "bolt", "None")
                .otherwise(word))
    size = F.when(F.col("p_size") % 11 == 0, F.lit(None).cast("string")) \
        .otherwise((F.col("p_size") % 7).cast("string"))
    return p.select(
        "p_partkey",
        # some numbers and descriptions hold an excluded word
        F.concat(kind, F.col("p_partkey").cast("string"), F.when(F.col("p_partkey") % 41 == 0, "rw").otherwise("")).alias("partNumber"),
        F.when(F.col("p_partkey") % 37 == 0, F.concat("p_name", F.lit(" Bit Ball"))).otherwise(F.col("p_name")).alias("partDescription"),
        category.alias("Category"),
        size.alias("MotorSize"),
    )


def stg_customer(t: Tables) -> DataFrame:
    c = t.base("customer")
    seg = (F.when(F.col("c_mktsegment") == "MACHINERY", "ALPHA ")
           .when(F.col("c_mktsegment") == "BUILDING", "DELTA ")
           .when(F.col("c_mktsegment") == "FURNITURE", "OMEGA ").otherwise(""))
    code = (F.when(F.col("c_custkey") % 50 == 0, "HOUSEDH")
            .when(F.col("c_custkey") % 51 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(seg, F.lit("C"), (F.col("c_custkey") % 120).cast("string"))))
    return c.select("c_custkey", code.alias("customerCode"))


def _orders_with_customer(t: Tables) -> DataFrame:
    return t.base("orders").join(stg_customer(t), F.col("o_custkey") == F.col("c_custkey"))


def _lines_with_part(t: Tables) -> DataFrame:
    return t.base("lineitem").join(stg_part(t), F.col("l_partkey") == F.col("p_partkey"))


def ar_invoices(t: Tables) -> DataFrame:
    date = F.when(F.col("o_orderkey") % 97 == 0, F.lit(None).cast("string")) \
        .otherwise(_iso("o_orderdate", "00:00:00"))
    return _orders_with_customer(t).select(
        F.col("o_orderkey").alias("invoiceNumber"), date.alias("invoiceDate"), "customerCode")


def ar_invoice_details(t: Tables) -> DataFrame:
    amount = F.col("l_quantity").cast("int").cast("string")
    text = (F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("$"), amount))
            .when(F.col("l_linenumber") == 3, F.concat(F.lit("1,"), F.lpad(amount, 3, "0")))
            .when(F.col("l_linenumber") == 5, F.concat(amount, F.lit("%"))).otherwise(amount))
    rows = _lines_with_part(t).select(
        _line_key(), "partNumber", "partDescription",
        F.col("l_quantity").alias("quantityShipped"),
        text.alias("quantityText"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unitPrice"),
        F.col("l_orderkey").alias("invoiceNumber"),
        F.col("l_discount").alias("discountPercent"),
        "Category", "MotorSize")
    return _filled(rows, "ar_invoice_details", F.col("__k"))


def order_line_items(t: Tables) -> DataFrame:
    rows = _lines_with_part(t).select(
        _line_key(), F.col("l_orderkey").alias("orderNumber"), F.col("l_linenumber").alias("itemNumber"),
        "partNumber", "partDescription", F.col("l_quantity").alias("quantityToMake"),
        _status("l_linestatus").alias("status"), _iso("l_shipdate", "00:00:00").alias("dateFinished"))
    return _filled(rows, "order_line_items", F.col("__k"))


def stg_orders(t: Tables) -> DataFrame:
    rows = _orders_with_customer(t).select(
        F.col("o_orderkey").alias("__k"), F.col("o_orderkey").alias("orderNumber"), "customerCode",
        _status("o_orderstatus").alias("status"), F.col("o_totalprice").alias("orderTotal"))
    return _filled(rows, "orders", F.col("__k"))


def purchase_order_line_items(t: Tables) -> DataFrame:
    desc = F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string")).otherwise(F.col("partDescription"))
    received = F.when(F.col("l_returnflag") == "N", F.lit(None).cast("double")) \
        .otherwise(F.floor(F.col("l_quantity") / 2).cast("double"))
    rows = _lines_with_part(t).select(
        _line_key(), F.col("l_orderkey").alias("purchaseOrderNumber"), F.col("l_linenumber").alias("itemNumber"),
        "partNumber", desc.alias("partDescription"), F.col("l_quantity").alias("quantityOrdered"),
        received.alias("quantityReceived"), _status("l_linestatus").alias("status"),
        _iso("l_shipdate", "12:00:00").alias("dateFinished"))
    return _filled(rows, "purchase_order_line_items", F.col("__k"))


def purchase_orders(t: Tables) -> DataFrame:
    vendor = F.when(F.col("o_orderkey") % 13 == 0, F.lit(None).cast("string")) \
        .otherwise(F.concat(F.lit("V"), (F.col("o_orderkey") % 100).cast("string")))
    rows = t.base("orders").select(
        F.col("o_orderkey").alias("__k"), F.col("o_orderkey").alias("PONumber"), _status("o_orderstatus").alias("status"),
        _iso("o_orderdate", "08:00:00").alias("dateEntered"), vendor.alias("vendorCode"))
    return _filled(rows, "purchase_orders", F.col("__k"))


def routings(t: Tables) -> DataFrame:
    pk = F.col("p_partkey")
    steps = stg_part(t).select("p_partkey", "partNumber",
                               F.explode(F.sequence(F.lit(1), F.lit(7))).alias("stepNumber"))
    rows = steps.select(
        (F.col("p_partkey") * 7 + F.col("stepNumber")).alias("__k"), "partNumber", "stepNumber",
        F.concat(F.lit("WC"), ((pk + F.col("stepNumber")) % 5).cast("string")).alias("workCenter"),
        (10 + pk % 50).cast("double").alias("setupTime"),
        F.when(pk % 3 == 0, "M").when(pk % 3 == 1, "S").otherwise("H").alias("timeUnit"),
        (5 + pk % 40).cast("double").alias("cycleTime"),
        F.when(pk % 2 == 0, "M").otherwise("S").alias("cycleUnit"))
    return _filled(rows, "routings", F.col("__k"))


def order_routings(t: Tables) -> DataFrame:
    rows = _lines_with_part(t).select(
        _line_key(), F.col("l_orderkey").alias("orderNumber"), "partNumber",
        F.col("l_linenumber").alias("stepNumber"),
        F.concat(F.lit("WC"), (F.col("l_suppkey") % 5).cast("string")).alias("workCenter"),
        F.col("l_quantity").alias("estimatedQuantity"))
    return _filled(rows, "order_routings", F.col("__k"))


def materials(t: Tables) -> DataFrame:
    """BOM lines: assembly ``partNumber`` -> ``subPartNumber`` with quantity and line order."""
    p = t.base("part")
    pk = F.col("p_partkey")
    lines = [
        p.select(pk.alias("pk"), (3 * pk + 1).alias("ck"), (1 + pk % 3).cast("double").alias("quantity"),
                 F.lit(0).alias("ord")),
        p.select(pk.alias("pk"), (3 * pk + 2).alias("ck"), (1 + pk % 4).cast("double").alias("quantity"),
                 F.lit(1).alias("ord")),
        p.select(pk.alias("pk"), (4 * pk + 7).alias("ck"), F.lit(2.0).alias("quantity"), F.lit(2).alias("ord")),
        p.where(pk % 5 == 0).select(pk.alias("pk"), (3 * pk + 1).alias("ck"), F.lit(9.0).alias("quantity"),
                                   F.lit(3).alias("ord")),
    ]
    e = lines[0].unionByName(lines[1]).unionByName(lines[2]).unionByName(lines[3])
    sp = stg_part(t)
    a = sp.select(F.col("p_partkey").alias("a_key"), F.col("partNumber").alias("a_part"))
    c = sp.select(F.col("p_partkey").alias("c_key"), F.col("partNumber").alias("c_part"),
                  F.col("partDescription").alias("c_desc"))
    rows = (e.join(a, F.col("a_key") == F.col("pk")).join(c, F.col("c_key") == F.col("ck"))
            .select((F.col("pk") * 4 + F.col("ord")).alias("__k"), F.col("a_part").alias("partNumber"), F.col("c_part").alias("subPartNumber"),
                    F.col("c_desc").alias("description"), "quantity", "ord"))
    return _filled(rows, "materials", F.col("__k"))


def job_materials(t: Tables) -> DataFrame:
    rows = _lines_with_part(t).select(
        _line_key(), F.col("l_orderkey").alias("orderNumber"), "partNumber", F.col("l_linenumber").alias("stepNumber"),
        _iso("l_shipdate", "00:00:00").alias("datePosted"), F.col("l_quantity").alias("quantityPosted1"))
    return _filled(rows, "job_materials", F.col("__k"))


def inventory(t: Tables) -> DataFrame:
    on_hand = F.when(F.col("p_partkey") % 10 != 0, (F.col("p_partkey") % 30).cast("double"))     # null: not counted
    return stg_part(t).select("partNumber", "partDescription", on_hand.alias("quantityOnHand"))


def employees(t: Tables) -> DataFrame:
    return t.base("supplier").select(
        F.col("s_suppkey").alias("employeeCode"), F.col("s_name").alias("employeeName"),
        (F.col("s_acctbal") > 0).alias("active"), F.col("s_nationkey").alias("departmentNumber"))


ENTITIES = {
    "stg_part": stg_part,
    "stg_customer": stg_customer,
    "ar_invoices": ar_invoices,
    "ar_invoice_details": ar_invoice_details,
    "order_line_items": order_line_items,
    "stg_orders": stg_orders,
    "orders": stg_orders,
    "purchase_order_line_items": purchase_order_line_items,
    "purchase_orders": purchase_orders,
    "routings": routings,
    "order_routings": order_routings,
    "materials": materials,
    "job_materials": job_materials,
    "inventory": inventory,
    "employees": employees,
}
