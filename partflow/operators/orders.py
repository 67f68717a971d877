"""Header/detail joins: sales, purchases, order items, jobs, open quantities, lead times."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.functions.patterns import HOUSE_ACCOUNT
from partflow.functions.scalar import iso_date, lead_days, to_hours, year_before
from partflow.functions.semantics import first_non_null, merge, not_equal_keep_null, row_order
from partflow.schemas import fields
from partflow.sources.entity import after_time, lookup_in, read_entity

# Column lists that the flows request by default.
INVOICE_FIELDS = fields("ar_invoices")
INVOICE_DETAIL_FIELDS = fields("ar_invoice_details")
PO_LINE_FIELDS = fields("purchase_order_line_items")
PO_FIELDS = fields("purchase_orders")
ORDER_LINE_FIELDS = fields("order_line_items")
ORDER_FIELDS = fields("orders")
ORDER_ROUTING_FIELDS = fields("order_routings")
ROUTING_FIELDS = fields("routings")
JOB_MATERIAL_FIELDS = fields("job_materials")
MATERIAL_FIELDS = fields("materials")


def sales(source, start_date: str, detail_fields: str = INVOICE_DETAIL_FIELDS,
          null_safe_keys: bool = True) -> DataFrame:
    """Invoice lines of invoices dated after ``start_date`` with invoiceDate and customerCode.

    The reference looks up details by the invoice numbers and left-merges the
    invoices back; with the lookup that is exactly an inner (null-safe) join,
    so Spark does one join instead of a semi join plus a join. With
    ``null_safe_keys=False`` (invoice numbers never null) the join keeps a
    bucketed layout of both entities co-located.
    """
    inv = read_entity(source, "ar_invoices", INVOICE_FIELDS).where(after_time("invoiceDate", start_date))
    det = read_entity(source, "ar_invoice_details", detail_fields)
    return merge(det, inv, "invoiceNumber", "inner", null_safe=null_safe_keys)


def purchases(source, start_date: str, line_fields: str = PO_LINE_FIELDS, head_fields: str = PO_FIELDS) -> DataFrame:
    """PO lines finished after ``start_date`` left-joined to their PO headers (status_x/_y)."""
    lines = (read_entity(source, "purchase_order_line_items", line_fields)
             .where(after_time("dateFinished", start_date))
             .withColumnRenamed("purchaseOrderNumber", "PONumber"))
    heads = read_entity(source, "purchase_orders", head_fields)
    return merge(lines, heads, "PONumber", "left")


def order_items(source, start_date: str, order_fields: str = ORDER_FIELDS, line_fields: str = ORDER_LINE_FIELDS) -> DataFrame:
    """Orders having a line finished after ``start_date``, joined to those lines.

    Reference: orders looked up by the lines' order numbers, then
    ``orders.merge(lines, how='left')``; every looked-up order has a line, so
    this is an inner join with the order columns first (status_x = order).
    """
    lines = read_entity(source, "order_line_items", line_fields).where(after_time("dateFinished", start_date))
    orders = read_entity(source, "orders", order_fields)
    return merge(orders, lines, "orderNumber", "inner")


def estimate_routings(source, routing_fields: str = ROUTING_FIELDS) -> DataFrame:
    """Routings with setup and cycle time in hours (units dropped)."""
    r = read_entity(source, "routings", routing_fields).withColumnRenamed("timeUnit", "setupUnit")
    return (r.withColumn("setupTime", to_hours(F.col("setupTime"), F.col("setupUnit")))
             .withColumn("cycleTime", to_hours(F.col("cycleTime"), F.col("cycleUnit")))
             .drop("setupUnit", "cycleUnit"))


def jobs(source, start_date: str, order_items_df: DataFrame, route_fields: str = ORDER_ROUTING_FIELDS,
         routing_fields: str = ROUTING_FIELDS, material_fields: str = MATERIAL_FIELDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(jobs, job_materials, estimate_materials).

    jobs = order routings of the given orders, full-outer-joined to estimated
    routings on (partNumber, stepNumber); right-side clashes get ``_estimate``.
    """
    posted_after = year_before(start_date)
    job_mat = read_entity(source, "job_materials", JOB_MATERIAL_FIELDS).where(after_time("datePosted", posted_after))
    routes = lookup_in(read_entity(source, "order_routings", route_fields), "orderNumber",
                       order_items_df.select("orderNumber"), hashed=True)
    est_mat = read_entity(source, "materials", material_fields)
    est, keys = estimate_routings(source, routing_fields), ["partNumber", "stepNumber"]
    # all routings with their estimates, then the estimates without a routing: unlike a full outer
    # join, both can split a hot key. The estimates of a partition (a row per part and step) and the keys go to hash tables:
    # the wide routings are neither sorted nor spilled
    joined = merge(routes, est.hint("shuffle_hash"), keys, "left", suffixes=("", "_estimate"))
    own = routes.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct().hint("shuffle_hash")
    only = est.join(own, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]), "left_anti")
    clash = set(routes.columns) & set(est.columns) - set(keys)
    only = only.select(*[F.col(c).alias(c + "_estimate") if c in clash else F.col(c) for c in only.columns])
    return joined.unionByName(only, allowMissingColumns=True), job_mat, est_mat


def _conditional_sum(pred: Column, value: str) -> Column:
    """Sum over rows matching ``pred``; null when no row matches, 0 when all values are null."""
    return F.when(F.count(F.when(pred, 1)) > 0,
                  F.coalesce(F.sum(F.when(pred, F.col(value))), F.lit(0.0)))


def open_sales(source, parts: DataFrame, house_account: str = HOUSE_ACCOUNT) -> DataFrame:
    """Add open in-house (``quantityToMake``) and customer (``openCustomerOrders``) quantities.

    One aggregation computes both sums; parts without open lines get nulls.
    The reference first looks up the lines of the given parts; here the final
    left join does that restriction, so ``parts`` is evaluated only once.
    """
    lines = read_entity(source, "order_line_items", "partNumber,quantityToMake,status,orderNumber",
                        filter_string="status=Open")
    orders = read_entity(source, "orders", "orderNumber,customerCode")
    lines = merge(lines, orders, "orderNumber", "left")
    house = F.col("customerCode") == house_account
    sums = (lines.where(F.col("partNumber").isNotNull()).groupBy("partNumber")
            .agg(_conditional_sum(house, "quantityToMake").alias("quantityToMake"),
                 _conditional_sum(not_equal_keep_null(F.col("customerCode"), house_account),
                                  "quantityToMake").alias("openCustomerOrders")))
    return merge(parts, sums, "partNumber", "left")


def open_purchases(source, df: DataFrame,
                   order_by: tuple[str, ...] = ("purchaseOrderNumber", "itemNumber", "quantityOrdered")
                   ) -> DataFrame:
    """Open PO quantity (ordered - received, nulls as 0) and first description per part, left-joined.

    A ``partDescription`` already on ``df`` yields ``partDescription_x/_y``.
    """
    fields = ",".join(dict.fromkeys(["partNumber", "quantityOrdered", "quantityReceived", "partDescription",
                                     *order_by]))
    po = read_entity(source, "purchase_order_line_items", fields + ",status", filter_string="status=Open")
    po = po.select(
        "partNumber",
        (F.coalesce(F.col("quantityOrdered"), F.lit(0.0)) - F.coalesce(F.col("quantityReceived"), F.lit(0.0)))
        .alias("quantityOrdered"),
        F.coalesce(F.col("partDescription"), F.lit("0")).alias("partDescription"),
        row_order(*order_by).alias("__ord"))
    per_part = (po.where(F.col("partNumber").isNotNull()).groupBy("partNumber")
                .agg(F.sum("quantityOrdered").alias("quantityOrdered"),
                     first_non_null("partDescription", F.col("__ord")).alias("partDescription")))
    return merge(df, per_part, "partNumber", "left")


def lead_times(purchases_df: DataFrame, order: str = "text") -> DataFrame:
    """Most recent receipt per part: partNumber, leadTime (days), lastDateReceived ('yy-MM-dd').

    ``order='text'`` ranks by the two-digit-year text as the reference does
    (1999 sorts after 2024); ``order='date'`` ranks by the real date. Ties
    go to the longer lead time. An aggregation (``max_by``) instead of a
    window keeps a hot part from landing in one task: it combines map-side.
    """
    p = purchases_df.select("dateEntered", "dateFinished", "partNumber", "vendorCode").dropna()
    finished = iso_date(F.col("dateFinished"))
    p = p.select("partNumber",
                 lead_days(finished, iso_date(F.col("dateEntered"))).alias("leadTime"),
                 finished.alias("__finished"))
    # date and lead time in one number, so that a plain max is the aggregate: it hashes, where a text or
    # struct buffer would sort all rows
    d = F.col("__finished")
    rank = ((F.year(d) % 100) if order == "text" else F.year(d)) * 10_000 + F.month(d) * 100 + F.day(d)
    packed = rank.cast("bigint") * F.lit(1 << 24) + (F.col("leadTime") + F.lit(1 << 23))
    best = p.groupBy("partNumber").agg(F.max(packed).alias("__b"))
    lead = F.col("__b") % F.lit(1 << 24) - F.lit(1 << 23)
    rank = F.shiftright("__b", 24)
    text = F.format_string("%02d-%02d-%02d", F.floor(rank / 10_000) % 100, F.floor(rank / 100) % 100, rank % 100)
    return best.select("partNumber", lead.alias("leadTime"), text.alias("lastDateReceived"))
