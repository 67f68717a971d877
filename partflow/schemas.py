"""Declared schemas of the ERP entities (read with ``spark.read.schema(...)``, never inferred).

Inferring types from JSON or CSV makes a digits-only part number an integer
on one run and a string on the next; declared schemas keep keys as text.
"""

from pyspark.sql import types as T

S, D, L, B = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t) for n, t in fields])


def _columns(text: str, numbers: str = "", whole: str = "", flags: str = "") -> T.StructType:
    """Columns by kind, in the order in which the API lists them."""
    kind = {c: t for names, t in ((numbers, D), (whole, L), (flags, B)) for c in names.split()}
    return _struct(*[(c, kind.get(c, S)) for c in text.replace(",", " ").split()])


# The columns of each entity, as the API names them.
ENTITY_SCHEMAS = {
    "ar_invoices": _columns("invoiceNumber, invoiceDate, customerCode", whole="invoiceNumber"),
    "ar_invoice_details": _columns(
        "partNumber, partDescription, quantityShipped, unitPrice, invoiceNumber, jobNumber, discountPercent",
        "quantityShipped unitPrice discountPercent", "invoiceNumber"),
    "purchase_order_line_items": _columns(
        "dateFinished, dueDate, itemNumber, lastModDate, outsideService, partDescription, partNumber, purchaseOrderNumber, "
        "quantityOrdered, quantityReceived, status, unit, unitCost", "quantityOrdered quantityReceived unitCost", "itemNumber purchaseOrderNumber"),
    "purchase_orders": _columns("dateEntered, PONumber, status, vendorCode, vendorDescription", whole="PONumber"),
    "order_line_items": _columns(
        "actualEndDate, actualStartDate, dateFinished, dueDate, estimatedEndDate, estimatedStartDate, itemNumber, jobNotes, jobNumber, "
        "masterJobNumber, orderNumber, partDescription, partNumber, pricingUnit, productCode, quantityCanceled, quantityOrdered, "
        "quantityShippedToCustomer, quantityShippedToStock, quantityToMake, quantityToStock, revision, status, totalActualHours, "
        "totalEstimatedHours, uniqueID, unitPrice, unitPriceForeign, workCode",
        "quantityCanceled quantityOrdered quantityShippedToCustomer quantityShippedToStock quantityToMake quantityToStock "
        "totalActualHours totalEstimatedHours unitPrice unitPriceForeign", "itemNumber orderNumber"),
    "orders": _columns(
        "customerCode, customerDescription, dateEntered, lastModDate, orderNumber, orderTotal, orderTotalForeign, PONumber, salesID, "
        "status, termsCode, territory, uniqueID", "orderTotal orderTotalForeign", "orderNumber"),
    "order_routings": _columns(
        "actualEndDate, actualStartDate, actualPiecesGood, burdenRate, description, employeeCode, estimatedQuantity, jobNumber, laborRate, "
        "operationCode, orderNumber, machinesRun, partNumber, status, stepNumber, timeUnit, totalActualHours, totalEstimatedHours, "
        "vendorCode, workCenter, workCenterOrVendor",
        "actualPiecesGood burdenRate estimatedQuantity laborRate machinesRun totalActualHours totalEstimatedHours", "orderNumber stepNumber"),
    "routings": _columns(
        "partNumber, stepNumber, workCenter, vendorCode, description, setupTime, timeUnit, cycleTime, cycleUnit, burdenRate, laborRate, "
        "lastModDate", "setupTime cycleTime burdenRate laborRate", "stepNumber"),
    "job_materials": _columns(
        "datePosted, description, jobNumber, orderNumber, outsideService, partNumber, postedFromStock, quantityPosted1, stepNumber, "
        "stockingCost, stockUnit", "quantityPosted1 stockingCost", "orderNumber stepNumber"),
    "materials": _columns("partNumber, subPartNumber, description, quantity, unit, unitPrice, unitCost", "quantity unitPrice unitCost"),
    "inventory": _columns("partNumber, partDescription, quantityOnHand", "quantityOnHand"),
    "employees": _columns("employeeCode, employeeName, active, departmentNumber", whole="employeeCode departmentNumber", flags="active"),
}


def fields(entity: str) -> str:
    """The entity's column list, as a request names it."""
    return ",".join(ENTITY_SCHEMAS[entity].names)
