"""The staged entities as plain SQL, for independent checks in another engine.

Each entry is the body of one CTE; :func:`with_views` prepends the ones a
query needs (with their dependencies) to a final SELECT.
"""

from __future__ import annotations

STAGING_SQL: dict[str, str] = {
    "stg_part": """SELECT p_partkey,
  concat(CASE p_type WHEN 'SMALL' THEN 'BK' WHEN 'PROMO' THEN '15X' ELSE 'PN' END, CAST(p_partkey AS STRING), CASE WHEN p_partkey % 41 = 0 THEN 'rw' ELSE '' END) AS partNumber,
  CASE WHEN p_partkey % 37 = 0 THEN concat(p_name, ' Bit Ball') ELSE p_name END AS partDescription,
  CASE split_part(p_name,' ',2) WHEN 'widget' THEN 'Mandrels' WHEN 'ring' THEN 'Inner Race' WHEN 'rod' THEN 'Compression Tools'
    WHEN 'gear' THEN 'Jaw Clutch Center' WHEN 'plate' THEN 'Adjustable Bent Housings' WHEN 'bolt' THEN 'None' ELSE split_part(p_name,' ',2) END AS Category,
  CASE WHEN p_size % 11 = 0 THEN NULL ELSE CAST(p_size % 7 AS STRING) END AS MotorSize
FROM part""",
    "stg_customer": """SELECT c_custkey, CASE WHEN c_custkey % 50 = 0 THEN 'HOUSEDH' WHEN c_custkey % 51 = 0 THEN NULL
  ELSE concat(CASE c_mktsegment WHEN 'MACHINERY' THEN 'ALPHA ' WHEN 'BUILDING' THEN 'DELTA ' WHEN 'FURNITURE' THEN 'OMEGA ' ELSE '' END, 'C', CAST(c_custkey % 120 AS STRING)) END AS customerCode
FROM customer""",
    "ar_invoices": """SELECT o_orderkey AS invoiceNumber,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE concat(CAST(CAST(o_orderdate AS DATE) AS STRING),'T00:00:00') END AS invoiceDate, customerCode
FROM orders JOIN stg_customer ON o_custkey = c_custkey""",
    "ar_invoice_details": """SELECT partNumber, partDescription, l_quantity AS quantityShipped,
  CASE WHEN l_linenumber % 2 = 0 THEN concat('$', CAST(CAST(l_quantity AS INT) AS STRING)) WHEN l_linenumber = 3 THEN concat('1,', lpad(CAST(CAST(l_quantity AS INT) AS STRING), 3, '0'))
    WHEN l_linenumber = 5 THEN concat(CAST(CAST(l_quantity AS INT) AS STRING), '%') ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS quantityText,
  l_extendedprice / l_quantity AS unitPrice, l_orderkey AS invoiceNumber, l_discount AS discountPercent, Category, MotorSize
FROM lineitem JOIN stg_part ON l_partkey = p_partkey""",
    "order_line_items": """SELECT l_orderkey AS orderNumber, l_linenumber AS itemNumber, partNumber, partDescription, l_quantity AS quantityToMake,
  CASE l_linestatus WHEN 'O' THEN 'Open' ELSE 'Closed' END AS status, concat(CAST(CAST(l_shipdate AS DATE) AS STRING),'T00:00:00') AS dateFinished
FROM lineitem JOIN stg_part ON l_partkey = p_partkey""",
    "stg_orders": """SELECT o_orderkey AS orderNumber, customerCode, CASE o_orderstatus WHEN 'O' THEN 'Open' ELSE 'Closed' END AS status, o_totalprice AS orderTotal
FROM orders JOIN stg_customer ON o_custkey = c_custkey""",
    "purchase_order_line_items": """SELECT l_orderkey AS purchaseOrderNumber, l_linenumber AS itemNumber, partNumber,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE partDescription END AS partDescription, l_quantity AS quantityOrdered,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(floor(l_quantity / 2) AS DOUBLE) END AS quantityReceived,
  CASE l_linestatus WHEN 'O' THEN 'Open' ELSE 'Closed' END AS status, concat(CAST(CAST(l_shipdate AS DATE) AS STRING),'T12:00:00') AS dateFinished
FROM lineitem JOIN stg_part ON l_partkey = p_partkey""",
    "purchase_orders": """SELECT o_orderkey AS PONumber, CASE o_orderstatus WHEN 'O' THEN 'Open' ELSE 'Closed' END AS status,
  concat(CAST(CAST(o_orderdate AS DATE) AS STRING),'T08:00:00') AS dateEntered, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE concat('V', CAST(o_orderkey % 100 AS STRING)) END AS vendorCode
FROM orders""",
    "routings": """SELECT partNumber, s.id AS stepNumber, concat('WC', CAST((p_partkey + s.id) % 5 AS STRING)) AS workCenter,
  CAST(10 + p_partkey % 50 AS DOUBLE) AS setupTime, CASE p_partkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'S' ELSE 'H' END AS timeUnit,
  CAST(5 + p_partkey % 40 AS DOUBLE) AS cycleTime, CASE p_partkey % 2 WHEN 0 THEN 'M' ELSE 'S' END AS cycleUnit
FROM stg_part CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5, 6, 7]) AS id) s""",
    "order_routings": """SELECT l_orderkey AS orderNumber, partNumber, l_linenumber AS stepNumber, concat('WC', CAST(l_suppkey % 5 AS STRING)) AS workCenter, l_quantity AS estimatedQuantity
FROM lineitem JOIN stg_part ON l_partkey = p_partkey""",
    "materials": """SELECT a.partNumber AS partNumber, c.partNumber AS subPartNumber, c.partDescription AS description, e.quantity AS quantity, e.ord AS ord FROM (
  SELECT p_partkey AS pk, 3*p_partkey+1 AS ck, CAST(1 + p_partkey % 3 AS DOUBLE) AS quantity, 0 AS ord FROM part
  UNION ALL SELECT p_partkey, 3*p_partkey+2, CAST(1 + p_partkey % 4 AS DOUBLE), 1 FROM part
  UNION ALL SELECT p_partkey, 4*p_partkey+7, CAST(2 AS DOUBLE), 2 FROM part
  UNION ALL SELECT p_partkey, 3*p_partkey+1, CAST(9 AS DOUBLE), 3 FROM part WHERE p_partkey % 5 = 0) e
JOIN stg_part a ON a.p_partkey = e.pk JOIN stg_part c ON c.p_partkey = e.ck""",
    "job_materials": """SELECT l_orderkey AS orderNumber, partNumber, l_linenumber AS stepNumber, concat(CAST(CAST(l_shipdate AS DATE) AS STRING),'T00:00:00') AS datePosted, l_quantity AS quantityPosted1
FROM lineitem JOIN stg_part ON l_partkey = p_partkey""",
    "inventory": """SELECT partNumber, partDescription, CASE WHEN p_partkey % 10 <> 0 THEN CAST(p_partkey % 30 AS DOUBLE) END AS quantityOnHand FROM stg_part""",
    "employees": """SELECT s_suppkey AS employeeCode, s_name AS employeeName, s_acctbal > 0 AS active, s_nationkey AS departmentNumber FROM supplier""",
}

# The columns that the tests' base tables have nothing for: n a number, d a date, s other text; each from the row key.
_LINE, _ORDER = "l_orderkey * 7 + l_linenumber", "o_orderkey"
_FILL = {
    "ar_invoice_details": (_LINE, "jobNumber:s"),
    "purchase_order_line_items": (_LINE, "dueDate:d lastModDate:d outsideService:s unit:s unitCost:n"),
    "purchase_orders": (_ORDER, "vendorDescription:s"),
    "order_line_items": (_LINE, "actualEndDate:d actualStartDate:d dueDate:d estimatedEndDate:d estimatedStartDate:d jobNotes:s jobNumber:s "
                         "masterJobNumber:s pricingUnit:s productCode:s quantityCanceled:n quantityOrdered:n quantityShippedToCustomer:n "
                         "quantityShippedToStock:n quantityToStock:n revision:s totalActualHours:n totalEstimatedHours:n uniqueID:s "
                         "unitPrice:n unitPriceForeign:n workCode:s"),
    "stg_orders": (_ORDER, "customerDescription:s dateEntered:s lastModDate:d orderTotalForeign:n PONumber:s salesID:s termsCode:s "
                   "territory:s uniqueID:s"),
    "order_routings": (_LINE, "actualEndDate:d actualStartDate:d actualPiecesGood:n burdenRate:n description:s employeeCode:s jobNumber:s "
                       "laborRate:n operationCode:s machinesRun:n status:s timeUnit:s totalActualHours:n totalEstimatedHours:n vendorCode:s "
                       "workCenterOrVendor:s"),
    "routings": ("p_partkey * 7 + s.id", "vendorCode:s description:s burdenRate:n laborRate:n lastModDate:d"),
    "job_materials": (_LINE, "description:s jobNumber:s outsideService:s postedFromStock:s stockingCost:n stockUnit:s"),
    "materials": ("e.pk * 4 + e.ord", "unit:s unitPrice:n unitCost:n"),
}
_KIND = {"n": "CAST(({k}) % 101 AS DOUBLE) / 4",
         "d": "concat('2001-0', CAST(1 + ({k}) % 9 AS STRING), '-1', CAST(({k}) % 10 AS STRING), 'T00:00:00')",
         "s": "CASE WHEN ({k}) % 19 <> 0 THEN concat('{c}-', CAST(({k}) % 17 AS STRING)) END"}
for _view, (_key, _cols) in _FILL.items():
    _more = ", ".join(_KIND[kind].format(k=_key, c=c) + f" AS {c}" for c, kind in (x.split(":") for x in _cols.split()))
    _head, _from, _rest = STAGING_SQL[_view].partition(" FROM (" if _view == "materials" else "\nFROM ")
    assert _from, _view
    STAGING_SQL[_view] = f"{_head}, {_more}{_from}{_rest}"

_DEPENDS = {
    "ar_invoices": ["stg_customer"],
    "stg_orders": ["stg_customer"],
    "ar_invoice_details": ["stg_part"],
    "order_line_items": ["stg_part"],
    "purchase_order_line_items": ["stg_part"],
    "routings": ["stg_part"],
    "order_routings": ["stg_part"],
    "materials": ["stg_part"],
    "job_materials": ["stg_part"],
    "inventory": ["stg_part"],
}


def with_views(views: list[str], ctes: list[tuple[str, str]], final: str, recursive: bool = False) -> str:
    """``WITH <staging views + dependencies>, <ctes> <final>``."""
    order: list[str] = []

    def add(v: str) -> None:
        for d in _DEPENDS.get(v, []):
            add(d)
        if v not in order:
            order.append(v)

    for v in views:
        add(v)
    parts = [f"{v} AS ({STAGING_SQL[v]})" for v in order] + [f"{n} AS ({b})" for n, b in ctes]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return (head + ",\n".join(parts) + "\n" if parts else "") + final
