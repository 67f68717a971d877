"""Independent SQL for every registered query (DuckDB dialect, base tables as views)."""

from __future__ import annotations

from partflow.plans.catalog import CLUSTERS, PARAMS
from partflow.plans.oracle_staging import with_views

ORACLE: dict[str, str] = {}

# Fixed values, written out here again: a wrong list in the library must not agree with itself.
DESCRIPTION_EXCLUDE = "scrap|return|inspection|labor|freight|black|replace|maintenance|reweld|re-weld|bit ball|screw|bit|balls|set"
PART_EXCLUDE = "scrap|return|inspection|labor|freight|black|replace|balls|bit ball|set|screw|rw|skim"

_SALES = ("sales", f"""SELECT d.*, i.invoiceDate, i.customerCode
  FROM ar_invoice_details d JOIN ar_invoices i ON d.invoiceNumber IS NOT DISTINCT FROM i.invoiceNumber
  WHERE CAST(i.invoiceDate AS TIMESTAMP) > TIMESTAMP '{PARAMS['sales_start']} 00:00:00'""")

_CLEAN = ("clean", f"""SELECT partNumber, partDescription, jobNumber, coalesce(quantityShipped, 0) AS quantityShipped,
  coalesce(CAST(regexp_replace(quantityText, '[$,%]', '', 'g') AS DOUBLE), 0) AS quantityText,
  coalesce(unitPrice, 0) AS unitPrice, coalesce(invoiceNumber, 0) AS invoiceNumber,
  coalesce(discountPercent, 0) AS discountPercent, Category, MotorSize,
  TRY_CAST(split_part(invoiceDate, 'T', 1) AS DATE) AS invoiceDate, customerCode
  FROM sales
  WHERE invoiceDate IS NOT NULL AND partNumber IS NOT NULL AND partDescription IS NOT NULL
    AND NOT coalesce(contains(customerCode, 'HOUSE'), false)
    AND NOT regexp_matches(partDescription, '{DESCRIPTION_EXCLUDE}', 'i')
    AND NOT regexp_matches(partNumber, '{PART_EXCLUDE}', 'i')""")

_SALES_VIEWS = ["ar_invoices", "ar_invoice_details"]

ORACLE["sales"] = with_views(_SALES_VIEWS, [_SALES], "SELECT * FROM sales")
ORACLE["clean_sales"] = with_views(_SALES_VIEWS, [_SALES, _CLEAN], "SELECT * FROM clean")
ORACLE["top_parts"] = with_views(_SALES_VIEWS, [_SALES, _CLEAN], f"""
SELECT partNumber, coalesce(sum(quantityText), 0) AS quantityText FROM clean WHERE partNumber IS NOT NULL
GROUP BY partNumber ORDER BY quantityText DESC, partNumber LIMIT {PARAMS['top_n']}""")

_ORD = "(invoiceNumber, partNumber, quantityText, unitPrice, discountPercent)"
_FIRST = ", ".join(f"arg_min({c}, {_ORD}) FILTER (WHERE {c} IS NOT NULL) AS {c}"
                   for c in ["partDescription", "quantityShipped", "unitPrice", "invoiceNumber",
                             "discountPercent", "Category", "MotorSize", "invoiceDate", "customerCode", "jobNumber"])
ORACLE["aggregate_by_part"] = with_views(_SALES_VIEWS, [_SALES, _CLEAN], f"""
SELECT partNumber, {_FIRST}, coalesce(sum(quantityText), 0) AS quantityText
FROM clean WHERE partNumber IS NOT NULL GROUP BY partNumber""")

# --- scans -------------------------------------------------------------------------------------------
from partflow.plans.catalog import PAGE  # noqa: E402

_S = PARAMS["sales_start"]
_AFTER = "CAST({c} AS TIMESTAMP) > TIMESTAMP '{d} 00:00:00'"

ORACLE["entity_scan"] = with_views(["order_line_items"], [],
                                   "SELECT orderNumber, partNumber, quantityToMake, status FROM order_line_items")
ORACLE["entity_filter"] = with_views(["order_line_items"], [], f"""
SELECT orderNumber, itemNumber, partNumber, partDescription, quantityToMake, status, dateFinished
FROM order_line_items WHERE status = 'Open' AND {_AFTER.format(c='dateFinished', d='1998-01-01')}""")
ORACLE["lookup_in"] = with_views(_SALES_VIEWS, [], f"""
SELECT * FROM ar_invoice_details WHERE invoiceNumber IN
  (SELECT invoiceNumber FROM ar_invoices WHERE {_AFTER.format(c='invoiceDate', d=_S)})""")
ORACLE["page"] = with_views(["order_line_items"], [], f"""
SELECT orderNumber, itemNumber, partNumber, partDescription, quantityToMake, status, dateFinished
FROM order_line_items ORDER BY {', '.join(PAGE['order'])} LIMIT {PAGE['take']} OFFSET {PAGE['skip']}""")
ORACLE["json_collection"] = """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"""
ORACLE["employees"] = with_views(["employees"], [], "SELECT * FROM employees")

# --- header / detail joins ----------------------------------------------------------------------------
_PURCHASES = ("purchases", f"""
SELECT l.purchaseOrderNumber AS PONumber, l.itemNumber, l.partNumber, l.partDescription, l.quantityOrdered,
  l.quantityReceived, l.status AS status_x, l.dateFinished, l.dueDate, l.lastModDate, l.outsideService, l.unit, l.unitCost,
  h.status AS status_y, h.dateEntered, h.vendorCode, h.vendorDescription
FROM purchase_order_line_items l LEFT JOIN purchase_orders h ON l.purchaseOrderNumber IS NOT DISTINCT FROM h.PONumber
WHERE {_AFTER.format(c='l.dateFinished', d=_S)}""")
ORACLE["purchases"] = with_views(["purchase_order_line_items", "purchase_orders"], [_PURCHASES],
                                 "SELECT * FROM purchases")

_ORDER_ITEMS = ("order_items", f"""
SELECT o.* EXCLUDE (status, uniqueID), o.status AS status_x, o.uniqueID AS uniqueID_x,
  l.* EXCLUDE (orderNumber, status, uniqueID), l.status AS status_y, l.uniqueID AS uniqueID_y
FROM stg_orders o JOIN order_line_items l ON o.orderNumber IS NOT DISTINCT FROM l.orderNumber
WHERE {_AFTER.format(c='l.dateFinished', d=_S)}""")
ORACLE["order_items"] = with_views(["stg_orders", "order_line_items"], [_ORDER_ITEMS], "SELECT * FROM order_items")

_HOURS = "CASE {u} WHEN 'M' THEN {c} / 60.0 WHEN 'S' THEN {c} / 3600.0 ELSE {c} END"
ORACLE["jobs"] = with_views(["stg_orders", "order_line_items", "order_routings", "routings"], [
    _ORDER_ITEMS,
    ("routes", "SELECT * FROM order_routings WHERE orderNumber IN (SELECT orderNumber FROM order_items)"),
    ("est", f"""SELECT partNumber, stepNumber, workCenter, vendorCode, description, burdenRate, laborRate, lastModDate, {_HOURS.format(u='timeUnit', c='setupTime')} AS setupTime,
       {_HOURS.format(u='cycleUnit', c='cycleTime')} AS cycleTime FROM routings"""),
], """
SELECT coalesce(r.partNumber, e.partNumber) AS partNumber, coalesce(r.stepNumber, e.stepNumber) AS stepNumber,
  r.* EXCLUDE (partNumber, stepNumber), e.workCenter AS workCenter_estimate, e.vendorCode AS vendorCode_estimate,
  e.description AS description_estimate, e.burdenRate AS burdenRate_estimate, e.laborRate AS laborRate_estimate, e.lastModDate,
  e.setupTime, e.cycleTime
FROM routes r FULL OUTER JOIN est e
  ON r.partNumber IS NOT DISTINCT FROM e.partNumber AND r.stepNumber IS NOT DISTINCT FROM e.stepNumber""")
ORACLE["job_materials"] = with_views(["job_materials"], [], f"""
SELECT * FROM job_materials
WHERE CAST(datePosted AS TIMESTAMP) > TIMESTAMP '1999-06-30 00:00:00'""")

_DEMAND = ("demand", """SELECT partNumber, coalesce(sum(quantityText), 0) AS quantityText FROM clean
  WHERE partNumber IS NOT NULL GROUP BY partNumber""")
_OPEN_AGG = ("open_agg", """
SELECT partNumber,
  CASE WHEN count(*) FILTER (WHERE customerCode = 'HOUSEDH') > 0
       THEN coalesce(sum(quantityToMake) FILTER (WHERE customerCode = 'HOUSEDH'), 0) END AS quantityToMake,
  CASE WHEN count(*) FILTER (WHERE customerCode IS DISTINCT FROM 'HOUSEDH') > 0
       THEN coalesce(sum(quantityToMake) FILTER (WHERE customerCode IS DISTINCT FROM 'HOUSEDH'), 0) END AS openCustomerOrders
FROM (SELECT l.partNumber, l.quantityToMake, o.customerCode
      FROM order_line_items l LEFT JOIN stg_orders o ON l.orderNumber IS NOT DISTINCT FROM o.orderNumber
      WHERE l.status = 'Open' AND l.partNumber IN (SELECT partNumber FROM {parts}))
WHERE partNumber IS NOT NULL GROUP BY partNumber""")
_OPEN_VIEWS = _SALES_VIEWS + ["order_line_items", "stg_orders"]
ORACLE["open_sales"] = with_views(_OPEN_VIEWS, [
    _SALES, _CLEAN, _DEMAND, (_OPEN_AGG[0], _OPEN_AGG[1].format(parts="demand"))], """
SELECT d.partNumber, d.quantityText, a.quantityToMake, a.openCustomerOrders
FROM demand d LEFT JOIN open_agg a ON d.partNumber IS NOT DISTINCT FROM a.partNumber""")

ORACLE["open_purchases"] = with_views(["inventory", "purchase_order_line_items"], [
    ("po_agg", """
SELECT partNumber, sum(coalesce(quantityOrdered, 0) - coalesce(quantityReceived, 0)) AS quantityOrdered,
  arg_min(coalesce(partDescription, '0'), (purchaseOrderNumber, itemNumber, quantityOrdered)) AS partDescription
FROM purchase_order_line_items WHERE status = 'Open' AND partNumber IS NOT NULL GROUP BY partNumber""")], """
SELECT i.partNumber, i.partDescription AS partDescription_x, i.quantityOnHand, a.quantityOrdered,
  a.partDescription AS partDescription_y
FROM inventory i LEFT JOIN po_agg a ON i.partNumber IS NOT DISTINCT FROM a.partNumber""")

ORACLE["lead_times"] = with_views(["purchase_order_line_items", "purchase_orders"], [
    _PURCHASES,
    ("lt", """
SELECT partNumber,
  date_diff('day', CAST(split_part(dateEntered, 'T', 1) AS DATE), CAST(split_part(dateFinished, 'T', 1) AS DATE)) AS leadTime,
  strftime(CAST(split_part(dateFinished, 'T', 1) AS DATE), '%y-%m-%d') AS lastDateReceived
FROM purchases WHERE dateEntered IS NOT NULL AND dateFinished IS NOT NULL AND partNumber IS NOT NULL
  AND vendorCode IS NOT NULL""")], """
SELECT partNumber, arg_max(leadTime, (lastDateReceived, leadTime)) AS leadTime,
  arg_max(lastDateReceived, (lastDateReceived, leadTime)) AS lastDateReceived
FROM lt GROUP BY partNumber""")

# --- report tables ---------------------------------------------------------------------------------------
_REP = ("rep", "SELECT * FROM clean WHERE Category IS NOT NULL AND NOT contains(lower(Category), 'none')")
_CELLS = ("cells", """SELECT MotorSize, Category, coalesce(sum(quantityText), 0) AS quantityText FROM rep
  WHERE MotorSize IS NOT NULL GROUP BY MotorSize, Category""")
_BASE = [_SALES, _CLEAN, _REP]

ORACLE["size_category_pivot"] = with_views(_SALES_VIEWS, _BASE + [_CELLS], "SELECT * FROM cells")
ORACLE["share_of_total"] = with_views(_SALES_VIEWS, _BASE + [_CELLS], """
SELECT MotorSize, Category, (quantityText * 100.0) / (SELECT sum(quantityText) FROM rep) AS share FROM cells""")
ORACLE["with_margins"] = with_views(_SALES_VIEWS, _BASE + [_CELLS], """
SELECT CASE WHEN grouping(MotorSize) = 1 THEN 'Category Sum' ELSE MotorSize END AS MotorSize,
  CASE WHEN grouping(Category) = 1 THEN 'Size Sum' ELSE Category END AS Category, sum(quantityText) AS quantityText,
  CASE WHEN grouping(MotorSize) = 1 OR grouping(Category) = 1 THEN CAST(0 AS DOUBLE) ELSE sum(quantityText) END
    AS color_value
FROM cells GROUP BY CUBE (MotorSize, Category)
HAVING (SELECT count(*) FILTER (WHERE quantityText <> 0 OR isnan(quantityText)) FROM cells) > 0""")

_MAND = ("mand", """SELECT * FROM rep WHERE EXISTS (SELECT 1 FROM rep b WHERE contains(b.Category, 'Mandrels')
  AND b.customerCode IS NOT DISTINCT FROM rep.customerCode)""")
ORACLE["mandrel_customers"] = with_views(_SALES_VIEWS, _BASE + [_MAND], "SELECT * FROM mand")
ORACLE["mandrel_ratio"] = with_views(_SALES_VIEWS, _BASE + [_MAND, (
    "mcells", """SELECT MotorSize, Category, coalesce(sum(quantityText), 0) AS v FROM mand WHERE MotorSize IS NOT NULL
  GROUP BY MotorSize, Category""")], """
SELECT n.MotorSize, n.Category, coalesce(CASE WHEN d.v <> 0 THEN n.v / d.v END, 0) AS ratio
FROM mcells n LEFT JOIN (SELECT MotorSize, v FROM mcells WHERE Category = 'Mandrels') d USING (MotorSize)
WHERE n.Category <> 'Mandrels'""")

_RATIO_CTES = _BASE + [
    ("sums", """SELECT customerCode, Category, coalesce(sum(quantityText), 0) AS v FROM rep
  WHERE customerCode IS NOT NULL GROUP BY customerCode, Category"""),
    ("codes", "SELECT DISTINCT customerCode FROM sums"),
    ("pairs", """SELECT i.customerCode AS customer, r.customerCode FROM codes i JOIN codes r
  ON contains(r.customerCode, i.customerCode)"""),
    ("den", "SELECT customerCode AS customer, v AS den FROM sums WHERE Category = 'Mandrels' AND v > 0"),
    ("p2", "SELECT pairs.customer, pairs.customerCode, den.den FROM pairs JOIN den USING (customer)"),
    ("cats", "SELECT DISTINCT p2.customer, s.Category FROM p2 JOIN sums s ON s.customerCode = p2.customerCode"),
    ("ratios", """SELECT p2.customer, p2.customerCode, c.Category, coalesce(s.v, 0) / p2.den AS ratio
  FROM p2 JOIN cats c ON c.customer = p2.customer
  LEFT JOIN sums s ON s.customerCode = p2.customerCode AND s.Category = c.Category
  WHERE c.Category <> 'Mandrels'"""),
    ("tagged", """SELECT *, list_filter(['ALPHA', 'DELTA', 'OMEGA'], lambda g: contains(lower(customerCode), lower(g))) AS grps
  FROM ratios"""),
    ("ga", """SELECT customerCode AS label, customer, Category, ratio FROM tagged WHERE len(grps) = 0
  UNION ALL
  SELECT g AS label, NULL AS customer, Category, avg(ratio) AS ratio
  FROM (SELECT unnest(grps) AS g, Category, ratio FROM tagged) GROUP BY g, Category HAVING avg(ratio) IS NOT NULL"""),
]
ORACLE["customer_ratio"] = with_views(_SALES_VIEWS, _RATIO_CTES[:-2], "SELECT * FROM ratios")
ORACLE["group_averages"] = with_views(_SALES_VIEWS, _RATIO_CTES,
                                      "SELECT label, customer, Category, round(ratio, 6) AS ratio FROM ga")
ORACLE["relative_to_baseline"] = with_views(_SALES_VIEWS, _RATIO_CTES, """
SELECT a.label, a.customer, a.Category,
  round(CASE WHEN b.ratio <> 0 THEN a.ratio / b.ratio WHEN a.ratio > 0 THEN 'inf'::DOUBLE
             WHEN a.ratio < 0 THEN '-inf'::DOUBLE ELSE 'nan'::DOUBLE END, 6) AS relative
FROM ga a JOIN (SELECT Category, ratio FROM ga WHERE label = 'ALPHA') b USING (Category)
WHERE a.label IS DISTINCT FROM 'ALPHA'
  AND a.Category NOT IN ('Compression Tools', 'Jaw Clutch Center', 'Adjustable Bent Housings')""")

_V = _RATIO_CTES + [("v", """SELECT ratio AS v FROM ga WHERE Category = 'Inner Race' AND ratio IS NOT NULL
  AND NOT isnan(ratio)""")]
ORACLE["histogram"] = with_views(_SALES_VIEWS, _V + [
    ("r", """SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
  CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM v"""),
    ("c", """SELECT CAST(least(floor((v - lo) / (hi - lo) * 20), 19) AS BIGINT) AS bin, count(*) AS count
  FROM v, r GROUP BY 1""")], """
SELECT g.bin, round(lo + g.bin * ((hi - lo) / 20), 6) AS lower, round(lo + (g.bin + 1) * ((hi - lo) / 20), 6) AS upper,
  coalesce(c.count, 0) AS count
FROM (SELECT range AS bin FROM range(20)) g, r LEFT JOIN c ON c.bin = g.bin""")
ORACLE["kde_curve"] = with_views(_SALES_VIEWS, _V + [
    ("s", """SELECT count(v) AS n, stddev_samp(v) AS sd, min(v) AS lo, max(v) AS hi,
  stddev_samp(v) * pow(count(v), -0.2) AS bw FROM v"""),
    ("g", "SELECT range AS point, lo + range * ((hi - lo) / 199) AS x FROM range(200), s")], """
SELECT g.point, round(g.x, 6) AS x,
  round(sum(exp(-0.5 * pow((g.x - v.v) / s.bw, 2)) / (s.bw * sqrt(2 * pi()))) * ((s.hi - s.lo) / 20), 6) AS density
FROM g, v, s GROUP BY g.point, g.x, s.hi, s.lo""")

_MCELLS = ("mcells", """SELECT MotorSize, Category, coalesce(sum(quantityText), 0) AS v FROM mand WHERE MotorSize IS NOT NULL
  GROUP BY MotorSize, Category""")


def _report(name: str, label: str, rest: str, customer: str = "NULL", category: str = "Category", low: str = "NULL", high: str = "NULL") -> str:
    """One report's rows of the bundle; ``rest`` is 'value FROM ...'."""
    value, _, source = rest.partition(" FROM ")
    number = lambda x: f"round(CAST({x} AS DOUBLE), 6)"          # noqa: E731
    return (f"SELECT '{name}' AS report, CAST({label} AS VARCHAR) AS label, CAST({customer} AS VARCHAR) AS customer, CAST({category} AS VARCHAR) AS Category, "
            f"{number(value)} AS value, {number(low)} AS low, {number(high)} AS high FROM {source}")


def _tail(key: str, views: list) -> str:
    """The last SELECT of an oracle whose views are ``views``."""
    return ORACLE[key][len(with_views(_SALES_VIEWS, views, "")):]


_HIST = [
    ("hr", """SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
  CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM v"""),
    ("hc", "SELECT CAST(least(floor((v - lo) / (hi - lo) * 20), 19) AS BIGINT) AS bin, count(*) AS count FROM v, hr GROUP BY 1")]
_KDE = [
    ("s", """SELECT count(v) AS n, stddev_samp(v) AS sd, min(v) AS lo, max(v) AS hi,
  stddev_samp(v) * pow(count(v), -0.2) AS bw FROM v"""),
    ("g", "SELECT range AS point, lo + range * ((hi - lo) / 199) AS x FROM range(200), s"),
    ("curve", """SELECT g.point, g.x, sum(exp(-0.5 * pow((g.x - v.v) / s.bw, 2)) / (s.bw * sqrt(2 * pi()))) * ((s.hi - s.lo) / 20) AS density
  FROM g, v, s GROUP BY g.point, g.x, s.hi, s.lo""")]
_BUNDLE = _V + [_CELLS, _MAND, _MCELLS] + _HIST + _KDE + [
    ("margins", f"SELECT * FROM ({_tail('with_margins', _BASE + [_CELLS])})"),
    ("mratio", f"SELECT * FROM ({_tail('mandrel_ratio', _BASE + [_MAND, _MCELLS])})"),
    ("rel", f"SELECT * FROM ({_tail('relative_to_baseline', _RATIO_CTES)})")]
ORACLE["breakdown"] = with_views(_SALES_VIEWS, _BUNDLE, "\nUNION ALL ".join([
    _report("size_category_pivot", "MotorSize", "quantityText FROM cells"),
    _report("with_margins", "MotorSize", "quantityText FROM margins"),
    _report("mandrel_ratio", "MotorSize", "ratio FROM mratio"),
    _report("customer_ratio", "customerCode", "ratio FROM ratios", customer="customer"),
    _report("group_averages", "label", "ratio FROM ga", customer="customer"),
    _report("relative_to_baseline", "label", "relative FROM rel", customer="customer"),
    _report("histogram", "b.range", "coalesce(hc.count, 0) FROM range(20) b CROSS JOIN hr LEFT JOIN hc ON hc.bin = b.range", category="NULL",
            low="lo + b.range * ((hi - lo) / 20)", high="lo + (b.range + 1) * ((hi - lo) / 20)"),
    _report("kde_curve", "point", "density FROM curve", category="NULL", low="x")]))

ORACLE["value_range"] = with_views(_SALES_VIEWS, [_SALES, _CLEAN, _DEMAND],
                                   "SELECT min(quantityText) AS min_value, max(quantityText) AS max_value FROM demand")

_QCLEAN = ("qclean", _CLEAN[1].replace("FROM sales", "FROM qsales"))
_QSALES = ("qsales", _SALES[1].replace(PARAMS["sales_start"], PARAMS["quarter_start"]))
ORACLE["size_forecast"] = with_views(_OPEN_VIEWS + ["inventory"], [
    _SALES, _CLEAN, _QSALES, _QCLEAN,
    ("per_part", f"""SELECT partNumber, {_FIRST.split(', arg_min(quantityShipped')[0]},
  arg_min(MotorSize, {_ORD}) FILTER (WHERE MotorSize IS NOT NULL) AS MotorSize,
  arg_min(Category, {_ORD}) FILTER (WHERE Category IS NOT NULL) AS Category,
  coalesce(sum(quantityText), 0) AS quantityText FROM clean WHERE partNumber IS NOT NULL GROUP BY partNumber"""),
    (_OPEN_AGG[0], _OPEN_AGG[1].format(parts="per_part")),
    ("quarter", """SELECT partNumber, coalesce(sum(quantityText), 0) AS q FROM qclean WHERE partNumber IS NOT NULL
  GROUP BY partNumber""")], """
SELECT p.partNumber, p.partDescription, p.quantityText AS "Shipped 12Mo", coalesce(q.q, 0) AS "Shipped 3Mo",
  coalesce(a.quantityToMake, 0) AS InProcess, coalesce(i.quantityOnHand, 0) AS Inventory, p.MotorSize, p.Category,
  coalesce(a.openCustomerOrders, 0) AS openCustomerOrders,
  coalesce(i.quantityOnHand, 0) + coalesce(a.quantityToMake, 0) AS "Inventory+InProcess"
FROM per_part p LEFT JOIN open_agg a ON p.partNumber IS NOT DISTINCT FROM a.partNumber
LEFT JOIN inventory i ON p.partNumber IS NOT DISTINCT FROM i.partNumber
LEFT JOIN quarter q ON p.partNumber IS NOT DISTINCT FROM q.partNumber
WHERE p.Category IS NOT NULL""")

# --- bill of materials ---------------------------------------------------------------------------------
_MARK = "BK|KM|BM|BNK|BVM|JM|XM"
_XR = "15X|16X|15EX|16EX"
_PER_PART = ("per_part", f"""SELECT partNumber, arg_min(partDescription, {_ORD}) FILTER (WHERE partDescription IS NOT NULL)
  AS partDescription, coalesce(sum(quantityText), 0) AS quantityText FROM clean WHERE partNumber IS NOT NULL
  GROUP BY partNumber""")
_EDGES = ("edges", """SELECT partNumber AS assembly, subPartNumber AS part,
  arg_min(quantity, (ord, quantity, description)) AS quantity, arg_min(description, (ord, quantity, description)) AS description,
  CAST(min(ord) AS BIGINT) AS ord
  FROM materials WHERE partNumber IS NOT NULL AND subPartNumber IS NOT NULL GROUP BY partNumber, subPartNumber""")
_ROOTS = ("roots", "SELECT partNumber AS part, min(partDescription) AS description FROM per_part GROUP BY partNumber")
_NODES = ("nodes(root, Node, Parent, depth, quantity, description, ord, names)", """
  SELECT part, part, 'Root', 1, CAST(1.0 AS DOUBLE), description, hex(part) || '!', [part] FROM roots
  UNION ALL
  SELECT n.root, e.part, n.Node, n.depth + 1, e.quantity, e.description,
    n.ord || lpad(CAST(CAST(e.ord AS HUGEINT) + 9223372036854775808 AS VARCHAR), 20, '0') || hex(e.part) || '!', list_append(n.names, e.part)
  FROM nodes n JOIN edges e ON e.assembly = n.Node""")
_BOM_VIEWS = _SALES_VIEWS + ["materials"]
_BOM = [_SALES, _CLEAN, _PER_PART, _EDGES, _ROOTS, _NODES]
_NODE_SEL = "root, Node, Parent, depth, quantity, description, ord"


def _bom_sql(ctes, final, views=_BOM_VIEWS):
    return with_views(views, _BOM + ctes, final, recursive=True)


ORACLE["dedupe_first"] = with_views(["materials"], [_EDGES], "SELECT * FROM edges")
ORACLE["bom_step"] = with_views(_BOM_VIEWS, [_SALES, _CLEAN, _PER_PART], """
SELECT partNumber AS Assembly, subPartNumber AS partNumber, description AS partDescription, quantity FROM materials
WHERE partNumber IN (SELECT partNumber FROM per_part)""")
ORACLE["explode_bom"] = _bom_sql([], f"SELECT {_NODE_SEL} FROM nodes")
ORACLE["tree_rows"] = _bom_sql([], """
SELECT Node, Parent, depth AS Depth, description AS Description, quantity AS Quantity, ord,
  'Root/' || array_to_string(names, '/') AS path FROM nodes
UNION ALL SELECT 'Root', 'ROOT', 0, 'N/A', CAST(0.0 AS DOUBLE), '!', 'Root'""")
ORACLE["prune_tree"] = _bom_sql([], f"""
SELECT {_NODE_SEL} FROM (SELECT *, row_number() OVER (PARTITION BY Node ORDER BY depth DESC, ord) AS rn FROM nodes)
WHERE rn = 1""")
_HEIGHTS = ("heights", """SELECT part, CAST(max(h) AS INTEGER) AS height FROM
  (SELECT names[i] AS part, len(names) - i AS h FROM (SELECT names, unnest(generate_series(1, len(names))) AS i FROM nodes))
  GROUP BY part""")
ORACLE["node_height"] = _bom_sql([_HEIGHTS], """
SELECT n.Node, n.depth, n.ord, coalesce(h.height, 0) AS height FROM nodes n LEFT JOIN heights h ON h.part = n.Node""")

ORACLE["descendants"] = _bom_sql([
    ("asked", f"SELECT Node, ord, depth FROM nodes WHERE regexp_matches(Node, '{_MARK}|{_XR}')"),
    ("down(top, Node, depth)", """
  SELECT ord, Node, depth FROM asked
  UNION ALL SELECT w.top, e.part, w.depth + 1 FROM down w JOIN edges e ON e.assembly = w.Node"""),
    ("below", """SELECT a.ord, d.Node, d.depth FROM down d JOIN asked a ON a.ord = d.top WHERE d.depth > a.depth""")], """
SELECT a.Node, a.ord, a.depth, count(b.Node) AS nodes, count(DISTINCT b.Node) AS parts,
  count(b.Node) FILTER (WHERE b.Node NOT IN (SELECT assembly FROM edges)) AS leaves, coalesce(max(b.depth), a.depth) AS deepest
FROM asked a LEFT JOIN below b ON b.ord = a.ord GROUP BY a.Node, a.ord, a.depth""")

_ANCH = ("anchors", """SELECT Node AS part, arg_min(quantity, ord) AS aq, arg_min(description, ord) AS ad FROM nodes
  GROUP BY Node""")
_MWALK = ("mwalk(part, value, description)", """
  SELECT a.part, d.quantityText * a.aq, a.ad FROM {demand} d JOIN anchors a ON a.part = d.partNumber
  UNION ALL
  SELECT e.part, w.value * e.quantity, e.description FROM mwalk w JOIN edges e ON e.assembly = w.part""")
_MREC = f"""SELECT w.part AS partNumber, w.value AS quantityText, w.description AS partDescription FROM mwalk w
  WHERE w.part NOT IN (SELECT assembly FROM edges) OR regexp_matches(w.part, '{_MARK}')"""
ORACLE["bom_materials"] = _bom_sql([_ANCH, (_MWALK[0], _MWALK[1].format(demand="per_part"))], _MREC)

_SANCH = ("sanchors", """SELECT Node AS part, arg_min(quantity, (quantity, ord)) AS aq,
  arg_min(description, (quantity, ord)) AS ad FROM nodes GROUP BY Node""")
_PROPS = ("props", f"""SELECT h.part, h.height, i.marker_child FROM heights h LEFT JOIN
  (SELECT assembly AS part, bool_or(regexp_matches(part, '{_MARK}')) AS marker_child FROM edges GROUP BY assembly) i
  ON i.part = h.part""")
_STOP = f"((regexp_matches(w.part, '{_MARK}') OR coalesce(p.height, 0) < 1) AND NOT regexp_matches(w.part, '{_XR}'))"
_CWALK = ("cwalk(part, value, description)", f"""
  SELECT a.part, d.quantityText * a.aq, a.ad FROM per_part d JOIN sanchors a ON a.part = d.partNumber
  UNION ALL
  SELECT e.part, w.value * e.quantity, e.description FROM cwalk w JOIN edges e ON e.assembly = w.part
    LEFT JOIN props p ON p.part = w.part WHERE NOT {_STOP}""")
ORACLE["bom_components"] = _bom_sql([_HEIGHTS, _SANCH, _PROPS, _CWALK], f"""
SELECT w.part AS partNumber, w.value AS quantityText, w.description AS partDescription
FROM cwalk w LEFT JOIN props p ON p.part = w.part
WHERE NOT {_STOP} AND (coalesce(p.height, 0) = 1 OR coalesce(p.marker_child, false)
  OR regexp_matches(w.part, '{_XR}'))""")

ORACLE["material_requirements"] = _bom_sql([
    _ANCH,
    (_OPEN_AGG[0], _OPEN_AGG[1].format(parts="per_part")),
    ("net", """SELECT p.partNumber, p.quantityText - (coalesce(i.quantityOnHand, 0) - coalesce(a.quantityToMake, 0))
       AS quantityText FROM per_part p LEFT JOIN open_agg a ON p.partNumber IS NOT DISTINCT FROM a.partNumber
       LEFT JOIN inventory i ON p.partNumber IS NOT DISTINCT FROM i.partNumber"""),
    ("netpos", "SELECT * FROM net WHERE quantityText > 0"),
    (_MWALK[0], _MWALK[1].format(demand="netpos")),
    ("mats", _MREC),
    ("po_agg", """SELECT partNumber, sum(coalesce(quantityOrdered, 0) - coalesce(quantityReceived, 0)) AS quantityOrdered
       FROM purchase_order_line_items WHERE status = 'Open' AND partNumber IS NOT NULL GROUP BY partNumber""")], """
SELECT m.partNumber, m.q AS quantityText_12mo, i.quantityOnHand, o.quantityOrdered
FROM (SELECT partNumber, coalesce(sum(quantityText), 0) AS q FROM mats WHERE partNumber IS NOT NULL GROUP BY partNumber) m
LEFT JOIN inventory i ON m.partNumber IS NOT DISTINCT FROM i.partNumber
LEFT JOIN po_agg o ON i.partNumber IS NOT DISTINCT FROM o.partNumber""",
    views=_BOM_VIEWS + ["order_line_items", "stg_orders", "inventory", "purchase_order_line_items"])

# --- text ------------------------------------------------------------------------------------------------
_TEXT = [
    ("tok", r"""SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents"""),
    ("tf", "SELECT doc_id, lang, term, count(*) AS tf FROM tok GROUP BY doc_id, lang, term"),
    ("dfreq", "SELECT term, count(*) AS df FROM tf GROUP BY term"),
    ("w", """SELECT tf.doc_id, tf.lang, tf.term, tf.tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + dfreq.df)) + 1) AS w
  FROM tf JOIN dfreq USING (term)"""),
    ("nw", "SELECT doc_id, lang, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w"),
]
ORACLE["tfidf"] = with_views([], _TEXT, "SELECT doc_id, term, round(weight, 6) AS weight FROM nw")
ORACLE["top_terms_per_language"] = with_views([], _TEXT + [
    ("cn", "SELECT lang, count(*) AS nd FROM documents GROUP BY lang"),
    ("m", """SELECT nw.lang, term, round(sum(weight) / cn.nd, 10) AS mean FROM nw JOIN cn ON cn.lang = nw.lang
  GROUP BY nw.lang, term, cn.nd"""),
    ("r", "SELECT *, row_number() OVER (PARTITION BY lang ORDER BY mean DESC, term) AS rk FROM m")], """
SELECT lang AS cluster, string_agg(term, ' ' ORDER BY rk) AS top_terms FROM r WHERE rk <= 3 GROUP BY lang""")

# k-means again from the documents: start by rounds of k-means||, thinning to k, Lloyd rounds
_K, _ROUNDS = CLUSTERS["k"], CLUSTERS["rounds"]


def _u(turn: int) -> str:
    return f"(CAST('0x' || substr(md5('{CLUSTERS['seed']}:{turn}:' || CAST(doc_id AS VARCHAR)), 1, 12) AS BIGINT) / 281474976710656.0)"


def _nearest_to(centres: str, out: str) -> list[tuple[str, str]]:
    """Views: dots of documents and centres (c, term, weight), the square of each centre, the nearest centre (smallest number of equals)."""
    return [
        (f"{out}_sq", f"SELECT n.c, coalesce(sum(weight * weight), 0) AS cc FROM {centres}_n n LEFT JOIN {centres} USING (c) GROUP BY n.c"),
        (f"{out}_dot", f"SELECT doc_id, c, sum(kx.weight * z.weight) AS dot FROM kx JOIN {centres} z USING (term) GROUP BY doc_id, c"),
        (out, f"""SELECT doc_id, min(d2) AS d2, arg_min(c, (d2, c)) AS c FROM (
  SELECT kd.doc_id, q.c, greatest(round(kd.xx + q.cc - 2 * coalesce(dot, 0), 9), 0) AS d2
  FROM kd CROSS JOIN {out}_sq q LEFT JOIN {out}_dot d ON d.doc_id = kd.doc_id AND d.c = q.c) GROUP BY doc_id""")]


def _cluster_views() -> list[tuple[str, str]]:
    out = _TEXT[:2] + [
        ("kf", f"SELECT term, count(*) AS df FROM tf GROUP BY term ORDER BY df DESC, term LIMIT {CLUSTERS['features']}"),
        ("kw", """SELECT doc_id, term, tf.tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w FROM tf JOIN kf USING (term)"""),
        ("kx", "SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM kw"),
        ("kd", "SELECT doc_id, CASE WHEN EXISTS (SELECT 1 FROM kx WHERE kx.doc_id = documents.doc_id) THEN 1.0 ELSE 0.0 END AS xx FROM documents"),
        ("cand0", f"SELECT 0 AS c, doc_id FROM (SELECT doc_id FROM kd ORDER BY {_u(0)}, doc_id LIMIT 1)")]

    def rows_of(cands: str) -> list[tuple[str, str]]:
        return [(f"{cands}_v", f"SELECT c, term, weight FROM {cands} JOIN kx USING (doc_id)"), (f"{cands}_v_n", f"SELECT c FROM {cands}")]

    turns = CLUSTERS["start_rounds"]
    for r in range(1, turns + 1):
        out += rows_of(f"cand{r - 1}") + _nearest_to(f"cand{r - 1}_v", f"far{r}") + [(f"cand{r}", f"""
  SELECT c, doc_id FROM cand{r - 1} UNION ALL
  SELECT (SELECT max(c) FROM cand{r - 1}) + row_number() OVER (ORDER BY doc_id) AS c, doc_id FROM far{r}
  WHERE {_u(r)} * (SELECT sum(d2) FROM far{r}) < {2 * _K} * d2""")]
    last = f"cand{turns}"
    out += rows_of(last) + _nearest_to(f"{last}_v", "near0") + [
        ("wt", f"SELECT n.c, count(near0.c) AS wt FROM {last} n LEFT JOIN near0 USING (c) GROUP BY n.c"),
        ("cdot", f"SELECT a.c, b.c AS o, sum(a.weight * b.weight) AS dot FROM {last}_v a JOIN {last}_v b USING (term) GROUP BY a.c, b.c"),
        ("cd", """SELECT a.c, b.c AS o, greatest(round(a.cc + b.cc - 2 * coalesce(dot, 0), 9), 0) AS d2
  FROM near0_sq a CROSS JOIN near0_sq b LEFT JOIN cdot ON cdot.c = a.c AND cdot.o = b.c"""),
        ("pick0", "SELECT 0 AS j, c FROM (SELECT c FROM wt ORDER BY wt DESC, c LIMIT 1)")]
    for j in range(1, _K):
        out.append((f"pick{j}", f"""SELECT * FROM pick{j - 1} UNION ALL SELECT {j}, c FROM (
  SELECT wt.c, round(wt * min(d2), 6) AS value FROM wt JOIN cd USING (c) WHERE cd.o IN (SELECT c FROM pick{j - 1})
  GROUP BY wt.c, wt HAVING round(wt * min(d2), 6) > 0 ORDER BY value DESC, wt.c LIMIT 1)"""))
    out += [("mean0", f"SELECT j AS c, term, weight FROM pick{_K - 1} p JOIN {last}_v v ON v.c = p.c"), ("mean0_n", f"SELECT j AS c FROM pick{_K - 1}")]
    for r in range(1, _ROUNDS + 1):
        out += _nearest_to(f"mean{r - 1}", f"own{r}") + [
            (f"size{r}", f"SELECT c, count(*) AS n FROM own{r} GROUP BY c"),
            (f"mean{r}", f"""SELECT o.c, term, sum(weight) / max(n) AS weight FROM own{r} o JOIN kx USING (doc_id) JOIN size{r} s ON s.c = o.c GROUP BY o.c, term
  UNION ALL SELECT * FROM mean{r - 1} WHERE c NOT IN (SELECT c FROM size{r})"""),
            (f"mean{r}_n", "SELECT c FROM mean0_n")]
    return out + _nearest_to(f"mean{_ROUNDS}", "own")


ORACLE["tfidf_clusters"] = with_views([], _cluster_views(), "SELECT doc_id, CAST(c AS INTEGER) AS cluster FROM own")
ORACLE["top_terms_per_cluster"] = with_views([], _cluster_views() + [
    ("nd", "SELECT c, count(*) AS nd FROM own GROUP BY c"),
    ("m", """SELECT own.c, term, round(sum(weight) / max(nd), 10) AS mean FROM own JOIN kx USING (doc_id) JOIN nd ON nd.c = own.c
  GROUP BY own.c, term"""),
    ("r", "SELECT *, row_number() OVER (PARTITION BY c ORDER BY mean DESC, term) AS rk FROM m")], """
SELECT CAST(c AS INTEGER) AS cluster, string_agg(term, ' ' ORDER BY rk) AS top_terms FROM r WHERE rk <= 3 GROUP BY c""")

# --- sinks and cached / paged sources ---------------------------------------------------------------------
ORACLE["load_tree"] = _bom_sql([("trows", """
SELECT Node, Parent, description AS Description, quantity AS Quantity, ord FROM nodes
UNION ALL SELECT 'Root', 'ROOT', 'N/A', CAST(0.0 AS DOUBLE), '!'""")], """
SELECT Node, arg_max(Parent, ord) AS Parent, arg_max(Description, ord) AS Description, arg_max(Quantity, ord) AS Quantity,
  max(ord) AS ord FROM trows GROUP BY Node""")
_SHEETS = ORACLE["size_forecast"].replace(
    'p.MotorSize, p.Category,', 'p.MotorSize,').replace(
    "WHERE p.Category IS NOT NULL", "WHERE p.Category IS NOT NULL AND p.MotorSize IS NOT NULL")
ORACLE["write_size_sheets"] = f"""
SELECT *, 'sizes' AS sheet FROM ({_SHEETS}) UNION ALL BY NAME SELECT *, 'Materials' AS sheet FROM ({ORACLE["material_requirements"]})"""
ORACLE["materialize_once"] = with_views(["ar_invoices"], [], f"""
SELECT invoiceNumber, invoiceDate, customerCode FROM ar_invoices WHERE {_AFTER.format(c='invoiceDate', d=_S)}""")
ORACLE["json_pages"] = "SELECT event_id, event_type, value FROM events"
ORACLE["materialize_once_hit"] = ORACLE["materialize_once"]
