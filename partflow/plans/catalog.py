"""Runnable queries over the driver's tables: one function per operator key.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame over the whole given
tables (through the staged entities). Queries over bills, text, customer ratios, histograms and
sinks write intermediate tables while they are built. Parameters that
the reference took from its caller (start dates, statistic column, house
account) are fixed here once, in :data:`PARAMS`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.operators import cleaning, orders, reports
from partflow.sources.staging import Tables

PARAMS = {
    "sales_start": "1995-06-30",     # invoices strictly after this date
    "jobs_start": "2000-06-30",      # jobs: materials posted after the date one year before
    "quarter_start": "2001-05-01",   # invoices of the "last quarter" statistic
    "statistic": "quantityText",     # currency text, parsed by clean_sales
    "datestat": "invoiceDate",
    "top_n": 10,
}
# Row order for "first" in aggregate_by_part (non-null columns of a sales line).
SALES_ORDER = ("invoiceNumber", "partNumber", "quantityText", "unitPrice", "discountPercent")

# The invoice detail columns of the flows, and the test data's statistic and classes.
DETAIL_FIELDS = orders.INVOICE_DETAIL_FIELDS + ",quantityText,Category,MotorSize"
ORDER_LINE_FIELDS = "orderNumber,itemNumber,partNumber,partDescription,quantityToMake,status,dateFinished"

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _t(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


def _clean(t: Tables, start: str | None = None) -> DataFrame:
    s = orders.sales(t, start or PARAMS["sales_start"], DETAIL_FIELDS)
    return cleaning.clean_sales(s, PARAMS["statistic"], PARAMS["datestat"])


@query("sales")
def q_sales(spark, sf_dir):
    return orders.sales(_t(spark, sf_dir), PARAMS["sales_start"], DETAIL_FIELDS)


@query("clean_sales")
def q_clean_sales(spark, sf_dir):
    return _clean(_t(spark, sf_dir))


@query("top_parts")
def q_top_parts(spark, sf_dir):
    return reports.top_parts(_clean(_t(spark, sf_dir)), PARAMS["statistic"], PARAMS["top_n"])


@query("aggregate_by_part")
def q_aggregate_by_part(spark, sf_dir):
    return reports.aggregate_by_part(_clean(_t(spark, sf_dir)), PARAMS["statistic"], SALES_ORDER)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round double columns of a report (sums of floats depend on addition order)."""
    return df.select(*[F.round(F.col(f"`{f.name}`"), digits).alias(f.name) if f.dataType.typeName() == "double"
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


# --- scans -------------------------------------------------------------------------------------------

from partflow.sources import entity  # noqa: E402

ENTITY_FILTER = "status=Open&dateFinished[gt]=1998-01-01"
PAGE = {"skip": 400, "take": 200,
        "order": ("orderNumber", "itemNumber", "partNumber", "quantityToMake", "status", "dateFinished")}


@query("entity_scan")
def q_entity_scan(spark, sf_dir):
    return entity.read_entity(_t(spark, sf_dir), "order_line_items", "orderNumber, partNumber ,quantityToMake, status")


@query("entity_filter")
def q_entity_filter(spark, sf_dir):
    return entity.read_entity(_t(spark, sf_dir), "order_line_items", ORDER_LINE_FIELDS,
                              filter_string=ENTITY_FILTER)


@query("lookup_in")
def q_lookup_in(spark, sf_dir):
    t = _t(spark, sf_dir)
    inv = entity.read_entity(t, "ar_invoices", orders.INVOICE_FIELDS,
                             filter_string=f"invoiceDate[gt]={PARAMS['sales_start']}")
    return entity.read_entity(t, "ar_invoice_details", DETAIL_FIELDS,
                              search={"invoiceNumber": inv.select("invoiceNumber")})


@query("page")
def q_page(spark, sf_dir):
    df = entity.read_entity(_t(spark, sf_dir), "order_line_items", ORDER_LINE_FIELDS)
    return entity.page(df, PAGE["order"], PAGE["skip"], PAGE["take"])


@query("json_collection")
def q_json_collection(spark, sf_dir):
    ev = _t(spark, sf_dir).base("events")
    return entity.json_collection(ev, "props", "k bigint", keep=["event_id", "event_type"])


@query("employees")
def q_employees(spark, sf_dir):
    return entity.employees(_t(spark, sf_dir))


# --- header / detail joins ----------------------------------------------------------------------------

@query("purchases")
def q_purchases(spark, sf_dir):
    return orders.purchases(_t(spark, sf_dir), PARAMS["sales_start"])


@query("order_items")
def q_order_items(spark, sf_dir):
    return orders.order_items(_t(spark, sf_dir), PARAMS["sales_start"])


def _jobs(spark, sf_dir):
    t = _t(spark, sf_dir)
    return orders.jobs(t, PARAMS["jobs_start"], orders.order_items(t, PARAMS["sales_start"]))


@query("jobs")
def q_jobs(spark, sf_dir):
    return _jobs(spark, sf_dir)[0]


@query("job_materials")
def q_job_materials(spark, sf_dir):
    return _jobs(spark, sf_dir)[1]


def _demand(t: Tables, start: str | None = None) -> DataFrame:
    return reports.sum_by_key(_clean(t, start), "partNumber", PARAMS["statistic"])


@query("open_sales")
def q_open_sales(spark, sf_dir):
    t = _t(spark, sf_dir)
    return orders.open_sales(t, _demand(t))


@query("open_purchases")
def q_open_purchases(spark, sf_dir):
    t = _t(spark, sf_dir)
    return orders.open_purchases(t, t.entity("inventory"))


@query("lead_times")
def q_lead_times(spark, sf_dir):
    return orders.lead_times(orders.purchases(_t(spark, sf_dir), PARAMS["sales_start"]))


# --- report tables ---------------------------------------------------------------------------------------

@query("size_category_pivot")
def q_size_category_pivot(spark, sf_dir):
    return reports.size_category_pivot(_clean(_t(spark, sf_dir)), PARAMS["statistic"])


@query("share_of_total")
def q_share_of_total(spark, sf_dir):
    return reports.share_of_total(_clean(_t(spark, sf_dir)), PARAMS["statistic"])


@query("with_margins")
def q_with_margins(spark, sf_dir):
    cells = reports.size_category_pivot(_clean(_t(spark, sf_dir)), PARAMS["statistic"])
    return reports.with_margins(cells, PARAMS["statistic"])


@query("mandrel_customers")
def q_mandrel_customers(spark, sf_dir):
    return reports.mandrel_customers(_clean(_t(spark, sf_dir)))


@query("mandrel_ratio")
def q_mandrel_ratio(spark, sf_dir):
    return reports.mandrel_ratio(_clean(_t(spark, sf_dir)), PARAMS["statistic"])


def _customer_ratio(spark, sf_dir):
    return reports.customer_ratio(_clean(_t(spark, sf_dir)), PARAMS["statistic"])


@query("customer_ratio")
def q_customer_ratio(spark, sf_dir):
    return _customer_ratio(spark, sf_dir)


def _group_averages(spark, sf_dir):
    return reports.group_averages(_customer_ratio(spark, sf_dir))


@query("group_averages")
def q_group_averages(spark, sf_dir):
    return rounded(_group_averages(spark, sf_dir))


@query("relative_to_baseline")
def q_relative_to_baseline(spark, sf_dir):
    return rounded(reports.relative_to_baseline(_group_averages(spark, sf_dir)))


def _inner_race(spark, sf_dir):
    return _group_averages(spark, sf_dir).where(F.col("Category") == "Inner Race")


@query("histogram")
def q_histogram(spark, sf_dir):
    return rounded(reports.histogram(_inner_race(spark, sf_dir), "ratio"))


@query("kde_curve")
def q_kde_curve(spark, sf_dir):
    return rounded(reports.kde_curve(_inner_race(spark, sf_dir), "ratio"))


@query("value_range")
def q_value_range(spark, sf_dir):
    return reports.value_range(_demand(_t(spark, sf_dir)), PARAMS["statistic"])


@query("breakdown")
def q_breakdown(spark, sf_dir):
    """The report bundle of the cleaned sales in one scan, as one long table."""
    from partflow.plans.breakdown import breakdown, long_form

    return long_form(breakdown(_clean(_t(spark, sf_dir)), PARAMS["statistic"]), PARAMS["statistic"])


def _forecast_inputs(t: Tables, reused: bool = False) -> tuple[DataFrame, DataFrame]:
    """(demand, quarter) for the forecast sheet from one scan of the sales; ``reused``: the demand is read more than once, so it is written too.

    The quarter window starts inside the 12-month window, so the quarter sum is
    a conditional sum in the same aggregation (flagged on the invoice time
    before cleaning turns it into a date). The per-part table is small and
    read twice, so it is written once.
    """
    from partflow.functions.semantics import first_non_null, merge, row_order, sum_or_zero
    from partflow.session import materialize

    stat = PARAMS["statistic"]
    s = orders.sales(t, PARAMS["sales_start"], DETAIL_FIELDS)
    s = s.withColumn("__in_quarter", F.to_timestamp("invoiceDate") > F.to_timestamp(F.lit(PARAMS["quarter_start"])))
    c = cleaning.clean_sales(s, stat, PARAMS["datestat"])
    o = row_order(*SALES_ORDER)
    per_part = (c.where(F.col("partNumber").isNotNull()).withColumn("__ord", o).groupBy("partNumber")
                .agg(*[first_non_null(k, F.col("__ord")).alias(k) for k in ("partDescription", "MotorSize", "Category")],
                     sum_or_zero(stat).alias(stat),
                     F.sum(F.when(F.col("__in_quarter"), F.col(stat))).alias("__quarter")))
    per_part = materialize(per_part, "forecast-parts")
    demand = orders.open_sales(t, per_part.drop("__quarter"))
    demand = merge(demand, t.entity("inventory").select("partNumber", "quantityOnHand"), "partNumber", "left")
    if reused:
        demand = materialize(demand, "forecast-demand")
    quarter = per_part.where(F.col("__quarter").isNotNull()).select("partNumber", F.col("__quarter").alias(stat))
    return demand, quarter


@query("size_forecast")
def q_size_forecast(spark, sf_dir):
    demand, quarter = _forecast_inputs(_t(spark, sf_dir))
    return reports.size_forecast(demand, quarter, PARAMS["statistic"])


# --- bill of materials ---------------------------------------------------------------------------------

from partflow.operators import bom  # noqa: E402
from partflow.functions.patterns import MOLD_BLANK_MARKERS, X_RACE_MARKERS  # noqa: E402
from partflow.functions.scalar import contains_any  # noqa: E402
from partflow.functions.semantics import merge  # noqa: E402
from partflow.session import materialize  # noqa: E402


def _per_part(t: Tables) -> DataFrame:
    """Demand per sold part: summed statistic and first description."""
    stat = PARAMS["statistic"]
    return reports.sum_first_by_key(_clean(t), "partNumber", stat, "partDescription", SALES_ORDER)


def _bom(spark, sf_dir, demand_reused: bool = True):
    """Loop-invariant BOM inputs, written once (every level of the loops reads them).

    The per-part demand is written only when it is read again after the roots.
    """
    t = _t(spark, sf_dir)
    per_part = _per_part(t)
    if demand_reused:
        per_part = materialize(per_part, "per-part")
    edges = materialize(bom.bom_edges(t.entity("materials")), "bom-edges")
    roots = bom.bom_roots(per_part)
    return t, per_part, edges, roots


def _nodes(spark, sf_dir, demand_reused: bool = False):
    t, per_part, edges, roots = _bom(spark, sf_dir, demand_reused)
    return t, per_part, edges, bom.explode_bom(edges, roots)


_NODE_COLS = ["root", "Node", "Parent", "depth", "quantity", "description", "ord"]


@query("dedupe_first")
def q_dedupe_first(spark, sf_dir):
    return bom.bom_edges(_t(spark, sf_dir).entity("materials"))


@query("bom_step")
def q_bom_step(spark, sf_dir):
    t = _t(spark, sf_dir)
    return bom.bom_step(_per_part(t), t.entity("materials"))


@query("explode_bom")
def q_explode_bom(spark, sf_dir):
    return _nodes(spark, sf_dir)[3].select(*_NODE_COLS)


@query("tree_rows")
def q_tree_rows(spark, sf_dir):
    return bom.tree_rows(_nodes(spark, sf_dir)[3])


@query("prune_tree")
def q_prune_tree(spark, sf_dir):
    _, _, edges, roots = _bom(spark, sf_dir, False)
    return bom.prune_dag(edges, roots).select(*_NODE_COLS)


@query("node_height")
def q_node_height(spark, sf_dir):
    _, _, edges, roots = _bom(spark, sf_dir, False)
    ladder = []
    nodes = bom.explode_bom(edges, roots, ladder)
    return bom.node_height(nodes, bom.ladder_heights(ladder))


@query("descendants")
def q_descendants(spark, sf_dir):
    """Counts of what is below each node of a marked part (mold, blank, X-race)."""
    labelled = materialize(bom.interval_labels(_nodes(spark, sf_dir)[3].select("Node", "depth", "ord")), "labelled")
    return bom.descendant_counts(labelled, labelled.where(contains_any(F.col("Node"), (*MOLD_BLANK_MARKERS, *X_RACE_MARKERS))))


@query("bom_materials")
def q_bom_materials(spark, sf_dir):
    _, per_part, edges, roots = _bom(spark, sf_dir)
    demand = per_part.select("partNumber", PARAMS["statistic"])
    return bom.bom_materials(edges, bom.dag_first_anchors(edges, roots), demand, PARAMS["statistic"])


@query("bom_components")
def q_bom_components(spark, sf_dir):
    _, per_part, edges, roots = _bom(spark, sf_dir)
    demand = per_part.select("partNumber", PARAMS["statistic"])
    roots = materialize(roots, "bom-roots")
    ladder = []
    anchors = bom.dag_smallest_anchors(edges, roots, ladder)
    heights = bom.ladder_heights(ladder) if ladder else bom.part_heights(edges)
    return bom.bom_components(edges, anchors, demand, PARAMS["statistic"], heights)


@query("material_requirements")
def q_material_requirements(spark, sf_dir):
    """Net demand of sold parts (sales - (on hand - in process), missing stock as 0)
    rolled down the BOM in DAG form, with inventory and open purchase quantities."""
    t, per_part, edges, roots = _bom(spark, sf_dir)
    demand = orders.open_sales(t, per_part)
    demand = merge(demand, t.entity("inventory").select("partNumber", "quantityOnHand"), "partNumber", "left")
    return _requirements(t, demand, edges, roots)


def _requirements(t: Tables, demand: DataFrame, edges: DataFrame, roots: DataFrame) -> DataFrame:
    """The materials sheet from the demand per sold part with its open and inventory quantities."""
    stat = PARAMS["statistic"]
    demand = demand.na.fill(0.0, subset=["quantityOnHand", "quantityToMake"])
    inventory = orders.open_purchases(t, t.entity("inventory"))
    return bom.material_requirements(demand, edges, roots, inventory, stat)


# --- text ------------------------------------------------------------------------------------------------

from partflow.operators import clustering, text  # noqa: E402

CLUSTERS = {"k": 8, "seed": 1, "start_rounds": 3, "rounds": 4, "features": clustering.FEATURES}


def _weights(spark, sf_dir):
    return text.tfidf(_t(spark, sf_dir).base("documents"))


@query("tfidf")
def q_tfidf(spark, sf_dir):
    return rounded(_weights(spark, sf_dir))


@query("top_terms_per_language")
def q_top_terms_per_language(spark, sf_dir):
    """Top 3 terms per document language (the cluster label)."""
    docs = _t(spark, sf_dir).base("documents").withColumnRenamed("lang", "cluster")
    return text.top_terms_per_cluster(text.tfidf(docs, keep=("cluster",)), docs, n=3)


def _clustered(spark, sf_dir):
    docs = _t(spark, sf_dir).base("documents").select("doc_id", "text")
    rows = clustering.vectors(docs, features=CLUSTERS["features"])
    return rows, clustering.kmeans(rows, CLUSTERS["k"], CLUSTERS["seed"], CLUSTERS["start_rounds"], CLUSTERS["rounds"])


@query("tfidf_clusters")
def q_tfidf_clusters(spark, sf_dir):
    """Cluster of each document by its TF-IDF row; no label is used."""
    return clustering.clusters(*_clustered(spark, sf_dir))


@query("top_terms_per_cluster")
def q_top_terms_per_cluster(spark, sf_dir):
    """Top 3 terms by mean weight of each of these clusters."""
    return text.top_terms(clustering.cluster_means(*_clustered(spark, sf_dir)), 3)


# --- sinks and cached / paged sources ---------------------------------------------------------------------

from partflow.session import scratch_path  # noqa: E402
from partflow.sources import sinks  # noqa: E402


@query("load_tree")
def q_load_tree(spark, sf_dir):
    """Save the exploded tree's last row of each name as CSV and load it back: as of the whole tree, the last row wins."""
    _, _, edges, roots = _bom(spark, sf_dir, False)
    path = sinks.save_tree(bom.dag_last_rows(edges, roots), scratch_path(spark, "tree-csv"))
    return sinks.load_tree(spark, path)


@query("write_size_sheets")
def q_write_size_sheets(spark, sf_dir):
    """Write the size sheets (one folder per MotorSize) and the materials sheet, read both back: ``sheet`` says which."""
    t = _t(spark, sf_dir)
    # both sheets come from the same demand: the sales and the open lines are read once
    demand, quarter = _forecast_inputs(t, True)
    forecast = reports.size_forecast(demand, quarter, PARAMS["statistic"])
    edges = materialize(bom.bom_edges(t.entity("materials")), "bom-edges")
    materials = _requirements(t, demand, edges, bom.bom_roots(demand))
    folder = sinks.write_size_sheets(forecast, materials, scratch_path(spark, "sheets"))
    sheets = sinks.read_size_sheets(spark, folder, forecast.drop("Category").schema)
    back = sinks.read_materials_sheet(spark, folder, materials.schema)
    return sheets.withColumn("sheet", F.lit("sizes")).unionByName(back.withColumn("sheet", F.lit("Materials")), allowMissingColumns=True)


@query("materialize_once")
def q_materialize_once(spark, sf_dir):
    t = _t(spark, sf_dir)
    flt = f"invoiceDate[gt]={PARAMS['sales_start']}"
    inv = entity.read_entity(t, "ar_invoices", orders.INVOICE_FIELDS, filter_string=flt)
    return entity.materialize_once(inv, "ar_invoices", key=f"{sf_dir}|{flt}", root=scratch_path(spark, "cache"))


@query("materialize_once_hit")
def q_materialize_once_hit(spark, sf_dir):
    """A second request with the same key: the written rows come back though the frame that asks has none."""
    t = _t(spark, sf_dir)
    flt, root = f"invoiceDate[gt]={PARAMS['sales_start']}", scratch_path(spark, "cache")
    inv = entity.read_entity(t, "ar_invoices", orders.INVOICE_FIELDS, filter_string=flt)
    entity.materialize_once(inv, "ar_invoices", key=f"{sf_dir}|{flt}", root=root)
    return entity.materialize_once(inv.where(F.lit(False)), "ar_invoices", key=f"{sf_dir}|{flt}", root=root)


@query("json_pages")
def q_json_pages(spark, sf_dir):
    """Events as page documents of 200 records, ``{"Data": [..]}``, decoded again."""
    ev = _t(spark, sf_dir).base("events").select("event_id", "event_type", "value")
    docs = (ev.groupBy(F.floor(F.col("event_id") / entity.PAGE_SIZE).alias("page"))
            .agg(F.to_json(F.struct(F.collect_list(F.struct(*ev.columns)).alias("Data"))).alias("body")))
    return entity.json_pages(docs, "body", ev.schema)
