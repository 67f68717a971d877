"""The report bundle of one sales table (the reference's breakdown of plots, as tables)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.functions.patterns import BASELINE_GROUP, GROUP_NAMES
from partflow.functions.semantics import sum_or_zero
from partflow.operators import reports
from partflow.session import materialize


def sales_base(df: DataFrame, statistic: str) -> DataFrame:
    """Sums of the report rows by size, category and customer, written: what every table of the bundle is made of.

    One scan of the sales and one aggregation that combines before its shuffle; the base has a row per
    combination, nulls included, however many sales there are.
    """
    base = reports.report_rows(df).groupBy("MotorSize", "Category", "customerCode").agg(sum_or_zero(statistic).alias(statistic))
    return materialize(base, "sales-base")


def breakdown(df: DataFrame, statistic: str, category: str = "Inner Race",
              match: str = "substring", groups: Sequence[str] = GROUP_NAMES,
              baseline: str = BASELINE_GROUP) -> dict[str, DataFrame]:
    """All report tables of a cleaned sales table with Category, MotorSize, customerCode.

    Customer groups and the baseline among them are the caller's. Returns DataFrames keyed like the registered
    queries. The sales are read once (:func:`sales_base`); the margins are the grouping sets of the cells (a cube), the
    ratios and the group averages are written since several tables follow from them. ``share_of_total`` is included only when the statistic name contains ``Total`` (as in the reference).
    """
    base = sales_base(df, statistic)
    cells = reports.size_category_pivot(base, statistic)
    ratios = materialize(reports.customer_ratio(base, statistic, match=match), "ratios")
    avgs = materialize(reports.group_averages(ratios, groups), "group-avgs")
    values = avgs.where(F.col("Category") == category)
    out = {
        "size_category_pivot": cells,
        "with_margins": reports.with_margins(cells, statistic),
        "mandrel_ratio": reports.mandrel_ratio(base, statistic),
        "customer_ratio": ratios,
        "group_averages": avgs,
        "relative_to_baseline": reports.relative_to_baseline(avgs, baseline),
        "histogram": reports.histogram(values, "ratio"),
        "kde_curve": reports.kde_curve(values, "ratio"),
    }
    if "Total" in statistic:
        out["share_of_total"] = reports.share_of_total(base, statistic)
    return out


def long_form(tables: dict[str, DataFrame], statistic: str, digits: int = 6) -> DataFrame:
    """The bundle as one table (report, label, customer, Category, value, low, high): a row per cell of each report.

    ``label`` is the size, the customer code, the group, the bin or the point; ``low`` and ``high`` hold a bin's edges, ``low``
    the place of a point. The colour layer of the margins is left to ``with_margins`` itself.
    """
    shape: dict[str, tuple[str, str | None, str | None, str, str | None, str | None]] = {
        "size_category_pivot": ("MotorSize", None, "Category", statistic, None, None),
        "with_margins": ("MotorSize", None, "Category", statistic, None, None),
        "share_of_total": ("MotorSize", None, "Category", "share", None, None),
        "mandrel_ratio": ("MotorSize", None, "Category", "ratio", None, None),
        "customer_ratio": ("customerCode", "customer", "Category", "ratio", None, None),
        "group_averages": ("label", "customer", "Category", "ratio", None, None),
        "relative_to_baseline": ("label", "customer", "Category", "relative", None, None),
        "histogram": ("bin", None, None, "count", "lower", "upper"),
        "kde_curve": ("point", None, None, "density", "x", None),
    }

    def cell(c: str | None, kind: str) -> Column:
        value = F.lit(None).cast(kind) if c is None else F.col(c).cast(kind)
        return F.round(value, digits) if kind == "double" else value

    out = None
    for name, df in tables.items():
        label, customer, category, *numbers = shape[name]
        rows = df.select(F.lit(name).alias("report"), cell(label, "string").alias("label"), cell(customer, "string").alias("customer"),
                         cell(category, "string").alias("Category"),
                         *[cell(c, "double").alias(k) for c, k in zip(numbers, ("value", "low", "high"))])
        out = rows if out is None else out.unionByName(rows)
    return out
