"""Report tables: per-part sums, size x category pivots, ratios to Mandrels,
group averages, histogram, KDE, top parts.

Pivots are kept in **long** form ``(row key, Category, value)``: a missing cell
means "no value" (pandas NaN), a present cell may be 0. :func:`to_wide` turns a
long table into the reference's wide layout at the edge, with the column list
passed explicitly so Spark does not need an extra job to discover it.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.functions.patterns import (BASELINE_GROUP, DENOMINATOR_CATEGORY, EXCLUDED_CATEGORY,
                                         GROUP_NAMES, RELATIVE_DROP_CATEGORIES)
from partflow.functions.semantics import (first_non_null, ieee_ratio, merge, ratio_or_zero, row_order,
                                          sum_or_zero, with_one_row as _with_stats)
from partflow.session import materialize


# --- per-part aggregates ---------------------------------------------------------------------------

def aggregate_by_part(df: DataFrame, statistic: str, order_by: Sequence[str] | Column) -> DataFrame:
    """Sum ``statistic`` per part; every other column takes its first non-null value.

    "First" needs a row order, so the caller names it (``order_by``). Null parts
    are dropped; the statistic becomes the last column. ``min_by`` is a
    combinable aggregate, so a hot part is reduced map-side before the shuffle.
    """
    order = order_by if isinstance(order_by, Column) else row_order(*order_by)
    others = [c for c in df.columns if c not in (statistic, "partNumber")]
    d = df.where(F.col("partNumber").isNotNull()).withColumn("__ord", order)
    aggs = {c: first_non_null(c, F.col("__ord")).alias(c) for c in others}
    aggs[statistic] = sum_or_zero(statistic).alias(statistic)
    out = d.groupBy("partNumber").agg(*aggs.values())
    cols = [c for c in df.columns if c != statistic] + [statistic]
    return out.select(*cols)


def sum_by_key(df: DataFrame, key: str, value: str, alias: str | None = None) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(sum_or_zero(value).alias(alias or value))


def sum_first_by_key(df: DataFrame, key: str, value: str, first: str, order_by: Sequence[str]) -> DataFrame:
    return (df.where(F.col(key).isNotNull()).withColumn("__ord", row_order(*order_by)).groupBy(key)
            .agg(sum_or_zero(value).alias(value), first_non_null(first, F.col("__ord")).alias(first)))


def top_parts(df: DataFrame, statistic: str, n: int = 10, part_col: str = "partNumber") -> DataFrame:
    """Top-``n`` parts by summed statistic; ties broken by part number (a top-k, not a full sort)."""
    sums = df.where(F.col(part_col).isNotNull()).groupBy(part_col).agg(sum_or_zero(statistic).alias(statistic))
    return sums.orderBy(F.col(statistic).desc(), F.col(part_col).asc()).limit(n)


def value_range(df: DataFrame, statistic: str) -> DataFrame:
    return df.agg(F.min(statistic).alias("min_value"), F.max(statistic).alias("max_value"))


# --- size x category ---------------------------------------------------------------------------------

def report_rows(df: DataFrame) -> DataFrame:
    """Rows that enter every pivot: a Category that does not contain ``none`` (any case)."""
    return df.where(F.col("Category").isNotNull()
                    & ~F.lower(F.col("Category")).contains(EXCLUDED_CATEGORY.lower()))


def size_category_pivot(df: DataFrame, statistic: str, rows: str = "MotorSize") -> DataFrame:
    """Long pivot: sum of ``statistic`` per (rows, Category); null row keys dropped."""
    d = report_rows(df).where(F.col(rows).isNotNull())
    return d.groupBy(rows, "Category").agg(sum_or_zero(statistic).alias(statistic))


def to_wide(long_df: DataFrame, rows: str, value: str, columns: Iterable[str] | None = None,
            fill: float | None = 0.0) -> DataFrame:
    """Long ``(rows, Category, value)`` -> one column per category (``fill`` for holes)."""
    if columns is None:
        # Category lists are small report dimensions; reading them is a tiny aggregate.
        columns = sorted(r[0] for r in long_df.select("Category").distinct().collect())
    wide = long_df.groupBy(rows).pivot("Category", list(columns)).agg(F.first(value))
    return wide.na.fill(fill) if fill is not None else wide


def share_of_total(df: DataFrame, statistic: str, rows: str = "MotorSize") -> DataFrame:
    """Pivot cells as percent of the total over all report rows (null sizes included)."""
    d = report_rows(df)
    total = d.select(F.sum(statistic)).scalar()
    cells = size_category_pivot(df, statistic, rows)
    return cells.select(rows, "Category", ieee_ratio(F.col(statistic) * 100.0, total).alias("share"))


def with_margins(cells: DataFrame, value: str, rows: str = "MotorSize",
                 row_total: str = "Category Sum", col_total: str = "Size Sum") -> DataFrame:
    """Add the column-sum row, the row-sum column and their corner (grand total).

    One ``cube`` over the long cells. ``color_value`` is the heat-map layer:
    the value for cells, 0 for the margins. Nothing is returned when every
    cell is 0.
    """
    cube = cells.cube(rows, "Category").agg(
        F.sum(value).alias(value), F.grouping(rows).alias("__gr"), F.grouping("Category").alias("__gc"))
    out = cube.select(
        F.when(F.col("__gr") == 1, F.lit(row_total)).otherwise(F.col(rows)).alias(rows),
        F.when(F.col("__gc") == 1, F.lit(col_total)).otherwise(F.col("Category")).alias("Category"),
        F.col(value),
        F.when((F.col("__gr") == 1) | (F.col("__gc") == 1), F.lit(0.0)).otherwise(F.col(value)).alias("color_value"))
    nonzero = cells.select(F.count_if((F.col(value) != 0) | F.isnan(F.col(value)))).scalar()
    return out.where(nonzero > 0)


# --- ratios to Mandrels --------------------------------------------------------------------------------

def mandrel_customers(df: DataFrame) -> DataFrame:
    """Report rows of customers (null included) that bought anything in a *Mandrels* category."""
    d = report_rows(df)
    buyers = d.where(F.col("Category").contains(DENOMINATOR_CATEGORY)).select("customerCode").distinct()
    return d.join(buyers.toDF("__c"), d["customerCode"].eqNullSafe(F.col("__c")), "left_semi")


def mandrel_ratio(df: DataFrame, statistic: str, rows: str = "MotorSize") -> DataFrame:
    """Per size: category sum / Mandrels sum of Mandrel customers; x/0 and 0/0 give 0.

    Where the reference raises because no Mandrels column exists at all, every
    ratio here is 0.
    """
    cells = size_category_pivot(mandrel_customers(df), statistic, rows)
    den = cells.where(F.col("Category") == DENOMINATOR_CATEGORY).select(rows, F.col(statistic).alias("__den"))
    num = cells.where(F.col("Category") != DENOMINATOR_CATEGORY)
    return num.join(den, rows, "left").select(
        rows, "Category", ratio_or_zero(F.col(statistic), F.col("__den")).alias("ratio"))


def substring_pairs(codes: DataFrame, col: str = "customerCode", size: int = 3) -> DataFrame:
    """All (customer, customerCode) with ``customerCode`` containing ``customer``.

    An inverted index has the distinct pieces of 1 to ``size`` characters of each code (and the empty one): at most
    ``size`` times its length. A code is looked up by one piece only, the one of its pieces of the greatest size that the fewest
    codes have; what the index gives is then verified. Joins are equi-joins on the piece, which adaptive execution
    can split where many codes share one.
    """
    c = codes.select(F.col(col).alias("__r")).where(F.col("__r").isNotNull()).distinct()
    n = F.length("__r")

    def pieces(k: int) -> Column:
        """The pieces of ``k`` characters; none if the code is shorter."""
        starts = F.when(n >= k, F.sequence(F.lit(1), n - k + 1)).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(starts, lambda i: F.col("__r").substr(i, F.lit(k))))

    every = F.concat(F.array(F.lit("")), *[pieces(k) for k in range(1, size + 1)])
    index = materialize(c.select("__r", F.explode(every).alias("__p")), "pieces")
    own = index.where(F.length("__p") == F.least(n, F.lit(size))).withColumnRenamed("__r", "customer")
    counts = index.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    probe = own.join(counts, "__p").groupBy("customer").agg(F.min_by("__p", F.struct("__n", "__p")).alias("__p"))
    return index.join(probe, "__p").where(F.contains("__r", "customer")).select("customer", F.col("__r").alias(col))


def customer_ratio(df: DataFrame, statistic: str, match: str = "substring") -> DataFrame:
    """Long table (customer, customerCode, Category, ratio).

    For each customer *i* with a positive own Mandrels sum, every customer
    code *r* that contains *i* (``match='substring'``, the reference's rule) or
    equals it (``'exact'``) yields its category sums divided by *i*'s Mandrels
    sum. A category bought by some code matching *i* but not by *r* is 0; one
    bought by none is absent (null). Mandrels itself is not reported.
    """
    d = report_rows(df).where(F.col("customerCode").isNotNull())
    # (customer, category) sums are read four times below: write them once instead of
    # re-scanning the sales for every use.
    sums = materialize(d.groupBy("customerCode", "Category").agg(sum_or_zero(statistic).alias("__v")), "cust-sums")
    codes = sums.select("customerCode").distinct()
    if match == "substring":
        pairs = substring_pairs(codes)
    else:
        pairs = codes.select(F.col("customerCode").alias("customer"), "customerCode")
    den = (sums.where(F.col("Category") == DENOMINATOR_CATEGORY)
           .select(F.col("customerCode").alias("customer"), F.col("__v").alias("__den"))
           .where(F.col("__den") > 0))
    pairs = pairs.join(den, "customer")
    cats = pairs.join(sums, "customerCode").select("customer", "Category").distinct()
    cells = pairs.join(cats, "customer").where(F.col("Category") != DENOMINATOR_CATEGORY)
    cells = cells.join(sums, ["customerCode", "Category"], "left")
    return cells.select("customer", "customerCode", "Category",
                        (F.coalesce(F.col("__v"), F.lit(0.0)) / F.col("__den")).alias("ratio"))


def group_averages(ratios: DataFrame, groups: Sequence[str] = GROUP_NAMES,
                   label: str = "customerCode", value: str = "ratio") -> DataFrame:
    """Rows whose label contains a group name (any case) are replaced by one mean row per group.

    Output (label, customer, Category, ratio); a label in two groups counts in
    both; means skip missing cells.
    """
    member = F.filter(F.array(*[F.lit(g) for g in groups]),
                      lambda g: F.lower(F.col(label)).contains(F.lower(g)))
    tagged = ratios.withColumn("__groups", member)
    rest = tagged.where(F.size("__groups") == 0).select(
        F.col(label).alias("label"), "customer", "Category", F.col(value).alias(value))
    means = (tagged.select(F.explode("__groups").alias("label"), "Category", value)
             .groupBy("label", "Category").agg(F.avg(value).alias(value))
             .where(F.col(value).isNotNull())
             .select("label", F.lit(None).cast("string").alias("customer"), "Category", value))
    return rest.unionByName(means)


def relative_to_baseline(avgs: DataFrame, baseline: str = BASELINE_GROUP,
                         drop_categories: Sequence[str] = RELATIVE_DROP_CATEGORIES,
                         value: str = "ratio") -> DataFrame:
    """Every row divided by the baseline group's row (IEEE: x/0 = inf, 0/0 = NaN).

    The input is written once (it is read for the rows and for the baseline);
    the baseline has one row per category and is joined by hash.
    """
    avgs = materialize(avgs, "group-avgs")
    base = avgs.where(F.col("label") == baseline).select("Category", F.col(value).alias("__b"))
    rows = avgs.where(~F.col("label").eqNullSafe(F.lit(baseline)))
    rows = rows.where(~F.col("Category").isin(list(drop_categories)))
    return rows.join(base, "Category").select(
        "label", "customer", "Category", ieee_ratio(F.col(value), F.col("__b")).alias("relative"))


# --- forecast sheet -------------------------------------------------------------------------------------

def size_forecast(demand: DataFrame, quarter: DataFrame, statistic: str) -> DataFrame:
    """Per-part sheet rows: 12-month and 3-month shipments, in-process, inventory, open orders."""
    q = quarter.select("partNumber", F.col(statistic).alias(f"{statistic}_quarter"))
    x = merge(demand, q, "partNumber", "left")
    num = [statistic, f"{statistic}_quarter", "quantityToMake", "quantityOnHand", "openCustomerOrders"]
    x = x.na.fill(0.0, subset=num)
    return x.where(F.col("Category").isNotNull()).select(
        "partNumber", "partDescription",
        F.col(statistic).alias("Shipped 12Mo"), F.col(f"{statistic}_quarter").alias("Shipped 3Mo"),
        F.col("quantityToMake").alias("InProcess"), F.col("quantityOnHand").alias("Inventory"),
        "MotorSize", "Category", "openCustomerOrders",
        (F.col("quantityOnHand") + F.col("quantityToMake")).alias("Inventory+InProcess"))


# --- distribution -------------------------------------------------------------------------------------------

def _value_stats(v: DataFrame) -> DataFrame:
    s = v.agg(F.count("v").alias("__n"), F.stddev_samp("v").alias("__sd"),
              F.min("v").alias("__min"), F.max("v").alias("__max"))
    same = F.col("__min") == F.col("__max")
    return s.select("*", F.when(same, F.col("__min") - 0.5).otherwise(F.col("__min")).alias("__lo"),
                    F.when(same, F.col("__max") + 0.5).otherwise(F.col("__max")).alias("__hi"))


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width bins between min and max (last bin closed; min = max gives +-0.5).

    Output (bin, lower, upper, count) for every bin, empty ones included.
    """
    v = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    v = materialize(v, "hist-values")  # read for the range and for the counts
    stats = _value_stats(v)
    lo, hi = F.col("__lo"), F.col("__hi")
    b = F.least(F.floor((F.col("v") - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("bigint")
    counts = _with_stats(v, stats).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = _with_stats(df.sparkSession.range(bins).withColumnRenamed("id", "bin"), stats)
    width = (hi - lo) / bins
    return (grid.join(counts, "bin", "left")
            .select("bin", (lo + F.col("bin") * width).alias("lower"),
                    (lo + (F.col("bin") + 1) * width).alias("upper"),
                    F.coalesce(F.col("count"), F.lit(0)).alias("count")))


# He_0 .. He_9 of the series exp(t s - s^2 / 2) = sum He_j(t) s^j / j!, as coefficients of 1, t, t^2 ...
ORDER = 9


def _hermite(order: int = ORDER) -> list[list[int]]:
    out = [[1], [0, 1]]
    for j in range(1, order):
        up, down = [0, *out[j]], out[j - 1]
        out.append([x - j * (down[k] if k < len(down) else 0) for k, x in enumerate(up)])
    return out


def kde_curve(df: DataFrame, col: str, gridsize: int = 200, bins: int = 20, cut: float = 0.0, exact: bool = False) -> DataFrame:
    """Gaussian KDE (Scott bandwidth n^-1/5 * sd) on ``gridsize`` points, scaled to histogram counts.

    Values are summed into cells a quarter of the bandwidth wide, each with its count and the sums of the first nine
    powers of the distances from its middle; a cell then gives every point the series of the kernel around the middle. The
    series is broken off below 3e-13 of a kernel's height for each value (a distance is an eighth of the bandwidth at most), and a cell
    leaves out points more than nine bandwidths away (3e-18). So the rows that are made depend on the range of
    the values in bandwidths and not on their number. ``exact`` takes the kernel of each distinct value instead. No
    curve (no rows) without a bandwidth: fewer than two values, or all equal.
    """
    v = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    v = materialize(v, "kde-values")  # read for the statistics and for the curve
    stats = _value_stats(v)
    stats = stats.select("*", (F.col("__sd") * F.pow(F.col("__n").cast("double"), F.lit(-0.2))).alias("__bw"))
    bw = F.col("__bw")
    g0 = F.col("__min") - bw * cut
    step = ((F.col("__max") + bw * cut) - g0) / (gridsize - 1)
    keep = ["__min", "__max", "__bw"]
    if exact:
        cells = v.groupBy("v").agg(F.count(F.lit(1)).cast("double").alias("__m0"))
        cells = _with_stats(cells, stats).where(bw > 0).select(*keep, F.col("v").alias("__mid"), "__m0")
        order = 0
    else:
        cell = F.floor((F.col("v") - F.col("__min")) / bw * 4)
        mid = F.col("__min") + (cell + 0.5) * bw / 4
        rows = _with_stats(v, stats).where(bw > 0).select(*keep, mid.alias("__mid"), ((F.col("v") - mid) / bw).alias("__s"))
        cells = rows.groupBy(*keep, "__mid").agg(*[F.sum(F.pow("__s", F.lit(j)) if j else F.lit(1.0)).alias(f"__m{j}") for j in range(ORDER + 1)])
        order = ORDER
    pts = cells.select("*", F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("point"))
    pts = pts.withColumn("x", g0 + F.col("point") * step).withColumn("__t", (F.col("x") - F.col("__mid")) / bw)
    t = F.col("__t")
    if not exact:
        # the point next to the cell keeps it, so that no point is without rows
        pts = pts.where((F.abs(t) <= 9) | (F.abs(t) * bw <= step))
    series = F.lit(0.0)
    for j, coefficients in enumerate(_hermite()[:order + 1]):
        poly = F.lit(0.0)
        for a in reversed(coefficients):
            poly = poly * t + float(a)
        series = series + F.col(f"__m{j}") * poly / float(math.factorial(j))
    dens = F.exp(-0.5 * t * t) * series / (bw * math.sqrt(2 * math.pi))
    binw = (F.col("__max") - F.col("__min")) / bins
    sums = pts.groupBy("point", "x", binw.alias("__binw")).agg(F.sum(dens).alias("__d"))
    out = sums.select(F.col("point").cast("bigint").alias("point"), "x", (F.col("__d") * F.col("__binw")).alias("density"))
    if exact:
        return out
    # points that no cell is near: the curve is 0 there
    grid = _with_stats(df.sparkSession.range(gridsize).withColumnRenamed("id", "point"), stats).where(bw > 0)
    grid = grid.select("point", (g0 + F.col("point") * step).alias("x"))
    return grid.join(out.drop("x"), "point", "left").select("point", "x", F.coalesce("density", F.lit(0.0)).alias("density"))
