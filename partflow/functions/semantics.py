"""pandas-compatible semantics expressed with Spark columns.

The reference's tables follow pandas rules (null keys match in merges, "first"
skips nulls, x/0 gives inf). These helpers give the same answers while staying
inside Catalyst: null-safe equi-joins, ``min_by`` with an explicit order, and
division guarded by ``when``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def merge(left: DataFrame, right: DataFrame, on, how: str = "inner",
          suffixes: Sequence[str] = ("_x", "_y"), null_safe: bool = True) -> DataFrame:
    """pandas ``merge``: null keys match null keys, clashing columns get suffixes.

    Keys are compared with ``<=>`` which Catalyst still plans as an equi-join
    (hash partitioned, broadcast when AQE sees a small side). The key columns
    appear once, coalesced from both sides for right/outer joins; column order
    is left columns, then the right side's non-key columns.

    ``null_safe=False`` compares with ``=``: use it for keys that are never null
    (primary keys). Spark plans ``<=>`` on ``(coalesce(k, 0), isnull(k))``, which
    defeats bucketed co-location; ``=`` on tables bucketed by the key joins
    without any exchange.
    """
    keys = _as_list(on)
    lsuf, rsuf = suffixes
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    lcols = [c + lsuf if c in clash else c for c in left.columns]
    rkeys = {k: f"__rkey_{i}" for i, k in enumerate(keys)}
    rcols = [rkeys[c] if c in rkeys else (c + rsuf if c in clash else c) for c in right.columns]
    l2 = left.toDF(*lcols)
    r2 = right.toDF(*rcols)
    eq = (lambda a, b: a.eqNullSafe(b)) if null_safe else (lambda a, b: a == b)
    cond = reduce(lambda a, b: a & b, [eq(l2[k], r2[rkeys[k]]) for k in keys])
    joined = l2.join(r2, cond, how)
    out = []
    for c in lcols:
        if c in rkeys and how in ("right", "right_outer", "outer", "full", "full_outer"):
            out.append(F.coalesce(l2[c], r2[rkeys[c]]).alias(c))
        else:
            out.append(l2[c])
    out += [r2[c] for c in rcols if c not in rkeys.values()]
    return joined.select(*out)


def first_non_null(c: str, order: Column) -> Column:
    """pandas ``'first'``: value of the first row (by ``order``) where ``c`` is not null."""
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order))


def sum_or_zero(c: str) -> Column:
    """pandas ``sum``: an all-null group sums to 0."""
    return F.coalesce(F.sum(c), F.lit(0.0))


def ratio_or_zero(num: Column, den: Column) -> Column:
    """x/0 and 0/0 become 0 (pandas ``replace([inf,-inf],0).fillna(0)`` after division)."""
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


def ieee_ratio(num: Column, den: Column) -> Column:
    """IEEE division: x/0 = +-inf, 0/0 = NaN; null stays null (ANSI-safe)."""
    return (F.when(num.isNull() | den.isNull(), F.lit(None).cast("double"))
            .when(F.isnan(num) | F.isnan(den), F.lit(float("nan")))
            .when(den != 0, num / den)
            .when(num > 0, F.lit(float("inf")))
            .when(num < 0, F.lit(float("-inf")))
            .otherwise(F.lit(float("nan"))))


def not_equal_keep_null(c: Column, value) -> Column:
    """pandas ``x != v`` is true for a null x; Spark's is null."""
    return ~c.eqNullSafe(F.lit(value))


def row_order(*cols: str) -> Column:
    """An explicit row order for order-dependent aggregates (struct compares field-wise)."""
    return F.struct(*[F.col(c) for c in cols])


def with_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row table (a global aggregate) to every row.

    A global aggregate has exactly one row, so broadcasting it is size-safe;
    unlike a scalar subquery referenced in many expressions, its input plan
    is analysed once.
    """
    one = F.lit(1).alias("__one")
    return df.select("*", one).join(F.broadcast(one_row.select("*", one)), "__one").drop("__one")


def union_rows(*frames: DataFrame) -> DataFrame:
    """Concatenate batches / pages by column name (bag semantics, no dedupe)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_missing(*frames: DataFrame) -> DataFrame:
    """Row-append where missing columns become null (pandas ``concat``)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
