"""Column-level helpers: parsing, patterns, unit conversion."""

from __future__ import annotations

import datetime
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.functions.patterns import TIME_UNIT_DIVISORS


def parse_currency(c: Column) -> Column:
    """``$1,234.50`` -> 1234.5, ``12%`` -> 12.0 (no scaling); malformed text raises (ANSI)."""
    return F.regexp_replace(c.cast("string"), r"[$,%]", "").cast("double")


def iso_date(c: Column, coerce: bool = False) -> Column:
    """ISO date-time text cut at ``T`` -> DATE; ``coerce`` turns bad text into null."""
    head = F.split_part(c, F.lit("T"), F.lit(1))
    return F.try_to_date(head, "yyyy-MM-dd") if coerce else F.to_date(head, "yyyy-MM-dd")


def iso_timestamp(c: Column) -> Column:
    return F.to_timestamp(c)


def format_yy(d: Column) -> Column:
    return F.date_format(d, "yy-MM-dd")


def lead_days(finished: Column, entered: Column) -> Column:
    return F.datediff(finished, entered).cast("bigint")


def year_before(start: str) -> str:
    """The ISO date one year before an ISO date; 29 February becomes 28 February."""
    d = datetime.date.fromisoformat(start[:10])
    day = 28 if (d.month, d.day) == (2, 29) else d.day
    return d.replace(year=d.year - 1, day=day).isoformat()


def to_hours(value: Column, unit: Column) -> Column:
    """Minutes and seconds to hours, any other unit unchanged."""
    out = None
    for u, div in TIME_UNIT_DIVISORS.items():
        out = (F.when(unit == u, value / div) if out is None else out.when(unit == u, value / div))
    return out.otherwise(value)


def _alternation(items: Iterable[str] | str) -> str:
    return items if isinstance(items, str) else "|".join(re.escape(i) for i in items)


def matches(c: Column, pattern: str, case: bool = True) -> Column:
    """Regex search anywhere in the value (pandas ``str.contains``)."""
    return c.rlike(pattern if case else "(?i)" + pattern)


def exclude_pattern(df: DataFrame, col: str, pattern: str, case: bool = False) -> DataFrame:
    """Drop rows whose ``col`` contains ``pattern``; null values are kept."""
    return df.where(~F.coalesce(matches(F.col(col), pattern, case), F.lit(False)))


def include_pattern(df: DataFrame, col: str, pattern: str, case: bool = True) -> DataFrame:
    return df.where(matches(F.col(col), pattern, case))


def contains_any(c: Column, markers: Iterable[str]) -> Column:
    """Case-sensitive: the value contains any of the marker substrings."""
    return c.rlike(_alternation(markers))


def string_only(df: DataFrame, *cols: str) -> DataFrame:
    """Keep rows whose text columns hold a value (run before any fill)."""
    for c in cols:
        df = df.where(F.col(c).isNotNull())
    return df


def drop_nulls(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=list(subset) if subset else None)


def fill_zero(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Replace nulls by 0 in numeric columns only."""
    numeric = {f.name for f in df.schema.fields
               if f.dataType.typeName() in ("double", "float", "long", "integer", "short", "decimal")}
    targets = [c for c in (cols or df.columns) if c in numeric]
    return df.na.fill(0, subset=targets) if targets else df
