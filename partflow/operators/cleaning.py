"""Sales cleaning (nulls, house accounts, exclusion lists, parsing)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.functions.patterns import DESCRIPTION_EXCLUDE, HOUSE_PATTERN, PART_EXCLUDE
from partflow.functions.scalar import exclude_pattern, fill_zero, iso_date, parse_currency, string_only


def clean_sales(df: DataFrame, statistic: str, datestat: str, include_stock: bool = False,
                house_pattern: str = HOUSE_PATTERN) -> DataFrame:
    """Drop undated rows, rows without part text, house accounts (unless stock is
    included) and excluded parts; parse the statistic and the date.

    A null customer is kept (not a house account). Only numeric nulls are filled
    with 0; text nulls stay null. Dates that do not parse become null and stay.
    """
    df = df.where(F.col(datestat).isNotNull())
    df = string_only(df, "partNumber", "partDescription")
    if not include_stock:
        df = df.where(~F.coalesce(F.col("customerCode").contains(house_pattern), F.lit(False)))
    df = exclude_pattern(df, "partDescription", DESCRIPTION_EXCLUDE, case=False)
    df = exclude_pattern(df, "partNumber", PART_EXCLUDE, case=False)
    df = df.withColumn(statistic, parse_currency(F.col(statistic)))
    df = df.withColumn(datestat, iso_date(F.col(datestat), coerce=True))
    return fill_zero(df)
