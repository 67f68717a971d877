"""Top-n per group that stays parallel when one group holds most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
                    salt_col: str | None = None, buckets: int = 64) -> DataFrame:
    """Rows ranked 1..n within each group by ``order`` (a total order), with column ``rank``.

    Two phases: rank inside (group, hash bucket) first, keep n per bucket, then
    rank the at most ``buckets * n`` survivors per group. Exact, because the
    global top n of a group are each in the top n of their bucket.
    """
    g = [F.col(c) for c in group]
    if salt_col is not None:
        salted = df.withColumn("__salt", F.pmod(F.xxhash64(F.col(salt_col)), F.lit(buckets)))
        w1 = Window.partitionBy(*g, F.col("__salt")).orderBy(*order)
        df = salted.withColumn("__r", F.row_number().over(w1)).where(F.col("__r") <= n).drop("__r", "__salt")
    w2 = Window.partitionBy(*g).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= n)
