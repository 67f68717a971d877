"""Storage layout for large entity tables: bucketed catalog tables in the shared folder.

Header and detail entities that are joined on the same key (invoices and
invoice details on invoiceNumber, orders and order lines on orderNumber) can
be written bucketed by that key with the same bucket count; Spark then joins
them bucket by bucket without shuffling either side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def save_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Write ``df`` as a table bucketed and sorted by ``keys`` (external when ``path`` is given)."""
    writer = df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


class CatalogEntities:
    """Entity source over catalog tables (``entity(name)`` -> ``spark.table(tables[name])``)."""

    def __init__(self, spark: SparkSession, tables: Mapping[str, str]):
        self.spark, self.tables = spark, dict(tables)

    def entity(self, name: str) -> DataFrame:
        return self.spark.table(self.tables.get(name, name))
