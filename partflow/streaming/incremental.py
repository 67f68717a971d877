"""File-stream source, per-part running totals, bounded (availableNow) runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partflow.functions.semantics import sum_or_zero
from partflow.session import scratch_path


def stream_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None, name_glob: str | None = None) -> DataFrame:
    """New files in the folder ``path`` as a stream (schema declared, never inferred);
    ``name_glob`` keeps only matching file names."""
    reader = spark.readStream.schema(schema).format(fmt)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def part_totals_stream(stream: DataFrame, statistic: str, key: str = "partNumber") -> DataFrame:
    """Running sum of ``statistic`` per part (null parts dropped), as the batch ``sum_by_key``."""
    return stream.where(F.col(key).isNotNull()).groupBy(key).agg(sum_or_zero(statistic).alias(statistic))


def run_available_now(df: DataFrame, name: str, output_mode: str = "complete", checkpoint: str | None = None,
                      out: str | None = None) -> DataFrame:
    """Process everything available, then stop; state, offsets and results live in the shared folder.

    Each batch is written under its number, so a batch that is run again after a failure replaces itself. Returns the
    last batch (the whole state) for ``complete``, else all batches.
    """
    spark = df.sparkSession
    target = (out or scratch_path(spark, f"stream-out-{name}")).rstrip("/")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    q = (df.writeStream.outputMode(output_mode).foreachBatch(write).queryName(name)
         .option("checkpointLocation", checkpoint or scratch_path(spark, f"stream-{name}"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    rows = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("batch", T.LongType())])).parquet(target)
    if output_mode == "complete":
        rows = rows.where(F.col("batch") == rows.agg(F.max("batch")).first()[0])
    return rows.drop("batch")
