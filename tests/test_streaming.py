import os

import pytest
from pyspark.sql import functions as F

from partflow.operators import reports
from partflow.streaming import part_totals_stream, run_available_now, stream_files

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_stream_totals_equal_batch(spark):
    batch = spark.read.parquet(f"{SF}/lineitem.parquet").select(
        F.col("l_partkey").cast("string").alias("partNumber"), F.col("l_quantity").alias("q"))
    src = stream_files(spark, SF, spark.read.parquet(f"{SF}/lineitem.parquet").schema, name_glob="lineitem.parquet")
    stream = src.select(F.col("l_partkey").cast("string").alias("partNumber"), F.col("l_quantity").alias("q"))
    got = {r[0]: r[1] for r in run_available_now(part_totals_stream(stream, "q"), "part_totals_test").collect()}
    want = {r[0]: r[1] for r in reports.sum_by_key(batch, "partNumber", "q").collect()}
    assert got == want
