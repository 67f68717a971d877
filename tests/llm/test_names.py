"""Extra columns whose names the operators use inside come back as they were."""

import pytest
from pyspark.sql import functions as F

from partflow.llm import fuzzy_lines, piece, simhash
from partflow.llm.common import ship


def test_extra_columns_keep_their_names_and_values(spark):
    ship(spark)
    text = "a line of seven words comes here twice"
    extra = ["removed", "doc", "th", "_th", "_l", "stays", "group", "component_id"]
    rows = [(k, f"{text}\nand a text of its own number {k} {k} {k}", *[f"{c}{k}" for c in extra]) for k in range(3)] + [(7, None, *extra)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in extra))
    for out in (fuzzy_lines.dedup_lines(df).drop("n_lines", "n_removed"), simhash.one_of_each(df)):
        assert out.columns == df.columns
        kept = {r.doc_id: tuple(r)[2:] for r in out.collect()}
        assert kept and all(v == rows[3 if k == 7 else k][2:] for k, v in kept.items())
    with pytest.raises(ValueError):
        piece.decode(df.withColumn("ids", F.lit(b"")).withColumn("decoded", F.lit(1)), "unused")
