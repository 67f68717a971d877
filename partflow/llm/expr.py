"""DataFrame expressions over whole texts that several native operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from partflow.llm.common import SPACE


def text_of(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text, in order: runs of anything but white space."""
    inner = F.btrim(text, F.lit(SPACE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[ \x09-\x0D]+"))
