"""Sinks: size sheets, tree CSV save / load."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partflow.functions.patterns import TREE_CSV_HEADER, TREE_ROOT_PARENT
from partflow.sources.entity import CSV_EXACT

TREE_SCHEMA = T.StructType([
    T.StructField("Node", T.StringType()), T.StructField("Parent", T.StringType()),
    T.StructField("Depth", T.IntegerType()), T.StructField("Description", T.StringType()),
    T.StructField("Quantity", T.DoubleType()), T.StructField("ord", T.StringType()),
])


def write_size_sheets(forecast: DataFrame, materials: DataFrame | None, root: str,
                      today: _dt.date | None = None) -> str:
    """One CSV dataset per MotorSize (``MotorSize=<size>/``) plus a ``Materials`` dataset, committed together.

    Folder ``sizeForecasts_<yy-mm-dd>``; rows without a size are skipped,
    MotorSize and Category are not sheet columns. Both datasets go to a new folder of their own; a manifest
    that names it is renamed into place last, so readers see both datasets or neither, and while a day's
    sheets are written again, the earlier ones. Returns the folder of the day.
    """
    spark = forecast.sparkSession
    stamp = (today or _dt.date.today()).strftime("%y-%m-%d")
    out = f"{root.rstrip('/')}/sizeForecasts_{stamp}"
    part = f"part-{uuid.uuid4().hex}"
    sheets = forecast.where(F.col("MotorSize").isNotNull()).drop("Category")
    # a size's rows meet in few tasks (more for a large size), else every task would write a file per size
    sheets.hint("rebalance", "MotorSize").write.partitionBy("MotorSize").options(**CSV_EXACT).csv(f"{out}/{part}/sheets")
    if materials is not None:
        materials.write.options(**CSV_EXACT).csv(f"{out}/{part}/Materials")
    fs, path = _fs(spark, out)
    name = f"manifest-{max([0, *_versions(spark, out)]) + 1:09}"
    with_text = fs.create(path(f"{out}/_{part}"), False)
    with_text.writeBytes(part)
    with_text.close()
    if not fs.rename(path(f"{out}/_{part}"), path(f"{out}/{name}")):
        raise RuntimeError(f"{out}: another writer committed {name}")
    return out


def _fs(spark: SparkSession, folder: str):
    """The Hadoop file system of a folder and a maker of its paths."""
    jvm = spark._jvm
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)                    # noqa: E731
    return path(folder).getFileSystem(spark._jsc.hadoopConfiguration()), path


def _versions(spark: SparkSession, folder: str) -> list[int]:
    fs, path = _fs(spark, folder)
    if not fs.exists(path(folder)):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(path(folder))]
    return sorted(int(n.removeprefix("manifest-")) for n in names if n.startswith("manifest-"))


def _committed(spark: SparkSession, folder: str) -> str:
    """The folder that the last manifest names."""
    versions = _versions(spark, folder)
    if not versions:
        raise FileNotFoundError(f"{folder} has no committed sheets")
    name = spark.read.text(f"{folder}/manifest-{versions[-1]:09}").first()[0]
    return f"{folder}/{name}"


def read_size_sheets(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Read the committed sheets back; ``schema`` must include MotorSize as a string (no type inference)."""
    return spark.read.schema(schema).options(**CSV_EXACT).csv(f"{_committed(spark, folder)}/sheets")


def read_materials_sheet(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_EXACT).csv(f"{_committed(spark, folder)}/Materials")


def save_tree(rows: DataFrame, path: str) -> str:
    """Tree node table -> CSV with header Node, Parent, Depth, Description, Quantity (+ ord)."""
    rows.select(*TREE_CSV_HEADER, "ord").write.mode("overwrite").options(**CSV_EXACT).csv(path)
    return path


def load_tree(spark: SparkSession, path: str, check_parents: bool = True) -> DataFrame:
    """CSV -> node table keyed by name: (Node, Parent, Description, Quantity, ord).

    As in the reference the reload is lossy: a repeated name keeps the
    attributes and parent of its **last** row (by the saved preorder key).
    Depth is ignored. A parent that is not a node raises.
    """
    rows = spark.read.schema(TREE_SCHEMA).options(**CSV_EXACT).csv(path)
    last = rows.groupBy("Node").agg(
        F.max_by(F.struct("Parent", "Description", "Quantity", "ord"), F.col("ord")).alias("__l"))
    nodes = last.select("Node", "__l.Parent", "__l.Description", "__l.Quantity", "__l.ord")
    if check_parents:
        orphans = (nodes.where(F.col("Parent") != TREE_ROOT_PARENT)
                   .join(nodes.select(F.col("Node").alias("Parent")), "Parent", "left_anti").take(1))
        if orphans:
            raise KeyError(f"unknown parent {orphans[0]['Parent']!r}")
    return nodes
