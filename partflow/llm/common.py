"""Shared helpers of the training-data operators: tables, key ranges, shared files, components."""

from __future__ import annotations

import os
import zipfile
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partflow.session import checkpoint_dir, materialize

# The white space of every word rule here: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file (installed on every machine, never copied)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers unless they can import it anyway."""
    root = str(Path(__file__).resolve().parents[2])
    known = [os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    sc = spark.sparkContext
    if root in known or any("partflow-src" in f for f in sc.listFiles):
        return
    at = os.path.join(tempfile.mkdtemp(prefix="partflow-src-"), "partflow-src.zip")
    with zipfile.ZipFile(at, "w") as z:
        for p in sorted(Path(root, "partflow").rglob("*.py")):
            z.write(p, p.relative_to(root))
    sc.addPyFile(at)


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/llm-{tag}-{uuid.uuid4().hex}"


def open_fs(uri: str):
    """(pyarrow file system, path) of a folder that every executor sees."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri[len("file:"):].lstrip("/")
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def range_cuts(df: DataFrame, key: str, n_ranges: int, per_range: int = 40) -> list[int]:
    """At most ``n_ranges - 1`` ascending cuts that split a whole-number key into even ranges.

    The cuts are quantiles of a sample of about ``per_range`` keys a range, chosen by
    the hash of the key: the same table always gives the same cuts, whatever the
    order of its rows. Only the sampled keys come to the driver; every row is dealt by
    the cuts.
    """
    if n_ranges < 2:
        return []
    n = df.count()
    step = max(1, n // (n_ranges * per_range))
    k = F.col(key).cast("long")
    got = sorted(r[0] for r in df.select(k.alias("k")).where(F.col("k").isNotNull())
                 .where(F.pmod(F.xxhash64("k"), F.lit(step)) == 0).distinct().collect())
    return sorted({got[i * len(got) // n_ranges] for i in range(1, n_ranges)}) if got else []


def range_of(key: Column, cuts: list[int]) -> Column:
    """Index of the key range: the number of cuts at or below the key (0 for null); binary search in the row."""
    if not cuts:
        return F.lit(0)
    arr = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")
    steps = [1 << b for b in reversed(range(len(cuts).bit_length()))]
    k = key.cast("long")
    # get() is null past the end, and a null comparison keeps the position
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0),
                       lambda at, s: F.when(F.get(arr, at + s - 1) <= k, at + s).otherwise(at))


def dealt(df: DataFrame, key: str, cuts: list[int], *then: Column) -> DataFrame:
    """Rows dealt by key range, one partition a range, each sorted by the key (nulls first) and ``then``."""
    return (df.withColumn("_range", range_of(F.col(key), cuts))
            .repartitionById(len(cuts) + 1, F.col("_range"))
            .sortWithinPartitions(F.col(key).asc_nulls_first(), *then))


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that is reachable over the links, for every node of a link.

    Alternating large-star and small-star rounds over written tables. A round costs
    a minimum per node (partly summed before the shuffle) and one join; the links stay
    as many as before or fewer. Both sides of the join are read from written tables, so
    adaptive execution may split a hub's rows.
    """
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    e = materialize(e, "links")

    def star(e: DataFrame, large: bool) -> DataFrame:
        """Link a node's larger (or smaller) neighbours, and itself, to its smallest neighbour."""
        if large:
            both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            both = e
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")), "least") if large else \
            both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("m", "u").alias("m"))
        near = both.join(least, "u")
        if large:
            out = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = (near.select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .union(least.select("u", F.col("m").alias("v"))))
        return out.where("u <> v").distinct()

    def mark(e: DataFrame):
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    before = mark(e)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        e = materialize(star(materialize(star(e, True), "large"), False), "small")
        now = mark(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"links did not settle in {max_rounds} rounds")
    return (e.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
            .union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
