"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Only for a local master: on a cluster the executors must reach the driver by its own name.
_LOCAL = {"spark.driver.host": "127.0.0.1", "spark.driver.memory": "8g"}

# Settings that keep plans adaptive and results deterministic across engines.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Long sessions run many short jobs: let the context cleaner drop old shuffle files and
    # broadcasts regularly instead of waiting for a full GC of the driver heap.
    "spark.cleaner.periodicGC.interval": "5min",
}


def get_session(master: str | None = None, app: str = "partflow",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with partflow's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; tests pass
    ``local[*]`` and a small shuffle partition count.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS) | (_LOCAL if (master or "").startswith("local") else {})
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and written intermediate tables.

    Uses ``spark.checkpoint.dir`` from the session. Only a local-mode session
    without that setting (tests) gets a fresh temporary folder; a cluster
    session without it is an error, because a machine-local folder is not
    visible to other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="partflow-ckpt-")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/partflow-{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str = "table") -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    Cuts lineage for iterative jobs (one level of a bill-of-material loop per
    call) so that a lost executor only recomputes from the last written level.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables that :func:`materialize` wrote. Only for tables that nothing reads any more: what was made of them is written."""
    for df in tables:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.written_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """In here a job's shuffle files go when the job ends, not when the driver's heap is next collected."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def materialize_observed(df: DataFrame, tag: str = "table", **metrics: Column) -> tuple[DataFrame, dict]:
    """:func:`materialize` that also returns aggregate metrics gathered by the write job itself.

    ``rows`` (the row count) is always included. The metrics are collected with
    Spark's ``Observation`` during the write, so a loop learns whether a level
    is empty (or whether anything changed) without running another job.
    """
    spark = df.sparkSession
    obs = Observation(f"partflow_{tag}_{uuid.uuid4().hex[:8]}")
    exprs = [F.count(F.lit(1)).alias("rows")] + [c.alias(k) for k, c in metrics.items()]
    path = scratch_path(spark, tag)
    df.observe(obs, *exprs).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), dict(obs.get)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers unless they can import it anyway."""
    root = str(Path(__file__).resolve().parents[1])
    known = [os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    sc = spark.sparkContext
    if root in known or any("partflow-src" in f for f in sc.listFiles):
        return
    at = os.path.join(tempfile.mkdtemp(prefix="partflow-src-"), "partflow-src.zip")
    with zipfile.ZipFile(at, "w") as z:
        for p in sorted(Path(root, "partflow").rglob("*.py")):
            z.write(p, p.relative_to(root))
    sc.addPyFile(at)
