"""Session helpers: one place for the settings a job needs.

On a cluster the session already exists and names its shared checkpoint
folder in ``spark.checkpoint.dir``; the helpers read it from there and only
set a local one when it is unset (tests, bench on one machine).
"""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "foldframe") -> SparkSession:
    """Build (or fetch) a session with the engine's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("FOLDFRAME_DRIVER_MEMORY", "16g"))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder for lineage cuts, as the session names it."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's checkpoint folder; where none is set, a scratch one in local mode and an error on a cluster."""
    d = checkpoint_dir(spark)
    if not d:
        master = spark.sparkContext.master
        if master.split("[")[0] != "local":
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors share (master {master})")
        d = tempfile.mkdtemp(prefix="foldframe-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local on a cluster)."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    _SCRATCH.append(f"{base}/{name}-{uuid.uuid4().hex[:12]}")
    return _SCRATCH[-1]


def release_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders that this process made, and say how many. Results that still read them must have been
    stored before: DataFrames are evaluated late."""
    gone = 0
    while _SCRATCH:
        path = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        gone += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return gone


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``foldframe`` importable in the Python workers (``addPyFile`` of a zip of the package).

    Arrow/pandas slots pickle functions by module reference, so executors must be able to import
    the package; this is the standard way to ship code with a job."""
    import os
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="foldframe-code-"), "foldframe.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(key)
