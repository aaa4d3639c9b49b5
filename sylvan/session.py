"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "sylvan",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session with AQE on and the UI off (no server is opened).

    Under ``spark-submit`` the submitted master and partition count hold;
    otherwise a local session with ``$BENCH_CPUS`` threads is built.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master or "PYSPARK_GATEWAY_PORT" not in os.environ:
        cpus = os.environ.get("BENCH_CPUS", "8")
        shuffle_partitions = shuffle_partitions or max(8, 2 * int(cpus))
        builder = builder.master(master or f"local[{cpus}]").config(
            "spark.driver.memory", os.environ.get("SYLVAN_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.master.split("[")[0] == "local":
        ensure_checkpoint_dir(spark)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per context: their Python
    workers import it wherever they run."""
    sc = spark.sparkContext
    if getattr(sc, "_sylvan_shipped", False):
        return
    root = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="sylvan-code-")) / "sylvan.zip"     # served by the driver
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"sylvan/{f.relative_to(root)}")
    sc.addPyFile(str(target))
    sc._sylvan_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` (or a directory already set on the context)
    wins.  Where nothing is configured, a session on this machine alone
    (tests, local runs) gets a private temporary folder; on a cluster,
    whose executors could not see it, this raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="sylvan-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/sylvan-scratch/{name}-{uuid.uuid4().hex[:12]}"
