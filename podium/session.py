"""Session and shared-folder helpers.

The library never creates a global session; jobs receive one.  These helpers
exist for tests, the bench and the command line.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: Bytes of a method from which on the JVM leaves it uncompiled.
HUGE_METHOD = 8000


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "podium", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (a cluster passes its own)."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = {**DEFAULT_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions),
            **(extra or {})}
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def compiled_methods(spark: SparkSession) -> None:
    """Let wide projections run as many small methods instead of a whole-stage one that the JVM would never compile.

    Spark joins all expressions of a stage in one method and accepts up to 64 KB (the default of
    this setting), but the JVM only interprets methods of more than 8,000 bytes.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name, "65535")) > HUGE_METHOD:
        spark.conf.set(name, str(HUGE_METHOD))


_LOCAL_DIR: str | None = None


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Only
    a local-mode session without one gets a fresh folder of its own; a cluster
    session without one is an error, since a machine-local folder would be lost
    with its executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session has no context
        sc = None
    if sc is None:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current:
            return current.rstrip("/")
        if not str(spark.conf.get("spark.master", "local")).startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on the cluster")
        global _LOCAL_DIR
        if _LOCAL_DIR is None:
            _LOCAL_DIR = tempfile.mkdtemp(prefix="podium-ckpt-", dir=os.environ.get("PODIUM_SCRATCH", "/tmp"))
        return _LOCAL_DIR
    current = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on the cluster")
    local = tempfile.mkdtemp(prefix="podium-ckpt-", dir=os.environ.get("PODIUM_SCRATCH", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    return f"{checkpoint_dir(spark)}/podium-tables/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared folder and read back: its lineage is cut and its size is known to the planner."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
