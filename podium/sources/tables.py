"""Parquet tables, save with an explicit mode, staged and published versions, retire, append with drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SAVE_MODES = ("append", "overwrite", "error", "errorifexists", "ignore")


def read_table(spark: SparkSession, root: str, name: str, spread: bool = False) -> DataFrame:
    """A driver table: ``{root}/{name}.parquet`` (column pruning and pushdown apply).

    ``spread``: for heavy per-row work right after the scan (text parsing).  A
    file that cannot be split (one row group) is read by one task, and every
    narrow step after it would run in that task too; such a scan is spread
    over the cluster's parallelism by a round-robin repartition (columns are
    pruned before it).  A large table already has more splits than cores, so
    nothing changes at scale; queries that shuffle at once do not ask for it.
    """
    df = spark.read.parquet(f"{root}/{name}.parquet")
    if spread:
        try:
            want = spark.sparkContext.defaultParallelism
            if df.rdd.getNumPartitions() < want:
                df = df.repartition(want)
        except Exception:  # noqa: BLE001 - no partition probe (Spark Connect): keep the scan
            pass
    return df


def save(df: DataFrame, target: str, mode: str, partition_by: Sequence[str] = (),
         fmt: str = "parquet") -> None:
    """Write a table; ``mode`` has no default and errors are raised (A9, quirk 19).

    ``target`` is a path (contains '/') or a catalog table name.
    """
    if mode not in SAVE_MODES:
        raise ValueError(f"mode must be one of {SAVE_MODES}")
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if "/" in target:
        w.save(target)
    else:
        w.saveAsTable(target)


def _hadoop(spark: SparkSession, target: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path, jvm.org.apache.hadoop.fs.Path


def _names(fs, path) -> list[str]:
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


POINTERS, VERSION = "_published", "version-"


def stage(df: DataFrame, target: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> str:
    """Write a new version of the table ``target`` beside its older ones; readers see it once it is published.

    Returns its path.  A version that a failed run left behind is never read and never
    written again.  One writer at a time.
    """
    fs, path, _ = _hadoop(df.sparkSession, target)
    last = max((int(n[len(VERSION):]) for n in _names(fs, path) if n.startswith(VERSION)), default=0)
    version = f"{target}/{VERSION}{last + 1:09d}"
    save(df, version, "errorifexists", partition_by, fmt)
    return version


def publish(spark: SparkSession, versions: Sequence[str], keep: int = 2) -> None:
    """Point the tables at staged versions, one empty file each; older versions than the last ``keep`` are dropped."""
    for version in versions:
        target, name = version.rsplit("/", 1)
        fs, _, path = _hadoop(spark, target)
        fs.mkdirs(path(f"{target}/{POINTERS}"))
        fs.createNewFile(path(f"{target}/{POINTERS}/{name}"))
    for version in versions:
        target = version.rsplit("/", 1)[0]
        fs, _, path = _hadoop(spark, target)
        named = _names(fs, path(f"{target}/{POINTERS}"))
        for old in (n for n in _names(fs, path(target)) if n.startswith(VERSION) and n < min(named[-keep:])):
            fs.delete(path(f"{target}/{POINTERS}/{old}"), False)
            fs.delete(path(f"{target}/{old}"), True)


def published(spark: SparkSession, target: str) -> str | None:
    """The path of the version that ``target`` points at, if it is a published table."""
    fs, path, _ = _hadoop(spark, f"{target}/{POINTERS}")
    named = _names(fs, path)
    return f"{target}/{named[-1]}" if named else None


def load(spark: SparkSession, target: str, merge_schema: bool = False, fmt: str = "parquet") -> DataFrame:
    """A table by path (its published version, if it has one) or catalog name."""
    if "/" in target:
        return spark.read.format(fmt).option("mergeSchema", str(merge_schema).lower()) \
            .load(published(spark, target) or target)
    return spark.table(target)


def append_with_drift(df: DataFrame, target: str, fmt: str = "parquet") -> None:
    """Insert-only landing that lets new columns in.

    Each batch is appended as written; readers use ``mergeSchema`` so rows of
    older batches show null in newer columns.  Rows are never updated.
    """
    save(df, target, "append", fmt=fmt)


def retire(spark: SparkSession, target: str) -> None:
    """Drop a landing table after the downstream tables are written (A10)."""
    if "/" in target:
        fs, path, _ = _hadoop(spark, target)
        fs.delete(path, True)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {target}")


def append_missing_rows(existing: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """``existing`` plus those literal ``rows`` whose key is not there yet.

    Idempotent (quirk 20).  Only the keys of the few literal rows are probed:
    a semi join against a broadcast of those keys finds which exist, so the
    big table is scanned once and never shuffled.
    """
    keys = rows.select(*key).distinct()
    present = existing.select(*key).join(F.broadcast(keys), list(key), "left_semi").distinct()
    new = rows.join(F.broadcast(present), list(key), "left_anti")
    return existing.unionByName(new.select(*existing.columns))
