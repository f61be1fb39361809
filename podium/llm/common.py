"""Helpers shared by the operators: tables, tables cut to disk, bounded arrays."""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.session import scratch_path

TOKENIZER_DIR = os.environ.get("PODIUM_TOKENIZERS", "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file is; resolved in the process that opens it."""
    if TOKENIZER_DIR:
        return os.path.join(TOKENIZER_DIR, name)
    import public_tokenizers
    return public_tokenizers.path(name)


_WRITTEN = "_podium_written"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the session's shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor never makes a later step run the earlier ones
    again, and values that depend on task order are fixed once.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    setattr(back, _WRITTEN, path)
    return back


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialise`` that nothing reads any more."""
    for df in tables:
        path = getattr(df, _WRITTEN)
        sc = df.sparkSession.sparkContext
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


_CACHE: dict[str, object] = {}


def worker_cache(owner: str, make: Callable[[], object]) -> object:
    """The cache of one operator in this Python worker; a worker keeps one operator's at a time."""
    if owner not in _CACHE:
        _CACHE.clear()
        _CACHE[owner] = make()
    return _CACHE[owner]


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def long_array(values) -> Column:
    """One array<bigint> literal (built once, not one literal for each element)."""
    return F.lit(np.asarray(list(values), dtype=np.int64))


def range_of(key: Column, splitters: list[int]) -> Column:
    """Number of sorted ``splitters`` that are <= key: two short searches, coarse then fine."""
    if not splitters:
        return F.lit(0)
    step = max(1, round(len(splitters) ** 0.5))
    rows = [splitters[i:i + step] for i in range(0, len(splitters), step)]
    coarse = long_array(r[0] for r in rows)
    fine = F.array(*[long_array(r) for r in rows])
    at = F.size(F.filter(coarse, lambda c: c <= key))
    inside = F.size(F.filter(F.element_at(fine, F.greatest(at, F.lit(1))), lambda c: c <= key))
    return F.when(at == 0, F.lit(0)).otherwise((at - 1) * step + inside).cast("int")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let Arrow batches of whole texts hold no more than ``rows`` (Spark's default is 10,000)."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(name, str(rows))
