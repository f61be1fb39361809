"""CSV sink and source with one option set for both sides (A4, A5, quirk 24)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from podium.fixed import BRONZE_COLUMNS

CSV_OPTIONS = {"header": "true", "sep": ",", "quote": '"', "escape": '"', "nullValue": ""}

BRONZE_SCHEMA = StructType([StructField(c, StringType(), True) for c in BRONZE_COLUMNS])


def write_csv(df: DataFrame, path: str, mode: str) -> None:
    """Headered CSV, many part files (no ``coalesce(1)``); null as empty."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType, mode: str = "FAILFAST",
             corrupt_col: str | None = None) -> DataFrame:
    """Declared schema, no inference (A5).

    ``FAILFAST`` stops at the first bad row; ``PERMISSIVE`` with ``corrupt_col``
    keeps bad rows' raw text in that column instead.
    """
    r = spark.read.options(**CSV_OPTIONS).option("mode", mode)
    if corrupt_col:
        schema = StructType(schema.fields + [StructField(corrupt_col, StringType(), True)])
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    return r.schema(schema).csv(path)
