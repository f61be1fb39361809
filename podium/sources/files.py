"""File sets: manifest, whole-file text with its path, layout routing (A1-A3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def manifest(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """path, length, modificationTime of every file (A2); file contents are not read."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.load(path).select("path", "length", "modificationTime")


def read_text_files(spark: SparkSession, paths: str | Sequence[str], page_sep: str | None = "\f") -> DataFrame:
    """(file_path, page, text) per page of each file.

    Whole files are read (one row each) so line order inside a file is exact;
    pages split on form feed.  Result sheets are small files: the file count,
    not the file size, grows with the data.
    """
    raw = spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=True)
    df = raw.select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("text"))
    if page_sep is None:
        return df.select("file_path", F.lit(0).alias("page"), "text")
    return df.select("file_path", F.posexplode(F.split("text", page_sep, -1)).alias("page", "text"))


def read_text_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file_path, page, line_no, line) with files split across tasks.

    For large text files: line mode is splittable, so one file is read by many
    tasks.  ``line_no`` is the struct (split start, running row id of the
    task): a task reads each of its splits front to back, so this struct orders
    the lines of a file exactly (the numbers are not consecutive), which is all
    the in-order header scan needs.  Pages are not split here (page 0); take
    the header from the whole file.
    """
    raw = spark.read.text(paths if isinstance(paths, str) else list(paths))
    line_no = F.struct(F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("seq"))
    return raw.select(F.col("_metadata.file_path").alias("file_path"), F.lit(0).alias("page"),
                      line_no.alias("line_no"), F.col("value").alias("line"))
