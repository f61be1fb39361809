"""Insert-only landing of arriving files, exactly once.

The reference copies each new CSV into the bronze table with a data flow that
only inserts.  As a stream: a file source with a declared schema, a Parquet
file sink and a checkpoint folder.  The checkpoint records which files were
taken and which batches were committed, so a restart after a lost executor or
driver neither skips nor repeats a file.  ``available_now`` drains what is
there and stops (a scheduled job); without it the query keeps running.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from podium.sources.csv import CSV_OPTIONS


def land_stream(spark: SparkSession, source_dir: str, schema: StructType, target: str, checkpoint: str,
                fmt: str = "csv", options: dict | None = None, available_now: bool = True,
                max_files_per_trigger: int | None = None, source_col: str | None = "_source_file",
                interval: str = "1 minute") -> StreamingQuery:
    reader = spark.readStream.format(fmt).schema(schema).options(**(options if options is not None else CSV_OPTIONS))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir)
    if source_col:
        stream = stream.withColumn(source_col, F.col("_metadata.file_path"))
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start(target)
