"""Sources and sinks: Parquet tables, text files, CSV, JDBC, landing tables."""

from podium.sources.tables import read_table

__all__ = ["read_table"]
