"""podium: medallion-style batch jobs as Spark DataFrame operators.

Text lines become typed records by layouts kept as data, land as a bronze
table, are conformed into silver dimensions and facts, published as gold
tables with flags and audit columns, profiled, and scored.  Every operator is
a ``DataFrame -> DataFrame`` function built from Spark expressions, joins,
aggregates and windows; nothing is collected to the driver except bounded
metadata (range bounds, small code tables).
"""

__version__ = "0.1.0"
