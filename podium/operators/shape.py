"""Projection, renames, audit columns, filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegerType, LongType


def select_rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Select and rename in one projection (C1, C2); names resolve case-insensitively."""
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


def drop_cols(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns."""
    return df.drop(*cols)


def star_with(left: DataFrame, right: DataFrame, cond, how: str,
              right_cols: Mapping[str, str]) -> DataFrame:
    """``left.*`` plus chosen right columns under new names (C4)."""
    joined = left.alias("__l").join(right.alias("__r"), cond, how)
    return joined.select("__l.*", *[F.col(f"__r.{c}").alias(a) for c, a in right_cols.items()])


def audit_columns(load_time: str | None = None, active: bool = True,
                  ntz: bool = True) -> dict[str, Column]:
    """insert/modified time and the active flag.

    ``load_time`` pins the time so that a rerun writes the same rows; without
    it the query start time is used, as the reference does.
    """
    if load_time is None:
        ts = F.localtimestamp() if ntz else F.current_timestamp()
    else:
        ts = F.lit(load_time).cast("timestamp_ntz" if ntz else "timestamp")
    return {"insert_date": ts, "modified_date": ts, "active": F.lit(active)}


def add_audit(df: DataFrame, load_time: str | None = None, active: bool = True,
              ntz: bool = True) -> DataFrame:
    return df.withColumns(audit_columns(load_time, active, ntz))


NUMERIC_KINDS = (IntegerType, LongType, DoubleType, FloatType)


def numeric_columns(df: DataFrame, kinds: Sequence[type] = NUMERIC_KINDS) -> list[str]:
    """Names of the columns of the given numeric types, in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, tuple(kinds))]


def filter_regex(df: DataFrame, col: str, pattern: str, trim: bool = True) -> DataFrame:
    """Keep rows whose (trimmed) value matches ``pattern``."""
    c = F.trim(F.col(col)) if trim else F.col(col)
    return df.filter(c.rlike(pattern))


def filter_null(df: DataFrame, col: str) -> DataFrame:
    """Keep rows where ``col`` is null."""
    return df.filter(F.col(col).isNull())


def exclude_values(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """``col <> v1 AND col <> v2 ...``; rows with null ``col`` go as well (D3)."""
    cond = None
    for v in values:
        c = F.col(col) != F.lit(v)
        cond = c if cond is None else cond & c
    return df if cond is None else df.filter(cond)


def keep_by_dimension(fact: DataFrame, fk: str, dim: DataFrame, key: str, where: Column) -> DataFrame:
    """Fact rows whose dimension row meets ``where`` on its natural key (D3 by name, not by literal ids).

    A left-semi join: where the fact is partitioned by ``fk``, Spark prunes its
    partitions at run time by the dimension's filtered keys.  Rows with a null ``fk`` go,
    as under ``exclude_values``.
    """
    kept = dim.filter(where).select(F.col(key).alias("__dim")).distinct()
    return fact.join(kept, fact[fk] == kept["__dim"], "left_semi")


def filter_below(df: DataFrame, col: str, limit) -> DataFrame:
    """``col < limit``; null drops."""
    return df.filter(F.col(col) < F.lit(limit))


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop a row when any (listed) column is null."""
    return df.na.drop("any", subset=list(subset) if subset else None)
