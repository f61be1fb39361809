"""Dedup, distinct, surrogate keys, foreign-key lookups, corrections (F, G, J, M)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.operators.rank import row_number_by
from podium.operators.skew import left_join_even, left_join_spread
from podium.sources.tables import publish, published, stage

left_join_spread_nulls = left_join_spread


def dedup_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Exact duplicate rows removed (F1, compat form)."""
    return df.dropDuplicates(list(cols)) if cols else df.dropDuplicates()


def dedup_by_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``key``: the row with the least ``order`` values (F1, strict).

    An aggregate of ``min(struct(order..., rest...))``: partial aggregation runs
    before the shuffle, so a hot key costs one small row per task, not a sort
    of all its rows.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    packed = F.min(F.struct(*[F.col(c) for c in [*order, *rest]])).alias("__best")
    agg = df.groupBy(*key).agg(packed)
    return agg.select(*[F.col(k) for k in key], *[F.col(f"__best.{c}").alias(c) for c in [*order, *rest]]) \
              .select(*df.columns)


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct natural key (F2); partial aggregation before the shuffle."""
    return df.select(*cols).distinct()


def surrogate_key(df: DataFrame, natural_key: Sequence[str], out: str = "id",
                  how: str = "row_number") -> DataFrame:
    """Deterministic key (J1): dense numbering in key order, or a 64-bit hash.

    ``monotonically_increasing_id`` (the reference) depends on partition
    layout, so ids change between runs; neither form here does.
    """
    if how == "hash":
        return df.withColumn(out, F.xxhash64(*[F.col(c) for c in natural_key]))
    numbered = row_number_by(df, [*natural_key], (), "__sk")
    return numbered.withColumn(out, F.col("__sk")).drop("__sk")


def register_keys(rows: DataFrame, natural_key: Sequence[str], registry: str, out: str = "id") -> DataFrame:
    """``rows`` with keys from a registry table that keeps them over loads (J1, quirk 12).

    Natural keys that the registry (a path) does not hold yet are numbered in key order
    from its largest number on, and a new version with them is published, so a key once
    given never changes and a failed run gives none.  Nulls are values of the key.
    """
    spark = rows.sparkSession
    new = rows.select(*natural_key).distinct()
    pointer = published(spark, registry)
    if pointer:
        known = spark.read.parquet(pointer)
        theirs = known.select(*[F.col(c).alias(f"__r_{c}") for c in natural_key])
        new = new.join(theirs, reduce(and_, [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in natural_key]), "left_anti")
        top = known.agg(F.max(out)).first()[0] or 0
    else:
        known, top = None, 0
    numbered = surrogate_key(new, natural_key, "__n").select(
        *natural_key, (F.col("__n") + F.lit(top)).cast("bigint").alias(out))
    version = stage(numbered if known is None else known.unionByName(numbered), registry)
    publish(spark, [version])
    held = spark.read.parquet(version).withColumnsRenamed({c: f"__r_{c}" for c in natural_key})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in natural_key])
    return rows.join(held, same, "left").select(*rows.columns, out)


def unique_on(dim: DataFrame, on: Sequence[str], value: str, strict: bool = True) -> DataFrame:
    """``dim`` reduced to one row per key, carrying ``value``.

    strict: a key seen twice stops the job (lazy ``raise_error``) instead of
    fanning out the fact (quirk 10).  The grouping partitions the dimension on
    the key, which the following join reuses.
    """
    agg = dim.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"), F.min(value).alias(value))
    if strict:
        agg = agg.withColumn(value, F.when(F.col("__n") == 1, F.col(value)).otherwise(
            F.raise_error(F.concat(F.lit("lookup key is not unique: "),
                                   F.to_json(F.struct(*[F.col(c) for c in on]))))
        ).cast(dim.schema[value].dataType))
    return agg.drop("__n")


def lookup_fk(fact: DataFrame, dim: DataFrame, on: Sequence[tuple[Column, str]], dim_key: str,
              fk: str, strict: bool = True) -> DataFrame:
    """Left lookup of ``dim_key`` into ``fk``.

    ``on`` pairs a fact expression (already the dimension's type: use
    ``try_cast`` for text keys) with a dimension column.  strict: the dimension
    is made unique on the key first, so the fact never changes row count;
    compat: a plain left join (fan-out kept).  A dimension that is not sent to all
    tasks is joined by a shuffle in which null and hot keys are spread out.
    """
    names = [f"__k{i}" for i in range(len(on))]
    f = fact.withColumns({n: e for n, (e, _) in zip(names, on)})
    d = dim.select(*[F.col(c).alias(n) for n, (_, c) in zip(names, on)], F.col(dim_key).alias(fk))
    if strict:
        d = unique_on(d, names, fk, True)
    joined = left_join_even(f, d, names)
    return joined.select(*fact.columns, fk)


def correct_null(fact: DataFrame, fk: str, fixes: DataFrame, on: Sequence[tuple[str, str]],
                 fix_col: str, small: bool = False) -> DataFrame:
    """Fill null ``fk`` from a correction table keyed by ``on`` (G3, replaces M1's UDF).

    Only rows whose ``fk`` is null enter the join, on all key columns; the others
    pass by.  ``small=True`` marks a literal correction table (its size is fixed) for
    broadcast; otherwise the planner decides from its size check, and in a shuffle
    null and hot keys are spread out.  A key seen twice stops the job, so rows never fan out.
    """
    names = [f"__f{i}" for i in range(len(on))]
    fx = fixes.select(*[F.col(c).alias(n) for n, (_, c) in zip(names, on)], F.col(fix_col).alias("__fix"))
    fx = unique_on(fx, names, "__fix")
    lack = fact.filter(F.col(fk).isNull()).withColumns({n: F.col(c) for n, (c, _) in zip(names, on)})
    if small:
        joined = lack.join(F.broadcast(fx), names, "left")
    else:
        joined = left_join_even(lack, fx, names)
    filled = joined.withColumn(fk, F.col("__fix").cast(fact.schema[fk].dataType)).select(*fact.columns)
    return fact.filter(F.col(fk).isNotNull()).unionByName(filled)
