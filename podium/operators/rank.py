"""Ranking without one big partition.

``row_number_by`` numbers rows 1..n per group in a total order.  Spark's own
``row_number`` over a window needs every row of a group in one task; a group
holding a third of the data (or no group at all, the reference's case) would
then sort in a single task.  Here the rows of a large group are cut into ranges
of their order keys (``podium.operators.ranges``).  Each row's range is a pure
function of its key, so:

* a hot group is split across many ranges (its order keys differ),
* row_number runs per (group, range) in parallel,
* a range's offset is the row count of the earlier ranges of its group,
  computed from a small count table (one row per range of a large group).

While planning, rows are counted and the bounds are taken from quantile sketches
that the executors merge.  The bounds are then literals in the plan, so
recomputation can never move a row to another range (unlike re-sampling by
``repartitionByRange``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from podium.operators.ranges import (Key, as_key, order_codes, range_bounds, rows_per_range, same_group, with_ranges)


def row_number_by(df: DataFrame, order_by: Sequence, partition_by: Sequence = (),
                  out: str = "pos", buckets: int | None = None) -> DataFrame:
    """``row_number() over (partition by ... order by ...)`` in parallel ranges.

    Rows tied on ``order_by`` are numbered by a hash of the row (Spark's
    window would use an arbitrary order); give a real tie-break key where the
    order of ties matters (the reference's rank had none, quirk 15).
    ``buckets`` asks for about so many ranges of all rows.
    """
    keys = [as_key(k) for k in order_by]
    # hidden last order key: a hash of the row, so rows tied on the given keys
    # are numbered in a fixed order and a block of ties can still be cut into
    # ranges (only exact duplicate rows stay together)
    atomic = [F.col(f.name) for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
    keys.append(Key(F.xxhash64(*atomic) if atomic else F.lit(0)))
    groups = [F.col(c) if isinstance(c, str) else c for c in partition_by]
    gnames = [f"__g{i}" for i in range(len(groups))]
    base = df.withColumns({g: c for g, c in zip(gnames, groups)}) if groups else df
    order = [k.sort_col() for k in keys]
    coded = base.select(*gnames, order_codes(base, keys).alias("__codes"))
    n_rows = df.count()
    bounds = range_bounds(coded, n_rows, gnames, "__codes", rows_per_range(n_rows, buckets))
    if bounds is None:  # no group is larger than one range
        w = Window.partitionBy(*gnames).orderBy(*order) if gnames else Window.orderBy(*order)
        return base.withColumn(out, F.row_number().over(w).cast("long")).drop(*gnames)
    keyed = with_ranges(base.withColumn("__codes", order_codes(base, keys)), gnames, "__codes", bounds, "__bkt") \
        .drop("__codes")
    counts = with_ranges(coded, gnames, "__codes", bounds, "__bkt", "inner").groupBy(*gnames, "__bkt") \
        .agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*gnames).orderBy("__bkt").rowsBetween(Window.unboundedPreceding, -1)
    # later ranges of large groups only: a first range starts at 0, so the table is no longer than the bounds
    offsets = counts.select(*gnames, "__bkt", F.sum("__n").over(before).alias("__off")).filter("__bkt > 0")
    names = [*gnames, "__bkt"]
    offsets = F.broadcast(offsets.withColumnsRenamed({c: f"{c}_o" for c in names}))
    # null-safe: rows of a null group keep their place like those of any other
    joined = keyed.join(offsets, same_group(gnames, "_o") & (F.col("__bkt") == F.col("__bkt_o")), "left") \
        .drop(*[f"{c}_o" for c in names])
    w = Window.partitionBy(*gnames, "__bkt").orderBy(*order)
    numbered = joined.withColumn(out, F.row_number().over(w).cast("long") + F.coalesce("__off", F.lit(0)))
    return numbered.drop(*gnames, "__bkt", "__off")


def global_rank(df: DataFrame, order_by: Sequence, out: str = "pos",
                buckets: int | None = None) -> DataFrame:
    """Row number over the whole table (H2), without a one-partition window."""
    return row_number_by(df, order_by, (), out, buckets)


def conditional_rank(df: DataFrame, where: Column, partition_by: Sequence, order_by: Sequence,
                     out: str = "pos", buckets: int | None = None) -> DataFrame:
    """Rank only the rows matching ``where`` (H1); strict form ranks per group."""
    return row_number_by(df.filter(where), order_by, partition_by, out, buckets)


def rank_join_back(df: DataFrame, where: Column, order_by: Sequence, on: str, target: str,
                   default=None, compat: bool = True, partition_by: Sequence = (),
                   buckets: int | None = None) -> DataFrame:
    """Give ``target`` the rank of the matching rows.

    compat: rank the matching rows, then left-join the rank back by ``on``
    alone, so every row of that key takes it and keys with two ranked rows fan
    out (quirk 16).  strict: the rank stays on its own row.
    """
    ttype = df.schema[target].dataType
    fallback = F.col(target) if default is None else F.coalesce(F.col(target), F.lit(default).cast(ttype))
    if compat:
        ranked = row_number_by(df.filter(where).select(F.col(on).alias("__on"), *[
            (as_key(k).col()).alias(f"__o{i}") for i, k in enumerate(order_by)]),
            [Key(f"__o{i}", as_key(k).desc, as_key(k).nulls_last) for i, k in enumerate(order_by)],
            partition_by=(), out="__rank", buckets=buckets).select("__on", "__rank")
        from podium.operators.conform import left_join_spread_nulls
        joined = left_join_spread_nulls(df.withColumn("__on", F.col(on)), ranked, ["__on"])
        return joined.withColumn(target, F.coalesce(F.col("__rank").cast(ttype), fallback)) \
                     .drop("__on", "__rank")
    flagged = df.withColumn("__m", where)
    ranked = row_number_by(flagged.filter("__m"), order_by, partition_by, "__rank", buckets)
    rest = flagged.filter(~F.col("__m") | F.col("__m").isNull()).withColumn("__rank", F.lit(None).cast("long"))
    both = ranked.unionByName(rest)
    return both.withColumn(target, F.coalesce(F.col("__rank").cast(ttype), fallback)).drop("__m", "__rank")


def top_k(df: DataFrame, k: int, order_by: Sequence) -> DataFrame:
    """The first ``k`` rows in order (H3): each task keeps k rows, one merge."""
    return df.orderBy(*[as_key(o).sort_col() for o in order_by]).limit(k)
