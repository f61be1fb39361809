"""Joins that stay even when a key is null or hot.

A hash join sends all rows of a key to one task.  Null keys never match, so their
rows may go anywhere; the rows of a hot key may go to any of several tasks if each of them
gets a copy of the other side's row.  Hot keys are found by a quantile sketch of key
hashes: a key that holds a given share of the rows fills that share of the ranks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

#: A key is hot from this share of the rows with a key on; no more than its inverse can be.
HOT_SHARE = 1 / 256
#: Quantiles that a hot key covers at least, and items that the sketch keeps (its error is a tenth of a per cent).
COVERED, SKETCH_ITEMS = 4, 4096
#: Tasks over which the rows of null keys and of a hot key are spread.
NULL_SALT, HOT_SALT = 1024, 64


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> list[int]:
    """Hashes (``xxhash64(keys)``) of the keys that hold at least ``share`` of the rows without a null key.

    One pass over the key columns; sketches are merged in the executors and only their
    quantiles come back.  Keys with half that share may be in the list as well.
    """
    parts = round(COVERED / share)
    at = F.array(*[F.lit(i / parts) for i in range(parts + 1)])
    row = df.filter(~_any_null(keys)).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_bigint(F.xxhash64(*keys), SKETCH_ITEMS).alias("s")) \
        .filter("n > 0").select(F.kll_sketch_get_quantile_bigint("s", at).alias("q")).first()
    if row is None:
        return []
    q = row["q"]
    near = COVERED - 2  # bounds of ranks and the sketch's error may cost one quantile at either end
    return sorted({a for a, b in zip(q, q[near:]) if a == b})


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the planner's own size check would send ``df`` to all tasks, so that no key gathers rows."""
    try:
        limit = int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
        return 0 <= int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString()) <= limit
    except Exception:  # noqa: BLE001 - no plan statistics (Spark Connect): look for hot keys
        return False


def left_join_spread(left: DataFrame, right: DataFrame, keys: Sequence[str], hot: Sequence[int] = ()) -> DataFrame:
    """Left equi-join on ``keys``; rows with a null key and rows of ``hot`` keys are spread over many tasks.

    A salt joins the keys: a hash of the row for rows with a null or a hot key, 0
    otherwise.  The right side's rows of hot keys are copied for each salt; its other
    rows carry a hash modulo 1, always 0 but no constant, which the optimiser would move
    out of the join keys.  ``hot`` is fixed before the join is planned, so both sides
    always agree.  Rows equal in every column share a salt.
    """
    hashable = [F.col(f.name) for f in left.schema.fields if isinstance(f.dataType, AtomicType)]
    spread = F.xxhash64(*hashable) if hashable else F.lit(0)
    key = F.xxhash64(*keys)
    salt = F.when(_any_null(keys), F.pmod(spread, F.lit(NULL_SALT)))
    none = F.pmod(key, F.lit(1)).cast("int")
    if hot:
        salt = salt.when(key.isin(list(hot)), F.pmod(spread, F.lit(HOT_SALT)))
        copies = F.when(key.isin(list(hot)), F.sequence(F.lit(0), F.lit(HOT_SALT - 1))).otherwise(F.array(none))
        r = right.withColumn("__salt", F.explode(copies))
    else:
        r = right.withColumn("__salt", none)
    return left.withColumn("__salt", salt.otherwise(F.lit(0)).cast("int")) \
        .join(r, on=[*keys, "__salt"], how="left").drop("__salt")


def left_join_even(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``left_join_spread`` with the hot keys that ``left`` has; none are looked for if ``right`` is sent to all tasks."""
    return left_join_spread(left, right, keys, () if fits_broadcast(right) else heavy_keys(left, keys))
