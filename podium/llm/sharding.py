"""Sharding by sampled splitters (built-in expressions only).

Keys are drawn with a chance in proportion to their record's size, quantiles of
the draw become range bounds, records go to their range, and ranges that turn out
overfull are split again.  Exact running sizes inside the (small) ranges then cut
the key order into shards of near-equal bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.common import materialise, range_of

RANGES_PER_SHARD = 16
POINTS_PER_RANGE = 32
OVERFULL = 3.0
SEED = 20_011


def _quantiles(column: str, n: int):
    return F.percentile_approx(column, [i / n for i in range(1, n)], 100_000)


def shard_by_size(df: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
                  overhead: int = 16) -> DataFrame:
    """Shard, slot and digests of each record of ``df``.

    Returns id, ``size`` (UTF-8 bytes + ``overhead``), ``text_crc32``, ``shard``
    (0..shards-1) and ``slot`` (gapless from 0 in each shard).  The key order is
    (text hash, id hash): equal texts lie side by side, so a group of copies crosses
    a shard border only where the sizes demand it, and a group of any size is split
    by its ids.  Repeated rows are kept, one output row each, and spread over 256
    sub-keys.  Null text counts as no bytes (CRC 0); a null id is an id like any
    other; an empty table gives no rows; other columns are ignored.
    """
    text = F.col(text_col)
    high, mid = ~((1 << 24) - 1), ((1 << 24) - 1) & ~0xFF
    slim = df.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"),
        F.coalesce(F.crc32(F.encode(text, "UTF-8")), F.lit(0)).cast("long").alias("crc"),
        F.xxhash64(text).bitwiseAND(F.lit(high))
        .bitwiseOR(F.xxhash64(F.lit(SEED), F.col(id_col)).bitwiseAND(F.lit(mid)))
        .bitwiseOR(F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit(0xFF))).alias("key"))
    slim = materialise(slim, "shard-keys")
    total, rows = slim.agg(F.sum("size"), F.count(F.lit(1))).first()
    if not rows:
        return df.select(F.col(id_col), F.lit(0).cast("long").alias("size"),
                         F.lit(0).cast("long").alias("text_crc32"), F.lit(0).alias("shard"),
                         F.lit(0).cast("long").alias("slot")).limit(0)

    ranges = shards * RANGES_PER_SHARD
    splitters = _sampled_splitters(slim, total, ranges)
    splitters = _split_overfull(slim, splitters, total / ranges)

    placed = slim.withColumn("rid", range_of(F.col("key"), splitters))
    sizes = {r["rid"]: (r["b"], r["n"]) for r in
             placed.groupBy("rid").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()}
    offsets, b0, n0 = [], 0, 0
    for rid in range(len(splitters) + 1):
        offsets.append((b0, n0))
        b0, n0 = b0 + sizes.get(rid, (0, 0))[0], n0 + sizes.get(rid, (0, 0))[1]
    bases = df.sparkSession.createDataFrame([(i, b, n) for i, (b, n) in enumerate(offsets)],
                                            "rid int, byte0 bigint, row0 bigint")
    order = Window.partitionBy("rid").orderBy("key", "id", "crc", "size")
    placed = placed.join(F.broadcast(bases), "rid").select(
        "id", "size", "crc", "rid",
        (F.col("byte0") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .alias("start"),
        (F.col("row0") + F.row_number().over(order) - 1).alias("rank"))
    middle = (F.col("start") + F.expr("size div 2")).cast("decimal(38,0)") * F.lit(shards)
    placed = placed.withColumn(
        "shard", F.least(F.floor(middle / F.lit(total).cast("decimal(38,0)")).cast("int"), F.lit(shards - 1)))
    placed = materialise(placed, "shard-rows")
    firsts = placed.groupBy("shard").agg(F.min("rank").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("rank") - F.col("first")).alias("slot"))


def _sampled_splitters(slim: DataFrame, total: int, ranges: int) -> list[int]:
    """Quantiles of a draw of about ``ranges * POINTS_PER_RANGE`` keys, size-weighted."""
    rate = ranges * POINTS_PER_RANGE / total
    unit = F.xxhash64(F.lit(SEED + 1), "key", "id", "size").bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))
    want = F.col("size") * F.lit(rate)
    times = (F.floor(want) + (unit < want - F.floor(want)).cast("int")).cast("int")
    drawn = slim.select("key", times.alias("times")).filter("times > 0") \
        .select("key", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("i"))
    got = drawn.agg(_quantiles("key", ranges).alias("q")).first()["q"] or []
    return sorted(set(got))


def _split_overfull(slim: DataFrame, splitters: list[int], mean: float, rounds: int = 4) -> list[int]:
    """Add bounds inside ranges above ``OVERFULL`` times the mean until none can be split."""
    for _ in range(rounds):
        sizes = slim.groupBy(range_of(F.col("key"), splitters).alias("rid")) \
            .agg(F.sum("size").alias("b"), F.min("key").alias("lo"), F.max("key").alias("hi"))
        full = sizes.filter((F.col("b") > F.lit(OVERFULL * mean)) & (F.col("lo") < F.col("hi"))).collect()
        if not full:
            return splitters
        parts = max(2, min(64, int(max(r["b"] for r in full) / mean) + 1))
        again = slim.withColumn("rid", range_of(F.col("key"), splitters)) \
            .filter(F.col("rid").isin([r["rid"] for r in full])).groupBy("rid") \
            .agg(_quantiles("key", parts).alias("q")).collect()
        more = sorted(set(splitters) | {k for r in again for k in r["q"]} | {r["hi"] for r in full})
        if more == splitters:
            return splitters
        splitters = more
    return splitters
