"""Key ranges of near-equal row counts, from quantile sketches merged on the executors.

Order keys of any supported type become one array of 64-bit codes that sorts as the keys
do: numbers, dates and times give one code, doubles their bits, text seven bytes a
code; a descending key gives the complement.  A KLL sketch of the first code gives the bounds;
where a single code holds more rows than a range should, the rows that share it are
sketched again by the next code, so equal leading keys never keep rows together.
Only counts of large groups and the bounds reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, ShortType, StringType, StructField, StructType, TimestampNTZType,
                               TimestampType)

MIN_ROWS_PER_RANGE = 500_000
MAX_RANGES = 4096
LOW, HIGH = -(1 << 63), (1 << 63) - 1
#: Items that a sketch keeps for each range it has to cut (more give truer ranges); the library's own limits.
ITEMS_PER_RANGE, LEAST_ITEMS, MOST_ITEMS = 8, 256, 65535
#: Bytes of text in a code; the low bits hold how many are used.
TEXT_BYTES = 7


@dataclass(frozen=True)
class Key:
    """One ordering key: ascending unless ``desc``; nulls first unless ``nulls_last``."""

    expr: Column | str
    desc: bool = False
    nulls_last: bool = False

    def col(self) -> Column:
        return F.col(self.expr) if isinstance(self.expr, str) else self.expr

    def sort_col(self) -> Column:
        c = self.col()
        if self.desc:
            return c.desc_nulls_last() if self.nulls_last else c.desc_nulls_first()
        return c.asc_nulls_last() if self.nulls_last else c.asc_nulls_first()


def as_key(k) -> Key:
    return k if isinstance(k, Key) else Key(k)


def _double_code(c: Column) -> Column:
    """The bits of a double as a number that sorts as Spark sorts doubles (-0.0 as 0.0, NaN last)."""
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"),
                     F.coalesce(c.cast("double"), F.lit(0.0)) + F.lit(0.0)).cast("bigint")
    return F.when(bits < 0, bits.bitwiseXOR(F.lit(HIGH))).otherwise(bits)


def _text_codes(c: Column) -> Column:
    """Codes of seven bytes each; the last is never full, so no text's codes begin another's."""
    raw = F.encode(F.coalesce(c, F.lit("")), "UTF-8")
    size = F.octet_length(raw)

    def chunk(i: Column) -> Column:
        part = F.substring(raw, i * TEXT_BYTES + 1, F.lit(TEXT_BYTES))
        return F.conv(F.rpad(F.hex(part), 2 * TEXT_BYTES, "0"), 16, 10).cast("bigint") * 8 + F.octet_length(part)

    return F.transform(F.sequence(F.lit(0), F.floor(size / TEXT_BYTES).cast("int")), chunk)


def _ntz_micros(c: Column) -> Column:
    """Microseconds of a local time, whatever the session's zone skips or repeats."""
    return F.unix_date(c.cast("date")).cast("bigint") * 86_400_000_000 + F.hour(c) * F.lit(3_600_000_000) \
        + F.minute(c) * F.lit(60_000_000).cast("bigint") + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("bigint")


def key_codes(c: Column, dtype: DataType, desc: bool = False, nulls_last: bool = False) -> Column:
    """array<bigint> that sorts (ascending, element by element) as the key does."""
    whole = False
    if isinstance(dtype, (ByteType, ShortType, IntegerType, LongType, BooleanType)):
        code, whole = c.cast("int").cast("bigint") if isinstance(dtype, BooleanType) else c.cast("bigint"), True
    elif isinstance(dtype, DateType):
        code = F.unix_date(c).cast("bigint")
    elif isinstance(dtype, TimestampType):
        code, whole = F.unix_micros(c), True
    elif isinstance(dtype, TimestampNTZType):
        code, whole = _ntz_micros(c), True
    elif isinstance(dtype, (FloatType, DoubleType)):
        code = _double_code(c)
    elif isinstance(dtype, DecimalType) and dtype.precision <= 18:
        code = (c * F.lit(10 ** dtype.scale).cast(DecimalType(dtype.scale + 1, 0))).cast("bigint")
    elif isinstance(dtype, DecimalType) and dtype.precision < 38:
        # all positive and of one length, so the digits sort as text
        up = c + F.lit("1" + "0" * (dtype.precision - dtype.scale)).cast(DecimalType(dtype.precision - dtype.scale + 1, 0))
        code = _text_codes(F.lpad(up.cast("string"), dtype.precision + 3, "0"))
    elif isinstance(dtype, StringType):
        code = _text_codes(c)
    else:
        raise ValueError(f"unsupported range key type {dtype.simpleString()}")
    many = isinstance(dtype, (StringType, DecimalType)) and not (isinstance(dtype, DecimalType) and dtype.precision <= 18)
    if desc:
        code = F.transform(code, F.bitwise_not) if many else F.bitwise_not(code)
    codes = code if many else F.array(code)
    end, mark = (HIGH, 1) if nulls_last else (LOW, 0)
    null = F.array(F.lit(end).cast("bigint"), F.lit(mark).cast("bigint"))
    if whole:  # a value may equal the code of null; a second code tells them apart
        own = F.array(F.lit(end).cast("bigint"), F.lit(1 - mark).cast("bigint"))
        codes = F.when(code == F.lit(end), own).otherwise(codes)
    return F.when(c.isNull(), null).otherwise(codes)


def order_codes(df: DataFrame, keys: Sequence[Key]) -> Column:
    """One array<bigint> whose order is that of all ``keys`` of ``df``."""
    return F.concat(*[key_codes(k.col(), df.select(k.col()).schema[0].dataType, k.desc, k.nulls_last) for k in keys])


def below(bounds: Column, codes: Column, most: int) -> Column:
    """How many of the sorted ``bounds`` (no more than ``most``) are at or below ``codes``: a binary search."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, most.bit_length())))])
    n = F.size(bounds)
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= n) & (F.get(bounds, F.least(at + step, n) - 1) <= codes), at + step).otherwise(at))


def same_group(names: Sequence[str], suffix: str) -> Column:
    """Null-safe equality of group columns with their renamed copies; true without groups."""
    return reduce(and_, [F.col(c).eqNullSafe(F.col(f"{c}{suffix}")) for c in names], F.lit(True))


def _given(rows: DataFrame, small: DataFrame, names: Sequence[str], suffix: str, how: str) -> DataFrame:
    """``rows`` with the row of a bounded table that belongs to their group (one row without groups)."""
    small = small.withColumnsRenamed({c: f"{c}{suffix}" for c in names})
    if not names:
        return rows.crossJoin(F.broadcast(small))
    return rows.join(F.broadcast(small), same_group(names, suffix), how).drop(*[f"{c}{suffix}" for c in names])


def range_bounds(rows: DataFrame, n_rows: int, groups: Sequence[str], codes: str, per_range: int) -> DataFrame | None:
    """(groups..., ``__bounds``) of the groups with more than ``per_range`` rows; none if there is no such group.

    No more than rows / ``per_range`` groups are that large, and their bounds are no
    more than twice that, so the table may be sent to all tasks.
    """
    spark = rows.sparkSession
    kinds = [rows.schema[g] for g in groups]
    part = StructType([*[StructField(f.name, f.dataType) for f in kinds], StructField("__p", ArrayType(LongType()))])
    if n_rows <= per_range:
        return None
    if groups:
        large = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > per_range).collect()
        todo = [(tuple(r[g] for g in groups), ()) for r in large]
        most = max((r["n"] for r in large), default=0)
    else:
        most = n_rows
        todo = [((), ())]
    found: dict[tuple, set] = {}
    cuts = math.ceil(most / per_range)  # ranges of the largest group; smaller ones take some of its quantiles
    ranks = F.array(*[F.lit(i / cuts) for i in range(1, cuts)])
    items = min(MOST_ITEMS, max(LEAST_ITEMS, ITEMS_PER_RANGE * cuts))
    level = 0
    while todo:
        prefixes = spark.createDataFrame([(*g, list(p)) for g, p in todo], part)
        own = _given(rows.select(*groups, codes), prefixes, groups, "_p", "inner") if groups else \
            rows.select(codes).crossJoin(F.broadcast(prefixes))
        if level:
            own = own.filter(F.slice(codes, 1, level) == F.col("__p"))
        ranges = F.ceil(F.col("n") / per_range).cast("int")
        cut = own.withColumn("c", F.get(codes, F.lit(level))).filter("c IS NOT NULL").groupBy(*groups, "__p") \
            .agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_bigint("c", items).alias("s")) \
            .filter(F.col("n") > per_range) \
            .withColumn("all", F.kll_sketch_get_quantile_bigint("s", ranks)) \
            .select(*groups, "__p", F.transform(F.sequence(F.lit(1), ranges - 1), lambda i: F.get(
                "all", F.round(i * cuts / ranges).cast("int") - 1)).alias("q")).collect()
        todo = []
        for r in cut:
            group, prefix, q = tuple(r[g] for g in groups), tuple(r["__p"]), r["q"]
            bounds = found.setdefault(group, set())
            bounds.update((*prefix, v) for v in q)
            # a code met twice holds a range's rows or more: the next code cuts them
            todo.extend((group, (*prefix, v)) for v in sorted({a for a, b in zip(q, q[1:]) if a == b}))
        level += 1
    if not found:
        return None
    out = StructType([*part.fields[:-1], StructField("__bounds", ArrayType(ArrayType(LongType())))])
    return spark.createDataFrame([(*g, [list(b) for b in sorted(bs)]) for g, bs in found.items()], out)


def with_ranges(rows: DataFrame, groups: Sequence[str], codes: str, bounds: DataFrame, out: str,
                how: str = "left") -> DataFrame:
    """``rows`` with the number of their range in ``out`` (0 in groups without bounds; ``how="inner"``: without those)."""
    held = _given(rows, bounds, groups, "_b", how)
    found = below(F.col("__bounds"), F.col(codes), 4 * MAX_RANGES)
    return held.withColumn(out, F.when(F.col("__bounds").isNull(), F.lit(0)).otherwise(found)).drop("__bounds")


def rows_per_range(n_rows: int, ranges: int | None = None) -> int:
    """Rows that a range should hold: ``ranges`` of them, or enough rows each, and never more than MAX_RANGES."""
    if ranges is not None:
        return max(1, math.ceil(n_rows / ranges))
    return max(MIN_ROWS_PER_RANGE, math.ceil(n_rows / MAX_RANGES))
