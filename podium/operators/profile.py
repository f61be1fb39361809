"""Profiling: schema, summary statistics, value counts, box statistics (K1-K4)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from podium.session import written


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: name, type, nullable (K1) — from the schema, no job."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, type string, nullable boolean")


def names_frame(spark: SparkSession, names: Sequence[str], col: str = "column_name") -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], f"{col} string")


def describe_cols(df: DataFrame, cols: Sequence[str], digits: int | None = 4) -> DataFrame:
    """count, mean, sample stddev, min, max per column (K2), long form.

    Numbers have ``lo`` and ``hi`` as doubles; text has ``lo_text`` and ``hi_text``, and mean
    and stddev of those values that are numbers.  One aggregate pass over the data
    (partial aggregation per task), then the single result row is unpivoted.
    """
    r = (lambda e: F.round(e, digits)) if digits is not None else (lambda e: e)
    aggs, rows = [], []
    for i, c in enumerate(cols):
        x, text = F.col(c), isinstance(df.schema[c].dataType, StringType)
        number = x.try_cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(number).alias(f"m{i}"), F.stddev_samp(number).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
        ends = {kind: [F.col(f"{e}{i}").cast(kind) if text == (kind == "string") else F.lit(None).cast(kind)
                       for e in ("lo", "hi")] for kind in ("double", "string")}
        rows.append(F.struct(
            F.lit(c).alias("col"), F.col(f"n{i}").alias("n"), r(F.col(f"m{i}")).alias("mean"), r(F.col(f"s{i}")).alias("sd"),
            ends["double"][0].alias("lo"), ends["double"][1].alias("hi"),
            ends["string"][0].alias("lo_text"), ends["string"][1].alias("hi_text")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def value_counts(df: DataFrame, cols: Sequence[str], keep_nulls: bool = False) -> DataFrame:
    """Count per value for several columns in one pass (K3): unpivot, then group.

    Nulls are left out, as the reference's count plots do.
    """
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], list(cols), "col", "value")
    if not keep_nulls:
        long = long.filter(F.col("value").isNotNull())
    return long.groupBy("col", "value").agg(F.count(F.lit(1)).alias("n"))


#: Bins that a range of values is cut into in one pass.
BINS = 4096
#: A range with no more values than this is sorted inside one aggregate.
FEW = 4096


def _of_group(rows: DataFrame, table: DataFrame, groups: Sequence[str], where: Column, how: str = "inner") -> DataFrame:
    """``rows`` with the rows of ``table`` of their group that meet ``where``; a null group is a group like any other.

    ``table`` has a few rows a group; the planner sends it to the tasks if it is
    small, and else shuffles both sides on the group.
    """
    renamed = table.withColumnsRenamed({g: f"__of_{g}" for g in groups})
    same = reduce(and_, [F.col(g).eqNullSafe(F.col(f"__of_{g}")) for g in groups], where)
    return rows.join(renamed, same, how).drop(*[f"__of_{g}" for g in groups])


def _first_bin(v: Column) -> Column:
    """Bin of a double by sign and power of two; zero, the infinities and NaN have their own."""
    power = F.floor(F.least(F.log2(F.abs(v)), F.lit(1100.0))) + 1100
    return F.when(F.isnan(v), F.lit(9999)).when(v == 0, F.lit(0)).otherwise(F.signum(v) * power).cast("int")


def _cells(rows: DataFrame, groups: Sequence[str]) -> DataFrame:
    """(groups..., b, n, lo, hi): how many values each bin holds, and the least and largest of them."""
    v = F.col("__v")
    return rows.groupBy(*groups, _first_bin(v).alias("__b")).agg(
        F.count(F.lit(1)).alias("__n"), F.min(v).alias("__lo"), F.max(v).alias("__hi"))


def _placed(targets: DataFrame, cells: DataFrame, groups: Sequence[str], within: Sequence[str]) -> DataFrame:
    """``targets`` (groups..., within..., __j, __rank) moved into the cell that holds their rank."""
    upto = Window.partitionBy(*groups, *within).orderBy("__b")
    bounded = cells.withColumn("__upto", F.sum("__n").over(upto)).withColumn("__before", F.col("__upto") - F.col("__n")) \
        .withColumnsRenamed({c: f"{c}_in" for c in within})
    where = (F.col("__rank") > F.col("__before")) & (F.col("__rank") <= F.col("__upto"))
    for c in within:
        where = where & F.col(c).eqNullSafe(F.col(f"{c}_in"))
    return _of_group(targets, bounded, groups, where)


def _selected(rows: DataFrame, cells: DataFrame, groups: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(groups..., __j, __of, __value): the values at the two ranks around each quantile, by narrowing ranges of values.

    Every pass counts the values of the ranges that still hold a wanted rank in
    ``BINS`` bins each and keeps the bins that hold them: only counts are shuffled, and
    a group of any size is summed up in the tasks first.
    """
    n = cells.groupBy(*groups).agg(F.sum("__n").alias("__of"))
    ranks = [F.struct(F.lit(2 * i + k).alias("j"), (step((F.col("__of") - 1) * F.lit(float(p))) + 1).cast("long").alias("r"))
             for i, p in enumerate(probs) for k, step in enumerate((F.floor, F.ceil))]
    targets = n.withColumn("__t", F.explode(F.array(*ranks))).select(
        *groups, "__of", F.col("__t.j").alias("__j"), F.col("__t.r").alias("__rank"))
    own = [*groups, "__of", "__j"]
    inside = F.col("__rank") - F.col("__before")
    state = written(_placed(targets, cells, groups, ()).select(
        *own, inside.alias("__rank"), "__lo", "__hi", "__n"), "quantile-ranges")
    closed = state.filter("NOT __lo < __hi").select(*own, F.col("__lo").alias("__value"))
    todo = state.filter("__lo < __hi")
    v = F.col("__v")
    while not todo.isEmpty():
        ranges = todo.select(*groups, F.col("__lo").alias("__from"), F.col("__hi").alias("__to"),
                             (F.col("__n") <= FEW).alias("__few")).distinct()
        held = _of_group(rows, ranges, groups, v.between(F.col("__from"), F.col("__to")))
        share = (v - F.col("__from")) / (F.col("__to") - F.col("__from"))
        fine = held.withColumn("__b", F.when(F.col("__few"), F.lit(0)).otherwise(F.floor(share * BINS)).cast("int")) \
            .groupBy(*groups, "__from", "__to", "__b").agg(
                F.count(F.lit(1)).alias("__n"), F.min(v).alias("__lo"), F.max(v).alias("__hi"),
                F.sort_array(F.collect_list(F.when(F.col("__few"), v))).alias("__all"))
        moved = _placed(todo.select(*own, "__rank", F.col("__lo").alias("__from"), F.col("__hi").alias("__to")), fine,
                        groups, ("__from", "__to"))
        picked = F.get("__all", (inside - 1).cast("int"))
        state = written(moved.select(
            *own, inside.alias("__rank"), F.coalesce(picked, "__lo").alias("__lo"),
            F.coalesce(picked, "__hi").alias("__hi"), "__n"), "quantile-ranges")
        closed = closed.unionByName(state.filter("NOT __lo < __hi").select(*own, F.col("__lo").alias("__value")))
        todo = state.filter("__lo < __hi")
    return closed


def _values(df: DataFrame, value: str, groups: Sequence[str]) -> DataFrame:
    return df.select(*groups, F.col(value).cast("double").alias("__v")).filter("__v IS NOT NULL")


def _quantiles(rows: DataFrame, cells: DataFrame, groups: Sequence[str], probs: Sequence[float],
               names: Sequence[str]) -> DataFrame:
    got = _selected(rows, cells, groups, probs).groupBy(*groups).agg(F.first("__of").alias("__of"), *[
        F.max(F.when(F.col("__j") == j, F.col("__value"))).alias(f"__q{j}") for j in range(2 * len(probs))])

    def between(i: int, p: float) -> Column:
        low, high, at = F.col(f"__q{2 * i}"), F.col(f"__q{2 * i + 1}"), (F.col("__of") - 1) * F.lit(float(p))
        return F.when(low == high, low).otherwise(low + (high - low) * (at - F.floor(at)))

    return got.select(*groups, *[between(i, p).alias(nm) for i, (p, nm) in enumerate(zip(probs, names))])


def exact_quantiles(df: DataFrame, value: str, groups: Sequence[str], probs: Sequence[float],
                    names: Sequence[str] | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles per group (``percentile`` semantics, values as doubles).

    Spark's exact ``percentile`` keeps every distinct value of a group in one
    aggregation buffer, and a sort keeps every value; here the ranks are selected by counts
    of value ranges, in the same way for a group of ten rows and one of a third of the table.
    """
    names = list(names or [f"q{i}" for i in range(len(probs))])
    rows = _values(df, value, groups)
    return _quantiles(rows, written(_cells(rows, groups), "quantile-cells"), groups, probs, names)


def box_stats(df: DataFrame, value: str, groups: Sequence[str], whisker: float = 1.5,
              digits: int | None = 4) -> DataFrame:
    """Quartiles and the count of points outside ``whisker`` * IQR fences (K4).

    The outliers come from the counts that the quartiles came from: bins beyond a
    fence count whole, and only the values of the bins that a fence cuts are looked at again.
    """
    rows = _values(df, value, groups)
    cells = written(_cells(rows, groups), "quantile-cells")
    iqr = F.col("q3") - F.col("q1")
    q = written(_quantiles(rows, cells, groups, [0.25, 0.5, 0.75], ["q1", "q2", "q3"])
                .withColumn("__low", F.col("q1") - F.lit(whisker) * iqr)
                .withColumn("__high", F.col("q3") + F.lit(whisker) * iqr), "quartiles")
    fenced = _of_group(cells, q, groups, F.lit(True))
    beyond = (F.col("__hi") < F.col("__low")) | (F.col("__lo") > F.col("__high"))
    cut = ~beyond & ((F.col("__lo") < F.col("__low")) | (F.col("__hi") > F.col("__high")))
    whole = fenced.groupBy(*groups).agg(F.sum(F.when(beyond, F.col("__n")).otherwise(0)).alias("__c"))
    v = F.col("__v")
    parts = fenced.filter(cut).select(*groups, "__lo", "__hi", "__low", "__high")
    some = _of_group(rows, parts, groups, v.between(F.col("__lo"), F.col("__hi"))).groupBy(*groups).agg(
        F.count_if((v < F.col("__low")) | (v > F.col("__high"))).alias("__c"))
    out = whole.unionByName(some).groupBy(*groups).agg(F.sum("__c").alias("n_outliers"))
    r = (lambda c: F.round(F.col(c), digits)) if digits is not None else F.col
    return _of_group(out, q, groups, F.lit(True)).select(
        *groups, r("q1").alias("q1"), r("q2").alias("q2"), r("q3").alias("q3"), "n_outliers")


def box_stats_columns(df: DataFrame, cols: Sequence[str], **kw) -> DataFrame:
    """Box statistics for all given numeric columns in one job."""
    cols = list(cols)
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "column_name", "value")
    return box_stats(long, "value", ["column_name"], **kw)
