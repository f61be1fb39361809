"""Features, stable split, random forest, scoring (L1-L4).

The reference pulls the table into pandas and fits scikit-learn on the
driver.  Here MLlib trains on the executors; the split is a hash of the key
so it is the same at any partitioning.  The label is computed from a feature
(position = 1) and all rows are scored, train and test alike — kept as the
reference defines it (quirk 22); ``binary_metrics`` tells the parts apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.functions.keys import hash_split
from podium.operators.ranges import Key, order_codes, range_bounds, rows_per_range, same_group, with_ranges
from podium.session import written


def add_features(df: DataFrame, inputs: Sequence[str], label: Column, out: str = "features",
                 label_col: str = "label") -> DataFrame:
    """Assemble ``inputs`` into a vector; rows with a null input are skipped (L1)."""
    assembled = VectorAssembler(inputCols=list(inputs), outputCol=out, handleInvalid="skip")
    return assembled.transform(df.withColumn(label_col, label.cast("int")))


def features_as_columns(df: DataFrame, vector: str = "features", names: Sequence[str] = ()) -> DataFrame:
    arr = vector_to_array(F.col(vector))
    return df.withColumns({n: F.get(arr, i) for i, n in enumerate(names)})


def add_split(df: DataFrame, key: str, seed: int = 42, train_share_256: int = 204,
              out: str = "is_train") -> DataFrame:
    """Hash split (L2): 204/256 = 79.7 % train, a function of the key alone."""
    return df.withColumn(out, hash_split(F.col(key), seed, train_share_256))


def fit_forest(train: DataFrame, key: str, num_trees: int = 100, seed: int = 42,
               features: str = "features", label: str = "label",
               partitions: int | None = None) -> RandomForestClassificationModel:
    """Random forest on the executors (L3).

    MLlib's bootstrap depends on row placement, so rows are placed by a hash of
    the key into ``partitions`` (default: the shuffle partition count) and
    sorted by key inside each: the same forest comes out at any input
    partitioning.  The forest scans its input several times (metadata, split
    candidates, binned points), so the placed rows are persisted for the fit
    and released after; a lost executor's blocks are recomputed from lineage.
    """
    n = partitions or int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = train.select(key, features, label).repartition(n, key).sortWithinPartitions(key) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rf = RandomForestClassifier(numTrees=num_trees, seed=seed, featuresCol=features, labelCol=label)
        fitted = rf.fit(ordered)
        # the training summary holds the session, which cannot go to the tasks once it has observed a query
        fitted._java_obj.setSummary(train.sparkSession.sparkContext._jvm.scala.Option.empty())
        return fitted
    finally:
        ordered.unpersist()


def score(model: RandomForestClassificationModel, df: DataFrame, out: str = "win_probability") -> DataFrame:
    """Probability of class 1 for every row (L4); 0 when only one class was seen."""
    scored = model.transform(df)
    p = F.coalesce(F.get(vector_to_array(F.col(model.getProbabilityCol())), 1), F.lit(0.0))
    return scored.withColumn(out, p).drop(model.getProbabilityCol(), model.getRawPredictionCol(),
                                          model.getPredictionCol())


def binary_metrics(scored: DataFrame, label: str, score: str, groups: Sequence[str] = (), bins: int = 10) -> DataFrame:
    """(groups..., n, positives, auc, brier, ece): how well a score in 0 to 1 tells label 1 from 0 (L4).

    ``auc`` is exact at any number of thresholds: the chance that a positive row scores
    higher than a negative one, ties counting half, null without both.  ``ece`` is the mean
    distance of score and share of positives over ``bins`` equal ranges.  Rows with a null
    score or label are left out.

    Rows are first counted by distinct score; the scores are then cut into ranges, so the
    negatives below a score are those of the ranges before and those before it in its
    own, and no task holds all scores of a group.
    """
    y, s = F.col(label).cast("int"), F.col(score).cast("double")
    cells = written(scored.select(*groups, s.alias("__s"), y.alias("__y")).filter("__s IS NOT NULL AND __y IS NOT NULL")
                    .groupBy(*groups, "__s").agg(F.count_if(F.col("__y") == 1).alias("__pos"), F.count_if(F.col("__y") != 1)
                                                 .alias("__neg")), "score-counts")
    n_cells = cells.count()
    coded = cells.withColumn("__k", order_codes(cells, [Key("__s")]))
    bounds = range_bounds(coded.select("__k"), n_cells, [], "__k", rows_per_range(n_cells))
    ranged = coded.withColumn("__r", F.lit(0)) if bounds is None else with_ranges(coded, [], "__k", bounds, "__r")
    sums = ranged.groupBy(*groups, "__r").agg(F.sum("__neg").alias("__n"))
    before = Window.partitionBy(*groups).orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*[F.col(g).alias(f"{g}_o") for g in groups], F.col("__r").alias("__r_o"),
                          F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    inside = Window.partitionBy(*groups, "__r").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    below = ranged.join(offsets, same_group(groups, "_o") & (F.col("__r") == F.col("__r_o"))) \
        .withColumn("__below", F.col("__off") + F.coalesce(F.sum("__neg").over(inside), F.lit(0)))
    part = below.withColumn("__bin", F.least(F.floor(F.col("__s") * bins), F.lit(bins - 1))).groupBy(*groups, "__bin").agg(
        F.sum(F.col("__pos") + F.col("__neg")).alias("__n"), F.sum("__pos").alias("__p"),
        F.sum(F.col("__pos") * (F.col("__below") + F.col("__neg") / 2)).alias("__won"),
        F.sum((F.col("__pos") + F.col("__neg")) * F.col("__s")).alias("__sum"),
        F.sum(F.col("__pos") * (1 - F.col("__s")) ** 2 + F.col("__neg") * F.col("__s") ** 2).alias("__sq"))
    n, p = F.sum("__n"), F.sum("__p")
    return part.groupBy(*groups).agg(
        n.alias("n"), p.alias("positives"), F.try_divide(F.sum("__won"), p * (n - p)).alias("auc"),
        (F.sum("__sq") / n).alias("brier"), (F.sum(F.abs(F.col("__sum") - F.col("__p"))) / n).alias("ece"))
