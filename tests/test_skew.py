"""Hot and null keys: found by sketch, spread without AQE, answers as a plain join gives them."""

import pytest
from pyspark.sql import functions as F

from podium.operators import conform
from podium.operators.skew import HOT_SALT, heavy_keys, left_join_even, left_join_spread


@pytest.fixture()
def shuffled(spark):
    """No broadcast and no adaptive execution."""
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.shuffle.partitions": "32"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def _facts(spark, n=30_000):
    """A third of the rows share one key, a sixth have none, the rest are spread over 5,000 keys."""
    k = F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 6 == 1, None).otherwise(F.col("id") % 5000)
    return spark.range(n).select("id", k.alias("k"))


def test_heavy_keys_finds_all_that_hold_a_share(spark):
    facts = _facts(spark)
    hashed = {r.k: r.h for r in spark.createDataFrame([(-1,), (7,)], "k long").select("k", F.xxhash64("k").alias("h")).collect()}
    found = heavy_keys(facts, ["k"])
    assert hashed[-1] in found and hashed[7] not in found and len(found) < 10
    assert heavy_keys(facts.filter("k IS NULL"), ["k"]) == []
    assert heavy_keys(facts.limit(0), ["k"]) == []
    # a key with little more than the share is found as well
    few = spark.range(60_000).select(F.when(F.col("id") < 300, F.lit(-5)).otherwise(F.col("id")).alias("k"))
    assert few.limit(1).select(F.xxhash64(F.lit(-5).cast("long")).alias("h")).first().h in heavy_keys(few, ["k"])


def test_hot_key_is_spread_without_aqe(spark, shuffled):
    facts = _facts(spark)
    dim = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")) \
        .unionByName(spark.createDataFrame([(-1, 99)], "k long, v long"))

    def largest(df):
        return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

    plain = facts.join(dim, "k", "left")
    even = left_join_even(facts, dim, ["k"])
    assert largest(plain) > 9_000
    assert largest(even) < 3_000
    assert sorted(map(tuple, even.select("id", "k", "v").collect()), key=str) == \
        sorted(map(tuple, plain.select("id", "k", "v").collect()), key=str)


def test_spread_copies_only_hot_rows(spark, shuffled):
    facts, dim = _facts(spark, 3000), spark.createDataFrame([(-1, 1), (2, 2)], "k long, v long")
    hot = heavy_keys(facts, ["k"])
    joined = left_join_spread(facts, dim, ["k"], hot)
    assert joined.count() == 3000
    assert joined.filter("v = 1").count() == 1000
    assert HOT_SALT > 1


def test_lookup_and_correction_with_hot_keys(spark, shuffled):
    """Only rows without a key enter the correction join; rows and values as by hand."""
    facts = _facts(spark, 6000).withColumn("lane", F.when(F.col("id") % 2 == 0, F.lit("a")).otherwise(F.lit("b")))
    dim = spark.range(3000).select(F.col("id").cast("int").alias("key"))
    looked = conform.lookup_fk(facts, dim, [(F.col("k"), "key")], "key", "fk")
    fixes = spark.createDataFrame([("a", 11), ("b", 22)], "lane string, fix int")
    fixed = conform.correct_null(looked, "fk", fixes, [("lane", "lane")], "fix")
    rows = fixed.collect()
    assert len(rows) == 6000
    for r in rows:
        own = r.k if r.k is not None and 0 <= r.k < 3000 else None
        assert r.fk == (own if own is not None else 11 if r.lane == "a" else 22)
    plan = fixed._jdf.queryExecution().optimizedPlan().toString()
    assert "isnull(fk" in plan and "isnotnull(fk" in plan


def test_registry_keeps_keys(spark, tmp_path):
    path = str(tmp_path / "registry")
    one = spark.createDataFrame([("b", 1), ("a", None), ("c", 3)], "x string, y int")
    first = {(r.x, r.y): r.id for r in conform.register_keys(one, ["x", "y"], path).collect()}
    assert first == {("a", None): 1, ("b", 1): 2, ("c", 3): 3}
    two = spark.createDataFrame([("a", 0), ("b", 1), ("a", None), ("c", 3), ("a", 0)], "x string, y int")
    again = {(r.x, r.y): r.id for r in conform.register_keys(two, ["x", "y"], path).collect()}
    assert again == {**first, ("a", 0): 4}
    assert {(r.x, r.y): r.id for r in conform.register_keys(one, ["x", "y"], path).collect()} == first
