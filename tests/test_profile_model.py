import math
import random

import duckdb
from pyspark.sql import functions as F

from podium.operators import model, profile
from podium.operators.rank import Key


def test_exact_quantiles_match_duckdb(spark):
    rows = [(i % 3, float((i * 7919) % 1013) / 7) for i in range(2000)] + [(3, 1.0)]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r.g: (r.a, r.b, r.c) for r in profile.exact_quantiles(
        df, "v", ["g"], [0.1, 0.5, 0.9], ["a", "b", "c"]).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(g INT, v DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    exp = {g: (a, b, c) for g, a, b, c in con.sql(
        "SELECT g, quantile_cont(v, 0.1), quantile_cont(v, 0.5), quantile_cont(v, 0.9) FROM t GROUP BY g").fetchall()}
    assert got.keys() == exp.keys()
    for g in exp:
        assert all(abs(x - y) < 1e-9 for x, y in zip(got[g], exp[g]))


def test_selection_against_sorting(spark, monkeypatch):
    """Hot values, wide ranges, tiny and huge numbers, null groups: the values that a sort gives, in many passes too."""
    rnd = random.Random(5)
    values = [0.0, -0.0, 1e-310, -1e-310, 5e-324, 1e300, -1e300, 1.0, 1.0 + 2 ** -52, 3.5, None, float("inf"), float("-inf")]
    rows = [(rnd.choice(["a", "b", None]), rnd.choice(values) if rnd.random() < .3 else rnd.gauss(0, 10) ** 5) for _ in range(3000)]
    rows += [("hot", 7.0)] * 2000 + [("one", 4.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = [0.0, 0.001, 0.25, 0.5, 0.77, 1.0]
    for few, bins in ((4096, 4096), (3, 5)):
        monkeypatch.setattr(profile, "FEW", few)
        monkeypatch.setattr(profile, "BINS", bins)
        got = {r[0]: r[1:] for r in profile.exact_quantiles(df, "v", ["g"], probs).collect()}
        for g in ("a", "b", None, "hot", "one"):
            v = sorted(x for k, x in rows if k == g and x is not None)
            for p, q in zip(probs, got[g]):
                at = (len(v) - 1) * p
                low, high = v[math.floor(at)], v[math.ceil(at)]
                want = low if low == high else low + (high - low) * (at - math.floor(at))
                assert q == want or (math.isnan(q) and math.isnan(want)) or abs(q - want) <= 1e-12 * abs(want)


def test_box_stats_against_a_loop(spark, monkeypatch):
    rnd = random.Random(6)
    rows = [(g, rnd.choice([1.0, 2.0, rnd.gauss(0, 3) ** 3])) for g in ("x", None) for _ in range(800)]
    df = spark.createDataFrame(rows, "g string, v double")
    for bins in (4096, 7):
        monkeypatch.setattr(profile, "BINS", bins)
        for r in profile.box_stats(df, "v", ["g"], digits=None).collect():
            v = [x for k, x in rows if k == r.g]
            iqr = r.q3 - r.q1
            assert r.n_outliers == sum(x < r.q1 - 1.5 * iqr or x > r.q3 + 1.5 * iqr for x in v)
    assert profile.box_stats(df.limit(0), "v", ["g"]).count() == 0
    assert profile.exact_quantiles(df, "v", [], [0.5], ["m"]).count() == 1


def test_box_stats_counts_outliers(spark):
    rows = [("a", float(v)) for v in range(1, 101)] + [("a", 1000.0), ("a", -1000.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    r = profile.box_stats(df, "v", ["g"]).first()
    assert r.n_outliers == 2 and r.q2 == 50.5


def test_describe_and_value_counts(spark):
    df = spark.createDataFrame([(1, "x"), (3, "y"), (None, "x")], "a int, s string")
    d = {r.col: r for r in profile.describe_cols(df, ["a"]).collect()}
    assert d["a"].n == 2 and d["a"].mean == 2.0 and d["a"].lo == 1.0 and d["a"].hi == 3.0
    t = profile.describe_cols(df, ["s", "a"]).filter("col = 's'").first()
    assert (t.n, t.mean, t.lo, t.lo_text, t.hi_text) == (3, None, None, "x", "y")
    vc = {(r.col, r.value): r.n for r in profile.value_counts(df, ["a", "s"]).collect()}
    assert vc == {("a", "1"): 1, ("a", "3"): 1, ("s", "x"): 2, ("s", "y"): 1}


def test_schema_report(spark):
    df = spark.createDataFrame([(1, "x")], "a int, s string")
    assert [(r.column_name, r.type) for r in profile.schema_report(df).collect()] == [("a", "int"), ("s", "string")]


def test_hash_split_is_stable_and_near_share(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    a = model.add_split(df.repartition(1), "k").filter("is_train").count()
    b = model.add_split(df.repartition(13), "k").filter("is_train").count()
    assert a == b and abs(a / 20000 - 204 / 256) < 0.02


def test_forest_scores_are_probabilities_and_stable(spark):
    rows = [(i, float(i % 9), float((i * 31) % 17), int(i % 9 == 0)) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, a double, b double, y int")
    feats = model.add_features(df, ["a", "b"], F.col("y") == 1)
    tops, scores = [], []
    for parts in (1, 8):
        f = model.fit_forest(feats.repartition(parts), "k", num_trees=10, seed=42)
        scored = model.score(f, feats)
        assert scored.filter((F.col("win_probability") < 0) | (F.col("win_probability") > 1)).count() == 0
        from podium.operators.rank import top_k
        tops.append([r.k for r in top_k(scored, 3, [Key("win_probability", desc=True), "k"]).collect()])
        scores.append({r.k: r.win_probability for r in scored.select("k", "win_probability").collect()})
    assert tops[0] == tops[1]
    assert scores[0] == scores[1]  # the same forest at any input partitioning


def test_binary_metrics_against_pairs(spark, monkeypatch):
    """AUC by comparing all pairs; ties, one-sided groups, null groups, scores and labels; one range and many."""
    from podium.operators import ranges
    rnd = random.Random(4)
    rows = [(rnd.choice(["a", None]), rnd.choice([0, 1]), rnd.choice([0.0, 0.25, 1.0, rnd.random()])) for _ in range(300)]
    rows += [("one", 1, 0.5), ("one", 1, 0.6), ("x", None, 0.1), ("a", 1, None)]
    df = spark.createDataFrame(rows, "g string, y int, s double")
    for per in (500_000, 7):
        monkeypatch.setattr(ranges, "MIN_ROWS_PER_RANGE", per)
        got = {r.g: r for r in model.binary_metrics(df, "y", "s", ["g"]).collect()}
        assert set(got) == {"a", None, "one"} and got["one"].auc is None and got["one"].positives == 2
        for g in ("a", None):
            own = [(y, s) for k, y, s in rows if k == g and y is not None and s is not None]
            pos, neg = [s for y, s in own if y], [s for y, s in own if not y]
            auc = sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))
            assert got[g].n == len(own) and abs(got[g].auc - auc) < 1e-12
            assert abs(got[g].brier - sum((s - y) ** 2 for y, s in own) / len(own)) < 1e-12
