"""Components of a graph that is only known as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.common import discard, materialise

#: Star steps run in a task for so many nodes (one for each core at least, the session's number of shuffle partitions at most).
NODES_A_TASK = 20_000
#: Two star steps a round; the number of rounds grows with the square of the logarithm of the longest chain.
MAX_ROUNDS = 100


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).repartition("a")
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    dealt = edges.repartition("a")  # for the minimum and the join: one shuffle
    low = dealt.groupBy("a").agg(F.min("b").alias("m"))
    ends = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
    return dealt.join(low, "a").select(F.explode(ends).alias("e")).select("e.*").filter("a <> b").distinct()


def _are_stars(edges: DataFrame) -> tuple[bool, int]:
    """Whether every edge (a, b) is the only one of its a, and its b is the a of none; the number of nodes."""
    ends = F.array(F.struct(F.col("a").alias("h"), F.lit(1).alias("up")), F.struct(F.col("b").alias("h"), F.lit(0).alias("up")))
    seen = edges.select(F.explode(ends).alias("e")).select("e.*").groupBy("h").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    other, nodes = seen.agg(F.max((F.col("ups") > 1) | (F.col("ups") > F.col("least"))), F.count(F.lit(1))).first()
    return other is not True, nodes


def components(links: DataFrame, rounds: int = MAX_ROUNDS) -> DataFrame:
    """(h, c): the smallest node that the links (a, b) connect each node with; nodes without links are absent.

    Alternating large-star and small-star steps until the edges are stars, each node
    tied to the smallest of its component alone.  Every step is a grouped minimum and a
    join on it, in one shuffle.  Raises if ``rounds`` do not suffice.
    """
    edges = materialise(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .filter("a <> b").distinct(), "links")
    for left in range(rounds, -1, -1):
        stars, nodes = _are_stars(edges)
        if stars:
            ends = F.array(F.struct(F.col("a").alias("h"), F.col("b").alias("c")), F.struct(F.col("b").alias("h"), F.col("b").alias("c")))
            return edges.select(F.explode(ends).alias("e")).select("e.*").groupBy("h").agg(F.min("c").alias("c"))
        if left:
            before, tasks = edges, max(edges.sparkSession.sparkContext.defaultParallelism, nodes // NODES_A_TASK)
            edges = materialise(_small_star(_large_star(before).coalesce(tasks)).coalesce(tasks), "stars")
            discard(before)
    raise RuntimeError(f"components: edges still change after {rounds} rounds")
