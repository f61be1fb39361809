"""Mixing sources to target weights by hierarchical budgets (built-in expressions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.common import materialise

SEED = 17
#: A leaf's permutation is cut into so many runs of the hash order (hex digits: 16^3)
#: before one of them is looked at row by row.
CUT_DIGITS = 3
#: A leaf's rows meet its budget in so many places where the table of leaves is too
#: large for the planner to broadcast it.
SALTS = 64
NONE = "(none)"


def token_estimate(text: Column) -> Column:
    """Tokens of a text as the budget counts them: a quarter of its UTF-8 bytes, at least one."""
    return F.greatest(F.lit(1), F.ceil(F.coalesce(F.octet_length(text), F.lit(0)) / 4)).cast("long")


def _weight(level: str, weights: dict[str, int], default: int) -> Column:
    out = F.lit(default)
    for name, w in sorted(weights.items()):
        out = F.when(F.col(level) == name, F.lit(w)).otherwise(out)
    return out.cast("long")


def _fill(children: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Share ``budget`` among the children of a parent by ``w``, none above its ``cap``.

    Children in ascending order of cap / w: one is saturated if its fair share of what
    the ones before left over reaches its cap; the rest share the rest.  What rounding
    leaves goes to the first of them by name, a token each.
    """
    big = "decimal(38,0)"
    ratio = Window.partitionBy(*parents).orderBy((F.col("cap").cast("double") / F.col("w")), name)
    past = ratio.rowsBetween(Window.unboundedPreceding, -1)
    here = ratio.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(*parents)
    t = children.withColumn("goal", F.least("budget", F.sum("cap").over(whole))) \
        .withColumn("left", F.col("goal") - F.coalesce(F.sum("cap").over(past), F.lit(0))) \
        .withColumn("rest", F.sum("w").over(here)) \
        .withColumn("full", F.col("cap").cast(big) * F.col("rest") <= F.col("left").cast(big) * F.col("w"))
    open_w = F.sum(F.when(~F.col("full"), F.col("w")).otherwise(0)).over(whole)
    used = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(whole)
    t = t.withColumn("pool", F.col("goal") - used).withColumn("open_w", open_w)
    t = t.withColumn("share", F.when(F.col("full"), F.col("cap")).otherwise(
        F.expr("(cast(pool AS decimal(38,0)) * w) div open_w")))
    spare = F.col("goal") - F.sum("share").over(whole)
    turn = F.row_number().over(Window.partitionBy(*parents, "full").orderBy(name))
    return t.withColumn("spare", spare).withColumn("turn", turn) \
        .withColumn("share", F.col("share") + F.when(~F.col("full") & (F.col("turn") <= F.col("spare")), 1).otherwise(0)) \
        .drop("goal", "left", "rest", "full", "pool", "open_w", "spare", "turn")


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], budget: Column,
                 epochs: int, default: int = 1) -> DataFrame:
    """``share`` (tokens) of every leaf of the tree.

    ``leaves`` has the level columns and ``avail`` tokens.  The root's budget goes
    down the tree by weight.  A subtree takes at most ``epochs`` times its tokens;
    what it cannot take goes to its siblings, and only what all of them cannot take
    is missing from their parent's capacity and so goes to the parent's siblings.
    """
    nodes = leaves.select(*levels, (F.col("avail") * epochs).alias("cap"))
    share = nodes.agg(budget.alias("budget")).filter("budget IS NOT NULL").select(F.lit(0).alias("__root"), "budget")
    for i, level in enumerate(levels):
        path = levels[:i + 1]
        here = nodes.groupBy(*path).agg(F.sum("cap").alias("cap")).withColumn("__root", F.lit(0))
        here = here.withColumn("w", _weight(level, weights.get(level, {}), default))
        here = here.join(share, ["__root", *levels[:i]])
        share = _fill(here, ["__root", *levels[:i]], level) \
            .select("__root", *path, F.col("share").alias("budget"))
    return share.select(*levels, F.col("budget").alias("share"))


def mix(docs: DataFrame, levels: dict[str, Column], weights: dict[str, dict[str, int]], budget: tuple[int, int],
        epochs: int = 2, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
        epoch_col: str = "mix_epoch") -> DataFrame:
    """Rows of ``docs`` drawn so that every leaf of the tree gets its share of tokens.

    ``levels`` names the tree's levels from the root down, each with its column;
    ``weights`` their integer target weights (1 where none is given); ``budget`` =
    (a, b) asks for a/b of all tokens.  A leaf gives whole passes over its documents
    (epochs) and then the longest prefix of one more pass, in an order seeded by
    (seed, epoch, id), that fits the rest.  Returns the columns of ``docs`` and
    ``epoch_col`` (0, 1, ...).

    A null level is the leaf ``(none)``; a null or empty text counts as one token; rows
    of one id come and go together; null ids share one place in the order; an empty
    table gives no rows.  Columns of any other name are kept (``epoch_col`` must be a
    new one).
    """
    if epoch_col in docs.columns:
        raise ValueError(f"{epoch_col} is a column of the documents; name another epoch_col")
    names = [f"__level{i}" for i in range(len(levels))]
    leaf = {n: F.coalesce(c.cast("string"), F.lit(NONE)) for n, c in zip(names, levels.values())}
    named = dict(zip(names, levels))
    by_level = {n: weights.get(level, {}) for n, level in named.items()}
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    slim = docs.select(*[c.alias(n) for n, c in leaf.items()], ident.alias("__id"),
                       token_estimate(F.col(text_col)).alias("__tokens"))
    leaves = slim.groupBy(*names).agg(F.sum("__tokens").alias("avail"))
    total = F.floor(F.sum(F.expr(f"cap div {int(epochs)}")).cast("decimal(38,0)") * budget[0] / budget[1]).cast("long")
    plan = leaf_budgets(leaves, names, by_level, total, epochs).join(leaves, names) \
        .withColumn("whole", F.expr("share div avail")).withColumn("rest", F.col("share") - F.col("whole") * F.col("avail"))
    # a written table: the tree is worked out once, and the planner knows its size
    plan = materialise(plan.select(*names, "whole", "rest"), "mix-leaves")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt")
    salt = F.pmod(F.xxhash64("__id", "__tokens"), F.lit(SALTS)).cast("int")

    def key(whole: str) -> Column:
        return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(whole).cast("string"), F.col("__id")))

    keyed = slim.withColumn("__salt", salt).join(plan.select("*", salts), [*names, "__salt"]) \
        .withColumn("key", key("whole")).withColumn("run", F.substring("key", 1, CUT_DIGITS))
    runs = keyed.groupBy(*names, "run").agg(F.sum("__tokens").alias("t"), F.first("rest").alias("rest"))
    upto = F.sum("t").over(Window.partitionBy(*names).orderBy("run"))
    cut = runs.withColumn("upto", upto).filter((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("t") <= F.col("rest"))) \
        .select(*names, "run", (F.col("rest") - F.col("upto") + F.col("t")).alias("room"))
    inside = keyed.groupBy(*names, "run", "key").agg(F.sum("__tokens").alias("t")).join(cut, [*names, "run"])
    last = inside.withColumn("sum", F.sum("t").over(Window.partitionBy(*names).orderBy("key"))) \
        .filter(F.col("sum") > F.col("room")).groupBy(*names).agg(F.min("key").alias("stop"))
    plan = materialise(plan.join(last, names, "left"), "mix-stops")

    rows = docs.withColumns({**leaf, "__id": ident, "__tokens": token_estimate(F.col(text_col))}) \
        .withColumn("__salt", salt).join(plan.select(*names, F.col("whole").alias("__whole"), F.col("stop").alias("__stop"),
                                                     salts), [*names, "__salt"])
    more = (key("__whole") < F.col("__stop")).cast("int")
    times = F.col("__whole").cast("int") + F.coalesce(more, F.lit(0))
    return rows.withColumn(epoch_col, F.explode(F.filter(F.sequence(F.lit(0), times), lambda e: e < times))) \
        .select(*docs.columns, epoch_col)
