"""Connected components and the allocation of components to splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkweir.operators.ordered import prefix_sums
from inkweir.session import cut


#: Edges of one node from which its join is split at least, the number of parts, and the most nodes split.
HOT_DEGREE, PARTS, MOST_HOT = 100_000, 64, 200_000


def _with_least(near: DataFrame, least: DataFrame, n_edges: int) -> DataFrame:
    """near(u, v) with the least(u, m, n) of each u. The edges of a hot node are spread over PARTS parts
    by a hash, its row of ``least`` is there once for each part; others have one part. The ids of hot
    nodes are broadcast: as each has its share of ``n_edges``, there are at most MOST_HOT of them."""
    hot = F.col("n") >= max(HOT_DEGREE, 2 * n_edges // MOST_HOT)
    names = F.broadcast(least.where(hot).select("u", F.lit(True).alias("is_hot")))
    part = F.when(F.col("is_hot"), F.pmod(F.xxhash64("v"), F.lit(PARTS)).cast("int")).otherwise(0)
    spread = least.select("u", "m", F.explode(F.sequence(F.lit(0), F.when(hot, PARTS - 1).otherwise(0))).alias("part"))
    return near.join(names, "u", "left").select("u", "v", part.alias("part")).join(spread, ["u", "part"]).select("u", "v", "m")


def _large_star(edges: DataFrame, n_edges: int) -> DataFrame:
    near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = near.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    return _with_least(near.where("v > u"), least, n_edges).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame, n_edges: int) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    both = _with_least(edges, least, n_edges).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
    return both.select("e.*").where("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(u, v) to (node, component) for every node, component the smallest node of it.

    Large and small stars alternate until no edge changes; each is a minimum per node, combined before
    the shuffle, and a join, and its edges are written to the checkpoint folder. Null ends are ignored;
    loops make a node of their own; repeated edges do no harm; no edges give no rows.
    """
    nodes = cut(edges.select(F.explode(F.array("u", "v")).alias("node")).where("node is not null").distinct())
    now = cut(edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    told = lambda: tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before, state = None, told()
    while state != before:
        # a star never has more edges than it is given, twice where both directions count
        before, now = state, cut(_small_star(_large_star(now, state[0]), 2 * state[0]))
        state = told()
    return nodes.join(now.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def fill_splits(sizes: DataFrame, targets: list[tuple[str, int]], rest: str, order: Column) -> DataFrame:
    """sizes(component, n) to (component, split): components in the order of ``order`` go to the first
    split until it holds its target, the last one may overshoot and one is always taken; then to the
    next from what remains; what is left over goes to ``rest``."""
    left = sizes.select("component", "n", order.alias("_order"))
    done = None
    for name, target in targets:
        run = cut(prefix_sums(left, ["_order", "component"], _upto=F.col("n").cast("bigint"), _place=F.lit(1).cast("bigint")))
        taken = (F.col("_upto") - F.col("n") < target) | (F.col("_place") == 1)
        part = run.where(taken).select("component", F.lit(name).alias("split"))
        done = part if done is None else done.unionByName(part)
        left = run.where(~taken).select("component", "n", "_order")
    tail = left.select("component", F.lit(rest).alias("split"))
    return tail if done is None else done.unionByName(tail)
