"""Connected components by alternating large-star and small-star steps.

Edges stay in Spark; every round is two grouped minima and joins, written to the
shared folder.  The rounds needed grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquia.llm.common import saved


#: Nodes with this share of all edges or more get their minimum by broadcast.
HOT_NODES = 1_024


def _with_low(edges: DataFrame, low: DataFrame, n_edges: int) -> DataFrame:
    """``edges`` with the smallest neighbour ``m`` of ``u``.  ``low`` is one row per node with
    its degree ``n``; the centre of a large star is no key of a shuffled join: nodes of
    n_edges / HOT_NODES edges or more (at most twice HOT_NODES of them) are broadcast."""
    hot = F.col("n") * HOT_NODES >= n_edges
    near = low.where(hot).select("u", "m")
    far = edges.join(F.broadcast(near.select("u")), "u", "left_anti")
    return edges.join(F.broadcast(near), "u").unionByName(far.join(low.where(~hot).select("u", "m"), "u"))


def _large_star(edges: DataFrame, n_edges: int) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))
    return (_with_low(both, low, n_edges).where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v"))


def _small_star(edges: DataFrame, n_edges: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    joined = _with_low(down, low, n_edges)
    return (joined.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: long); root is the smallest
    node reachable.  An empty edge table gives an empty result."""
    now = saved(edges.where("u <> v").distinct(), "edges")
    state = _state(now)
    for _ in range(max_rounds):
        if not state[0]:
            break
        now = saved(_small_star(_large_star(now, state[0]), state[0]), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError("connected components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
