"""Connected components of a graph held in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.lineage import drop
from tallybook.llm.scratch import stored


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def components(edges: DataFrame, node: str = "node") -> DataFrame:
    """(node, root) of every node of the edges (u, v); nodes with one root are connected.

    Each round is a distributed union-find step: every node hangs itself under the smallest node within two
    steps, in an order that is drawn anew by hashing; edges are rewritten to the new parents and those within
    a tree go. A star is done in one round, rounds grow with the logarithm of a component's length. Minima
    are combined before the shuffle and joins meet a table with one row a key, so a node with very many edges
    is split by the adaptive join. Loops and repeated edges do not matter; no edges give no rows; null ends
    are ignored. The result is stored, the rounds' tables are deleted; ``node`` names its first column.
    """
    kind = edges.schema["u"].dataType
    left = stored(_tidy(edges.where("u is not null and v is not null")))
    steps: list[DataFrame] = []
    while not left.isEmpty():
        salt = F.lit(len(steps))
        both = left.union(left.select("v", "u")).toDF("u", "v")
        order = F.struct(F.xxhash64("v", salt).alias("h"), F.col("v").alias("x"))
        own = F.struct(F.xxhash64("u", salt).alias("h"), F.col("u").alias("x"))
        one = both.groupBy("u").agg(F.min(order).alias("m")).select("u", F.least("m", own)["x"].alias("p"))
        one = stored(one)
        far = F.struct(F.xxhash64("p", salt).alias("h"), F.col("p").alias("x"))
        near = both.join(one.toDF("v", "p"), "v").select("u", "p").union(one.select("u", "p"))
        two = stored(near.groupBy("u").agg(F.min(far).alias("m")).select("u", F.col("m.x").alias("p")))
        steps.append(two)
        moved = left.join(two, "u").select(F.col("p").alias("u"), "v")
        moved = moved.join(two.toDF("v", "q"), "v").select("u", F.col("q").alias("v"))
        rest = stored(_tidy(moved))
        drop(left, one)
        left = rest
    if not steps:
        roots = stored(left.select(F.col("u").cast(kind).alias(node), F.col("v").cast(kind).alias("root")))
        drop(left)
        return roots
    roots = steps[-1].toDF("node", "root")
    for step in reversed(steps[:-1]):
        higher = roots.toDF("p", "r")
        roots = step.toDF("node", "p").join(higher, "p", "left").select("node", F.coalesce("r", "p").alias("root"))
    roots = stored(roots.toDF(node, "root"))
    drop(left, *steps)
    return roots
