"""Connected components of a large edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.support import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (longs a, b); one root for each component.

    Edges shrink round by round: each node points to its neighbour that comes
    first in a hashed order of the round (or to itself), and edges move to where
    their ends point. With hashed orders a constant share of nodes goes in each
    round, whatever the shape of the graph, so rounds grow with the logarithm of
    its size. The pointers of all rounds are then followed backwards. A hub is
    pre-aggregated before the shuffle, and the joins have one row per node on one
    side, so that skewed ends are split. Nothing but one count a round comes to
    the driver.
    """
    tidy = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    left = scratch.keep(edges.where("a <> b").select(*tidy).distinct(), f"{name}-edges-0")
    pointers: list[DataFrame] = []
    written = []
    while not left.isEmpty():
        k = len(pointers)

        def place(c: str) -> F.Column:
            return F.struct(F.xxhash64(F.col(c), F.lit(k)).alias("h"), F.col(c).alias("n"))

        both = left.select("a", "b").union(left.select("b", "a"))
        to = both.groupBy("a").agg(F.min(place("b")).alias("_m")).select(F.col("a").alias("node"), F.least("_m", place("a"))["n"].alias("to"))
        to = scratch.keep(to, f"{name}-to-{k}")
        pointers.append(to)
        moved = (
            left.join(to.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a")
            .join(to.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b")
            .where("ta <> tb")
            .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
            .distinct()
        )
        left = scratch.keep(moved, f"{name}-edges-{k + 1}")
        scratch.drop(f"{name}-edges-{k}")
        written.append(f"{name}-to-{k}")
    if not pointers:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = pointers[-1].withColumnRenamed("to", "root")
    for to in reversed(pointers[:-1]):
        later = out.select(F.col("node").alias("to"), "root")
        out = to.join(later, "to", "left").select("node", F.coalesce("root", "to").alias("root"))
    out = scratch.keep(out, f"{name}-roots")
    scratch.drop(f"{name}-edges-{len(pointers)}", *written)
    return out
