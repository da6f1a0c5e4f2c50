"""Connected components of a graph whose edges and labels stay in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Tasks of a round over edges: so many, and one more for so many edges. Each round has several shuffles, each with a file a task.
LEAST_PARTS, PART_ROWS = 16, 50_000


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the smallest node of its component.

    Alternating star contraction: in a large star every larger neighbour of a node is hung on the smallest neighbour, in a
    small star every smaller one is. The edges end as stars, after a number of rounds that grows with the logarithm of the
    longest path. Each round's edges are written to the checkpoint folder. Neighbourhoods are only ever minimised (combined
    before the shuffle) and joined, never collected. The minima over larger neighbours' stars, where hubs stand, are written
    before they are joined, so that both sides of the join are plain shuffles and adaptive execution deals a hub's edges to
    many tasks; in small stars a node has the few roots that its neighbours still differ in. Loops and repeated edges do no
    harm; no edges give no rows. Rounds over few edges run in few tasks: their number grows with the edges.
    """
    held = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct())
    seen, parts = None, LEAST_PARTS + held.count() // PART_ROWS
    few = lambda df: df.coalesce(parts)  # noqa: E731  (no shuffle)
    held = few(held)
    for _ in range(rounds):
        both = held.union(held.select("b", "a"))
        least = cut(few(both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))))
        large = few(few(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))).distinct())
        lowest = few(large.groupBy("a").agg(F.min("b").alias("low")))
        small = few(large.join(lowest, "a").select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")).select("e.*"))
        held = cut(few(small.filter("a > b").distinct()))
        now = held.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return held.select(F.col("a").alias("node"), F.col("b").alias("root")).union(held.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
