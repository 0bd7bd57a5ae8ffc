"""Connected components by alternating large-star and small-star steps (Kiveris et al. 2014), as joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calorgrid.session import checkpointed


def _stars(pairs: DataFrame) -> DataFrame:
    """Link every b of (a, b) to the least of a and all its b. The least is pre-aggregated; the rows of a hub then meet it under
    one join key, one row on the other side, which adaptive execution splits where they are many."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return pairs.join(least, "a")


def connected_components(links: DataFrame, left: str, right: str, most_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of ``links``; component is the node of its component that sorts first.

    Null ends and loops link nothing, but the node of a loop is kept; repeated links count once; no links give no rows.
    Rounds grow with the logarithm of the number of nodes; each is written to the checkpoint folder."""
    ends = links.select(F.col(left).alias("a"), F.col(right).alias("b"))
    nodes = ends.select(F.explode(F.array("a", "b")).alias("node")).where("node is not null").distinct()
    now = checkpointed(
        ends.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    state = None
    for _ in range(most_rounds):
        both = now.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(now.select(F.col("v").alias("a"), F.col("u").alias("b")))
        large = _stars(both).where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = _stars(large)
        step = small.select(F.col("b").alias("u"), F.col("m").alias("v")).unionByName(small.select(F.col("a").alias("u"), F.col("m").alias("v")))
        now = checkpointed(step.where("u <> v").distinct())
        new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return nodes.join(now.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )
