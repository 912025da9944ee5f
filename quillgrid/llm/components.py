"""Connected components of a graph that lies in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.llm.common import checkpointed


def components(links: DataFrame, left: str = "a", right: str = "b", rounds: int = 64) -> DataFrame:
    """``(id, component)`` of every id that occurs in ``links``; ``component`` is
    the smallest id that links lead to.

    Each round every id takes the smallest label among its own and its
    neighbours', then the label of its label. Labels run along chains in a
    number of rounds that grows with the logarithm of their length. Each round
    is written to the checkpoint folder; only a count comes to the driver.
    Links whose ends have come to share a label leave the rounds, so that a hub
    with very many links is dealt with once.
    """
    pairs = links.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    labels = checkpointed(
        pairs.select(F.col("a").alias("id"), F.least("a", "b").alias("component"))
        .union(pairs.select("b", F.least("a", "b")))
        .groupBy("id").agg(F.min("component").alias("component"))
    )
    for _ in range(rounds):
        # Labels point at ids no larger than themselves: follow them to the end first.
        while True:
            next_label = labels.select(F.col("id").alias("component"), F.col("component").alias("further"))
            jumped = checkpointed(labels.join(next_label, "component", "left").select(
                "id", F.coalesce("further", "component").alias("component"), (F.col("further") < F.col("component")).alias("moved")
            ))
            labels = jumped.drop("moved")
            if jumped.where("moved").limit(1).count() == 0:
                break
        # Links between labels are what is left to do.
        named = pairs.join(labels.select(F.col("id").alias("a"), F.col("component").alias("x")), "a").drop("a")
        named = named.join(labels.select(F.col("id").alias("b"), F.col("component").alias("y")), "b")
        pairs = checkpointed(
            named.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        )
        hooks = pairs.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("hook"))
        if pairs.limit(1).count() == 0:
            return labels
        labels = labels.join(hooks, "id", "left").select("id", F.least("component", "hook").alias("component"))
    raise RuntimeError(f"no end after {rounds} rounds")
