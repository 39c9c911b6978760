"""Connected components by contraction, round after round, on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import kept_table


def components(links: DataFrame) -> DataFrame:
    """node, root of every node of `links` (columns a and b, long, not null); root is one
    node of the component, the same for all of them.

    Each round points every node at its smallest neighbour or itself and replaces both ends
    of each link by where they point, until no link is left; the nodes that still have
    links at least halve in a few rounds. Every round starts from written tables: a node
    with very many links is a skewed side of a plain join, which Spark splits.
    """
    links = kept_table(links.where("a <> b").select("a", "b").distinct(), "links")
    roots = None
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        step = kept_table(
            both.groupBy(F.col("a").alias("node"))
            .agg(F.min("b").alias("b"))
            .select("node", F.least("node", "b").alias("root")),
            "step",
        )
        if roots is None:
            roots = step
        else:
            on = step.select(F.col("node").alias("root"), F.col("root").alias("to"))
            roots = kept_table(
                roots.join(on, "root", "left").select(
                    "node", F.coalesce("to", "root").alias("root")
                ),
                "roots",
            )
        for end in ("a", "b"):
            at = step.select(F.col("node").alias(end), F.col("root").alias("to"))
            links = links.join(at, end).drop(end).withColumnRenamed("to", end)
        links = kept_table(
            links.where("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct(),
            "links",
        )
    if roots is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
