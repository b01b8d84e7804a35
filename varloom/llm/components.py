"""Connected components of a link table, by rounds of contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.staging import staged


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its smallest node.

    In each round a node moves to its smallest neighbour and the links follow;
    the largest node of every component that still has links disappears, in
    practice most nodes do. Every round is written to the shared folder, so
    lineage stays short. Nothing is collected but one row count a round.
    """
    links = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    both = staged(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct())
    found = None
    while True:
        moved = both.groupBy(F.col("a").alias("at")).agg(F.least(F.min("b"), F.col("at")).alias("to"))
        if found is None:
            found = moved.select(F.col("at").alias("node"), F.col("to").alias("component"))
        else:
            found = (found.join(moved, found.component == moved.at, "left")
                     .select("node", F.coalesce("to", "component").alias("component")))
        found = staged(found)
        target = staged(moved) if both.isEmpty() is False else None
        if target is None:
            return found
        both = staged(both.join(target.select(F.col("at").alias("a"), F.col("to").alias("x")), "a")
                      .join(target.select(F.col("at").alias("b"), F.col("to").alias("y")), "b")
                      .where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        if both.isEmpty():
            return found
