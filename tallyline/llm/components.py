"""Connected components by contraction: every vertex goes to its smallest neighbour, round by round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.storage import stored


def components(links: DataFrame) -> DataFrame:
    """id and component (the smallest id that can be reached) of every vertex of links (a, b).

    Each round gives every vertex its smallest neighbour, follows that once more, and keeps the links
    between the vertices that are left; a vertex of many links is added up in each task first. The
    smallest vertex of a component never moves, so it is what all others end at.
    """
    links = stored(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    found = None
    while not links.isEmpty():
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("to")).withColumn("to", F.least("id", "to"))
        near = stored(near, "near")
        on = near.select(F.col("id").alias("to"), F.col("to").alias("then"))
        step = stored(near.join(on, "to").select("id", F.col("then").alias("to")), "step")
        if found is None:
            found = step.withColumnRenamed("to", "component")
        else:
            moved = step.withColumnRenamed("id", "component")
            found = found.join(moved, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
        found = stored(found, "components")
        first = step.select(F.col("id").alias("a"), F.col("to").alias("x"))
        second = step.select(F.col("id").alias("b"), F.col("to").alias("y"))
        left = links.join(first, "a").join(second, "b").filter("x <> y")
        links = stored(left.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    if found is None:
        return links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return found
