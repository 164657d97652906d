"""Connected components of large link tables by contraction in rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.llm.common import stored


def contract(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` ``(node, comp)`` with the components joined by ``links``
    ``(u, v)`` of nodes made one; a component's name is its smallest node.

    Each round lifts the links to components, hooks every component to its
    smallest neighbour (below itself, so no cycle can arise) and follows the
    hooks to their ends. Only tables are passed on; nothing is collected but
    whether a table is empty, and a link table's hot nodes are pre-aggregated by ``min``.
    """
    named = labels
    while not links.isEmpty():
        left = named.select(F.col("node").alias("u"), F.col("comp").alias("cu"))
        right = named.select(F.col("node").alias("v"), F.col("comp").alias("cv"))
        lifted = links.join(left, "u").join(right, "v").where("cu <> cv").select("u", "v", "cu", "cv")
        links = stored(lifted.dropDuplicates(["cu", "cv"]), "links")
        ends = links.select("cu", "cv").union(links.select(F.col("cv").alias("cu"), F.col("cu").alias("cv")))
        hooks = stored(ends.groupBy("cu").agg(F.min("cv").alias("to")).where("to < cu"), "hooks")
        if hooks.isEmpty():
            return named
        while True:  # to the ends of the chains, halving their lengths
            after = hooks.select(F.col("cu").alias("to"), F.col("to").alias("next"))
            moved = stored(hooks.join(after, "to", "left").select("cu", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "hooks")
            hooks = moved.select("cu", "to")
            if moved.where("moved").isEmpty():
                break
        renamed = hooks.select(F.col("cu").alias("comp"), "to")
        named = stored(named.join(renamed, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")), "components")
        links = links.select("u", "v")
    return named
