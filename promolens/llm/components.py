"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.session import stage


def _lowest(pairs: DataFrame) -> DataFrame:
    """Each pair (u, v) with the lowest v of its u. Grouped before it is joined back, so a node
    with many links is combined in the map tasks and its pairs can be split over tasks."""
    low = pairs.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("low"))
    return pairs.join(low, pairs["u"] == low["of"]).select("u", "v", "low")


def connected_components(links: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, component): every node of links (a, b), with the lowest node it reaches.

    A round connects each node's higher neighbours to its lowest one, then its lower ones; the
    links become stars in a number of rounds that grows with the logarithm of a path. Every round
    is written to the shared folder. NULL ends and links of a node to itself are left out.
    """
    ends = (F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stage(links.where("a <> b").select(*ends).distinct(), "component-links")
    for _ in range(max_rounds):
        both = edges.unionByName(edges.selectExpr("v as u", "u as v"))
        large = _lowest(both).where("v > u").selectExpr("v as u", "least(u, low) as v").distinct()
        small = _lowest(large)
        small = small.where("v <> low").selectExpr("v as u", "low as v").unionByName(
            small.selectExpr("u", "low as v")
        )
        after = stage(small.where("u <> v").distinct(), "component-links")
        # Equal sets of links: as many rows, and none that was not there before.
        new = after.join(edges, ["u", "v"], "left_anti").limit(1).count()
        done = not new and after.count() == edges.count()
        edges = after
        if done:
            break
    else:
        raise RuntimeError(f"no components after {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.selectExpr("u as node", "v as component").unionByName(
        roots.withColumn("component", F.col("node"))
    )
