"""Connected components of links between numbers, by alternating large and small stars.

Every round rewires links towards smaller nodes without changing what is connected; the links
end as one star for each component. All tables live in the shared folder; nothing but a count
and a checksum of the links reaches the driver. Smallest neighbours are stored before they meet
the links again, so that both sides of that join are scans and a hub's links can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortlane.llm.tables import stored


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "stars")
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = stored(down.groupBy("u").agg(F.min("v").alias("m")), "stars")
    others = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.withColumnRenamed("m", "v"))


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links`` (a, b): the label is the least node reachable.

    Null nodes and links of a node with itself are left out; repeated links and both directions
    are the same; no links give no rows.
    """
    clean = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v AND a IS NOT NULL AND b IS NOT NULL")
    edges = stored(clean.distinct(), "links")
    before = None
    while (state := _state(edges)) != before:
        before = state
        if not state[0]:
            break
        larger = stored(_large(edges).filter("u != v").distinct(), "links")
        edges = stored(_small(larger).filter("u != v").distinct(), "links")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("label", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (from ``components``) after more links: only the labels that they join are looked at."""
    left = labels.select(F.col("node").alias("a"), F.col("label").alias("x"))
    right = labels.select(F.col("node").alias("b"), F.col("label").alias("y"))
    joined = links.join(left, "a", "left").join(right, "b", "left")
    ends = stored(joined.select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")).filter("a <> b").distinct(), "links")
    moved = stored(components(ends).withColumnsRenamed({"node": "old", "label": "new"}), "moved")
    kept = labels.join(moved, labels["label"] == moved["old"], "left").select("node", F.coalesce("new", "label").alias("label"))
    fresh = moved.select(F.col("old").alias("node"), F.col("new").alias("label")).join(labels.select("node"), "node", "left_anti")
    return kept.unionByName(fresh)


def smallest_ids(labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, label, component): the smallest ``first`` of all ``nodes`` (node, first) with the same label.

    Nodes without a label are alone, with themselves as label. Smallest ids are stored before they are dealt out again, so
    a label that holds a large part of the nodes can be split.
    """
    linked = stored(labels.join(nodes, "node").select("node", "label", "first"), "linked")
    least = stored(linked.groupBy("label").agg(F.min("first").alias("component")), "smallest")
    found = linked.join(least, "label").select("node", "label", "component")
    alone = nodes.join(labels.select("node"), "node", "left_anti")
    alone = alone.select("node", F.col("node").alias("label"), F.col("first").alias("component"))
    return stored(found.unionByName(alone), "components")
