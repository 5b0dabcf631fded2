"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in edges (a, b); a component's name is its smallest node.

    Each round hangs every node on its smallest neighbour, or on itself, follows these links to their roots, and goes on with the
    edges between roots. Edges inside a tree are gone then, so a round reads a fraction of the one before: at most half of the
    nodes are roots. All tables are stored, and hot nodes meet their roots in joins that Spark can split.
    """
    left = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    loops = edges.where("a = b").select(F.col("a").alias("node"))
    known = None
    while True:
        roots = _roots(left)
        known = roots if known is None else _followed(known, roots)
        at = lambda side: roots.select(F.col("node").alias(side), F.col("component").alias(f"root_{side}"))  # noqa: B023, E731
        met = left.join(at("a"), "a").where("b <> root_a").join(at("b"), "b").where("root_a <> root_b")
        left = stored(met.select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct(), "edges")
        if left.isEmpty():
            break
    alone = loops.join(known, "node", "left_anti").distinct().select("node", F.col("node").alias("component"))
    return known.unionByName(alone)


def _roots(edges: DataFrame) -> DataFrame:
    """The root of each node's tree. Links lead to smaller nodes, so following them twice as far in each step ends soon."""
    up = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
    top = edges.select(F.col("a").alias("node")).distinct().join(up, "node", "left_anti").select("node", F.col("node").alias("component"))
    links = stored(up.unionByName(top), "links")
    total, before = _total(links), None
    while total != before:
        links = stored(_followed(links, links), "links")
        total, before = _total(links), total
    return links


def _total(links: DataFrame) -> object:
    """Sum of all ends, which falls with every step that still moves one."""
    return links.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]


def _followed(links: DataFrame, further: DataFrame) -> DataFrame:
    """links, each led on to where `further` leads from its end."""
    on = further.select(F.col("node").alias("via"), F.col("component").alias("there"))
    return links.join(on, links.component == on.via, "left").select("node", F.coalesce("there", "component").alias("component"))
