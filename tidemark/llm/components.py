"""Connected components of a table of links, by contracting each link to its smaller neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b): the component is the smallest id reachable.

    Each pass points every id at its smallest neighbour and contracts the links along these pointers. The
    smallest id of a component always points at itself, so the passes end with it alone; the number of links
    shrinks each time. Pointers are aggregated before they are shuffled, so an id with very many links is
    no hot key, and each pass is written out, so no lineage grows.
    """
    links = stage(links.select("a", "b").where(F.col("a") != F.col("b")).distinct(), "links")
    labels = None
    while True:
        ends = links.select(F.col("a").alias("v"), F.col("b").alias("u")).unionAll(links.select(F.col("b").alias("v"), F.col("a").alias("u")))
        to = stage(ends.groupBy("v").agg(F.min("u").alias("p")).select("v", F.least("v", "p").alias("p")), "pointers")
        if labels is None:
            labels = to.select(F.col("v").alias("id"), F.col("p").alias("component"))
        else:
            moved = to.select(F.col("v").alias("component"), "p")
            labels = stage(labels.join(moved, "component", "left").select("id", F.coalesce("p", "component").alias("component")), "labels")
        at_a = to.select(F.col("v").alias("a"), F.col("p").alias("pa"))
        at_b = to.select(F.col("v").alias("b"), F.col("p").alias("pb"))
        links = links.join(at_a, "a").join(at_b, "b").where(F.col("pa") != F.col("pb"))
        links = stage(links.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "links")
        if links.isEmpty():
            return labels


def merge_components(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``labels`` (id, component) after ``links`` (a, b) are added: only links between different components are contracted.

    The names are smallest ids, so the smallest name of what is joined is the smallest id again.
    """
    if labels is None:
        return components(links)
    at_a, at_b = (labels.select(F.col("id").alias(x), F.col("component").alias(f"c{x}")) for x in "ab")
    between = links.join(at_a, "a", "left").join(at_b, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    between = stage(between.where("a <> b").distinct(), "between")
    if between.isEmpty():
        return labels
    moved = components(between)
    old = labels.join(moved.select(F.col("id").alias("component"), F.col("component").alias("to")), "component", "left")
    old = old.select("id", F.coalesce("to", "component").alias("component"))
    return stage(old.unionByName(moved.join(labels.select("id"), "id", "left_anti")), "labels")
