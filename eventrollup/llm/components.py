"""Connected components of a link table, wholly in Spark tables.

Each round hooks every label onto the smallest neighbouring label, flattens the
resulting forest by pointer jumping, and rewrites the links with the new labels;
links inside a component vanish.  The tables are stored between the steps, so a
lost executor costs one step, and only row counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventrollup.llm.common import store


def _empty(df: DataFrame) -> bool:
    return df.isEmpty()


def _flatten(parent: DataFrame) -> DataFrame:
    """(node, up) with up < node -> (node, root)."""
    while True:
        above = parent.select(F.col("node").alias("up"), F.col("up").alias("higher"))
        joined = parent.join(above, "up", "left")
        new = store(joined.select("node", F.coalesce("higher", "up").alias("up"),
                                  F.col("higher").isNotNull().alias("moved")), "cc-parent")
        parent = new.select("node", "up")
        if _empty(new.where("moved")):
            return parent


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """links(a, b) -> (node, component) for every node that has a link; the
    component is its smallest node.  Self-links and repeats are harmless."""
    edges = store(links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
                  .where(F.col("hi") != F.col("lo")).distinct(), "cc-edges")
    labels = store(edges.select(F.col("hi").alias("node")).unionByName(edges.select(F.col("lo").alias("node")))
                   .distinct().withColumn("component", F.col("node")), "cc-labels")
    while not _empty(edges):
        parent = store(edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("up")), "cc-hook")
        parent = _flatten(parent)
        roots = parent.select(F.col("node").alias("component"), F.col("up").alias("root"))
        labels = store(labels.join(roots, "component", "left")
                       .select("node", F.coalesce("root", "component").alias("component")), "cc-labels")
        hi = parent.select(F.col("node").alias("hi"), F.col("up").alias("new_hi"))
        lo = parent.select(F.col("node").alias("lo"), F.col("up").alias("new_lo"))
        moved = store(edges.join(hi, "hi", "left").select(F.coalesce("new_hi", "hi").alias("x"), "lo"), "cc-moved") \
            .join(lo, "lo", "left").select("x", F.coalesce("new_lo", "lo").alias("y"))
        edges = store(moved.where(F.col("x") != F.col("y"))
                      .select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo")).distinct(), "cc-edges")
    return labels
