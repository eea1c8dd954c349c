"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) of every node in ``edges``
    (``a``, ``b``, integers; loops and repeated edges are fine).

    Each round points every node at its smallest neighbour, follows those
    pointers twice, and replaces edges by the edges between what they point
    at.  At least every node that isn't a local minimum disappears, so the
    edge table shrinks geometrically.  A hub is only ever aggregated with a
    map-side ``min`` or joined, never gathered.  Every round is a stage on
    shared storage.
    """
    edges = stage(edges.where("a <> b").select(F.least("a", "b").alias("a"),
                                               F.greatest("a", "b").alias("b")).distinct(),
                  "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.first("a"), F.min("b")).alias("up"))
        for _ in range(2):
            jump = up.select(F.col("node").alias("up"), F.col("up").alias("next"))
            up = up.join(jump, "up").select("node", F.col("next").alias("up"))
        up = stage(up, "pointers")
        if labels is None:
            labels = up.select("node", F.col("up").alias("component"))
        else:
            hop = up.select(F.col("node").alias("component"), F.col("up").alias("next"))
            labels = labels.join(hop, "component", "left").select(
                "node", F.coalesce("next", "component").alias("component"))
        labels = stage(labels, "labels")
        edges = stage(
            edges.join(up.select(F.col("node").alias("a"), F.col("up").alias("x")), "a")
            .join(up.select(F.col("node").alias("b"), F.col("up").alias("y")), "b")
            .where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
