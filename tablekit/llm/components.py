"""Connected components by hooking to the smallest neighbour and contracting.

Every round, each node with a smaller neighbour hooks to its smallest one
(one grouped minimum, combined map-side); pointer jumping turns the hooks
into trees of depth one; edges are rewritten to the roots and deduplicated.
At least half of the nodes that still have an edge vanish per round.  Every
round's tables are reliable checkpoints, so lineage stays short, and lookups
join two plainly exchanged tables, which lets adaptive execution split a root
that many rows point to.  Nothing is gathered on the driver but row counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _flatten(hooks: DataFrame) -> DataFrame:
    """(node, root) with roots that are no node: pointer jumping."""
    while True:
        up = hooks.select(F.col("node").alias("up_node"), F.col("root").alias("up_root"))
        step = cut(hooks.join(up, F.col("root") == F.col("up_node"), "left")
                   .select("node", F.coalesce("up_root", "root").alias("root"),
                           F.col("up_root").isNotNull().alias("moved")))
        hooks = step.select("node", "root")
        if step.filter("moved").isEmpty():
            return hooks


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (node, root): for every node that is not the
    smallest of its component, that smallest node.  Self loops, repeated and
    reversed edges are fine; an empty table gives no rows."""
    e = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .filter("a < b").distinct())
    labels = None
    while not e.isEmpty():
        roots = _flatten(cut(e.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))))
        if labels is None:
            labels = roots
        else:
            up = roots.select(F.col("node").alias("up_node"), F.col("root").alias("up_root"))
            labels = cut(labels.join(up, F.col("root") == F.col("up_node"), "left")
                         .select("node", F.coalesce("up_root", "root").alias("root"))
                         .unionByName(roots))
        ra = roots.select(F.col("node").alias("na"), F.col("root").alias("ra"))
        rb = roots.select(F.col("node").alias("nb"), F.col("root").alias("rb"))
        e = cut(e.join(ra, F.col("a") == F.col("na"), "left")
                .select(F.coalesce("ra", "a").alias("a"), "b")
                .join(rb, F.col("b") == F.col("nb"), "left")
                .select("a", F.coalesce("rb", "b").alias("b"))
                .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                .filter("a < b").distinct())
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    return labels
