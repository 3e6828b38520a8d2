"""Connected components by label propagation with pointer jumping, on DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root): each node of links (a, b), and the least node of its component.

    Each round a node takes the least label near it, then that label's own label. Labels live
    in the shared folder, so lost executors cost no more than the round they were in.
    """
    # Each link both ways round, by one pass over links.
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(links.filter("a <> b").select(F.inline(ways)).distinct())
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = labels.join(near, "node").select("node", "root", F.least("root", "near").alias("next"))
        # Jump: the least label known of the label. A label is a node of the same component.
        jump = labels.select(F.col("node").alias("next"), F.col("root").alias("far"))
        moved = materialize(step.join(jump, "next").select("node", F.least("next", "far").alias("root"), (F.least("next", "far") < F.col("root")).alias("moved")))
        more = moved.filter("moved").limit(1).count()
        discard(labels)
        labels = moved.select("node", "root")
        if not more:
            discard(both)
            return labels
