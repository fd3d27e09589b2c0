"""Connected components of an edge table, by smallest labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import discard, materialize


def components(edges: DataFrame, files: int | None = None) -> DataFrame:
    """node, root for every end of ``edges`` (a, b of any ordered type): root is the component's least node.

    Each round a node takes the least label among its own, its neighbours' and its label's label, so labels
    reach along a path of any length in a number of rounds near its logarithm.  Nothing but a count
    reaches the driver.  An empty table gives an empty one.  ``files``: see ``materialize``.
    """
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges", files)
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("least")).select(
        F.col("a").alias("node"), F.least("a", "least").alias("root")), "labels", files)
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("near"))
        far = labels.select(F.col("node").alias("over"), F.col("root").alias("far"))
        step = (labels.join(near, F.col("node") == F.col("a")).join(far, F.col("root") == F.col("over"))
                .select("node", F.least("root", "near", "far").alias("root"), F.col("root").alias("was")))
        step = materialize(step, "labels", files)
        changed = step.where("root <> was").limit(1).count()
        discard(labels)
        labels = step.select("node", "root")
        if not changed:
            discard(both)
            return labels
