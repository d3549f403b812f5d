"""Connected components of a graph by joins: smallest label of the neighbours, then pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """Columns a, b to columns node, label: the smallest node reachable, itself included.

    Nodes without an edge are not in the result; an edge from a node to itself is harmless, and
    no edges give no rows. Each round halves the length of chains of labels, so the number of
    rounds grows with the logarithm of a component's diameter. Only a flag reaches the driver.
    Every round reads the edges: they should be a stored table.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = both.union(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    # the first hop needs no join: the smallest neighbour
    labels = written(
        both.groupBy("node").agg(F.min("other").alias("label")).select(
            "node", F.least("node", "label").alias("label")
        ),
        "labels",
        narrow=True,
    )
    while True:
        old = labels
        names = old.select(F.col("node").alias("other"), F.col("label").alias("seen"))
        near = both.join(names, "other").groupBy("node").agg(F.min("seen").alias("near"))
        hooked = old.join(near, "node", "left").select(
            "node", "label", F.least("label", F.coalesce("near", "label")).alias("mid")
        )
        # where the old label's own node has a smaller label, take that
        jump = old.select(F.col("node").alias("mid"), F.col("label").alias("root"))
        labels = written(
            hooked.join(jump, "mid", "left").select(
                "node",
                F.least("mid", F.coalesce("root", "mid")).alias("label"),
                (F.least("mid", F.coalesce("root", "mid")) != F.col("label")).alias("moved"),
            ),
            "labels",
            narrow=True,
        )
        if not labels.filter("moved").limit(1).count():
            return labels.drop("moved")
        labels = labels.drop("moved")
