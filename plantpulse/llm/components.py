"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse.session import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of all nodes that ``edges`` name; the root is the smallest node of the component.

    In each round every node takes the smallest label among its own, its neighbours' and its label's label, so labels
    run along paths at doubling speed. Labels are written to the shared folder in each round; only the number of
    changes comes to the driver.
    """
    both = cut(edges.select(F.col(a).alias("node"), F.col(b).alias("other")).union(edges.select(F.col(b), F.col(a))).distinct(), "edges")
    labels = cut(both.groupBy("node").agg(F.least(F.first("node"), F.min("other")).alias("root")), "labels")
    while True:
        heard = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("root").alias("near"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("far"))
        after = labels.join(heard, "node").join(jump, "root").select("node", F.least("root", "near", "far").alias("root"), (F.least("near", "far") < F.col("root")).alias("changed"))
        after = cut(after, "labels")
        if after.filter("changed").isEmpty():
            return after.drop("changed")
        labels = after.drop("changed")
