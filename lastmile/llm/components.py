"""Connected components of a link table, by hooking and contraction.

Each pass hooks every node to its lowest neighbour, follows those pointers four steps, and
contracts the links to links between the labels that are left. A star is done in one pass, a
chain of n nodes in about log n. Between passes the small tables are written to the shared
folder, so lineage stays short and the joins read plain scans, which AQE can split where one
node has very many links. Nothing but the emptiness of a table reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import compactly_written


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the lowest node reachable."""
    edges = compactly_written(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    both = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = compactly_written(both.select("node", F.col("node").alias("label")), "labels")
    while not edges.isEmpty():
        ends = edges.select("a", "b").union(edges.select("b", "a"))
        up = compactly_written(ends.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("x"), F.least("a", "b").alias("up")), "up")
        twice = up.join(up.select(F.col("x").alias("up"), F.col("up").alias("far")), "up").select("x", F.col("far").alias("up"))
        up = compactly_written(twice.join(twice.select(F.col("x").alias("up"), F.col("up").alias("far")), "up").select("x", F.col("far").alias("up")), "up")
        labels = compactly_written(
            labels.join(up.withColumnRenamed("x", "label"), "label", "left").select("node", F.coalesce("up", "label").alias("label")), "labels"
        )
        left = up.select(F.col("x").alias("a"), F.col("up").alias("ra"))
        right = up.select(F.col("x").alias("b"), F.col("up").alias("rb"))
        met = edges.join(left, "a").join(right, "b").filter("ra <> rb")
        edges = compactly_written(met.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
    return labels
