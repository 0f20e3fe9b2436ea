"""Connected components by least labels and pointer jumping, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import Scratch


def components(scratch: Scratch, edges: DataFrame, source: str = "a", target: str = "b") -> DataFrame:
    """``node`` and ``label``, its component's smallest node, for every node of an edge.

    A round gives each node the smallest label among itself, its neighbours and
    their labels' labels, so paths of any length take a logarithmic number of
    rounds.  Each round is stored, which cuts the lineage.  Only the number of
    changes reaches the driver.
    """
    one_way = edges.select(F.col(source).alias("a"), F.col(target).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    both = scratch.keep(one_way.unionByName(one_way.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = scratch.keep(both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("label")), "labels")
    while True:
        seen = both.join(labels.select(F.col("node").alias("a"), "label"), "a").select(F.col("b").alias("node"), "label")
        # A smaller label found by a node is also offered to the label it had, so whole trees hook on.
        old = labels.select("node", F.col("label").alias("old"))
        offers = seen.join(old, "node").where("label < old").select(F.col("old").alias("node"), "label")
        found = seen.unionByName(offers).withColumn("old", F.lit(None).cast("long")).unionByName(labels.select("node", "label", F.col("label").alias("old")))
        best = found.groupBy("node").agg(F.min("label").alias("label"), F.max("old").alias("old"))
        jumped = best.join(best.select(F.col("node").alias("label"), F.col("label").alias("further")), "label", "left")
        new = scratch.keep(jumped.select("node", F.coalesce("further", "label").alias("label"), "old"), "labels")
        labels = new.select("node", "label")
        if new.where("label <> old").isEmpty():
            return labels
