"""Connected components of an edge table by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` of every node of the edges ``(a, b)``: the smallest node it is joined to.

    Each round hangs every edge's larger label below the smaller one and then jumps to the label
    of the label, so chains shorten by half. Sums are combined before each exchange, and a node
    with many edges is split by adaptive execution, as the joins feed partial aggregates only.
    Rounds are written to the shared folder, which cuts the lineage. No edges give no rows.
    """
    edges = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = stored(
        edges.select(F.col("b").alias("node"), F.col("a").alias("label"))
        .unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("label")))
        .groupBy("node").agg(F.min("label").alias("label")),
        "labels",
    )
    while True:
        at_a = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
        at_b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        crossing = stored(
            edges.join(at_a, "a").join(at_b, "b").where("la <> lb").select(F.greatest("la", "lb").alias("high"), F.least("la", "lb").alias("low"))
            .groupBy("high").agg(F.min("low").alias("low")),
            "crossing",
        )
        if crossing.isEmpty():
            return labels
        # A label that other edges lowered takes all nodes that carry it along; then one jump.
        lowered = labels.join(crossing, labels.label == crossing.high, "left").select("node", F.coalesce("low", "label").alias("label"))
        jump = crossing.select(F.col("high").alias("from"), F.col("low").alias("to"))
        labels = stored(
            lowered.join(jump, lowered.label == jump["from"], "left").select("node", F.coalesce("to", "label").alias("label")),
            "labels",
        )
