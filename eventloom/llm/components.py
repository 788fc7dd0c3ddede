"""Connected components of a table of links, without any of it on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventloom.llm.columns import discard, staged


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``label``, the smallest node it is connected with, for every node of a link; a staged table.

    Each round takes the smallest label among a node's neighbours and then that label's own label, so the distance
    that is left halves and long chains take few rounds. Rounds are written out, which keeps their plans short; a
    round's table goes when the next one is written.
    """
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other")).where("node <> other")
    both = staged(both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "links")
    labels = staged(
        both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("label")),
        "labels",
        small=True,
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("other"), "label"), "other")
            .groupBy("node")
            .agg(F.min("label").alias("near"))
        )
        better = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        moved = staged(
            better.join(jump, "next").select("node", F.col("label").alias("before"), F.least("next", "far").alias("label")),
            "labels",
            small=True,
        )
        done = moved.where(F.col("before") != F.col("label")).isEmpty()
        discard(labels)
        labels = moved.select("node", "label")
        labels.staged_folder = moved.staged_folder
        if done:
            discard(both)
            return labels
