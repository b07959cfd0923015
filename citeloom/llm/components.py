"""Connected components of links too many for one machine."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.sources.staged import new_stage_path, write_stage


def merge_links(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels of a task's own nodes after linking a[i] with b[i]; the smallest index names a set."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            shorter = labels[labels]
            if (shorter == labels).all():
                break
            labels = shorter


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest one: those above a node (large), or those below it."""
    pairs = edges.union(edges.select("b", "a")) if large else edges
    pairs = pairs.toDF("u", "v")
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    joined = pairs.join(least.withColumn("m", F.least("u", "m")), "u")
    if large:
        moved = joined.where("v > u").select("v", "m")
    else:
        moved = joined.select("v", "m").union(least.select("u", "m"))
    return moved.toDF("a", "b").where("a <> b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``(id, component)`` of every node of ``links(a, b)``: the smallest id reachable.

    Alternates large and small stars until nothing changes. Each round ends in
    a table in the shared folder; only its row count and hash sum come to the
    driver. A node of very many links is joined with one row, so adaptive
    execution may split it. Self links are ignored, null ends are not allowed;
    no links give no rows.
    """
    spark = links.sparkSession

    def staged(df: DataFrame) -> tuple[DataFrame, tuple]:
        table = write_stage(df, new_stage_path(spark, "links"))
        mark = table.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return table, tuple(mark)

    edges, mark = staged(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    while mark[0]:
        edges, new = staged(_star(_star(edges, large=True), large=False))
        if new == mark:
            break
        mark = new
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        edges.select("b", "b").distinct()
    )
