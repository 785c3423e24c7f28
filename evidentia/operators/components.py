"""Connected components of an edge table, as alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.session import cut


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Label every node that has an edge with the smallest node of its component.

    Returns (node, component). Null ends and self loops link nothing and are dropped, repeated edges
    count once, and an empty table gives an empty result. The minima are plain aggregates, so a hub
    with very many edges is combined before the shuffle, and every round is checkpointed.
    """
    e = (
        edges.where(F.col(src) != F.col(dst))
        .select(F.least(src, dst).alias("u"), F.greatest(src, dst).alias("v"))
        .distinct()
    )
    e = cut(e)
    before = _fingerprint(e)
    while before[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hub = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        wide = both.where("v > u").join(hub, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = wide.groupBy("u").agg(F.min("v").alias("m"))
        near = wide.join(low, "u")
        e = cut(
            near.select(F.col("v").alias("a"), F.col("m").alias("b"))
            .union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
            .where("a <> b")
            .select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
            .select("u", "v")
            .distinct()
        )
        after = _fingerprint(e)
        if after == before:
            break
        before = after
    leaves = e.groupBy("v").agg(F.min("u").alias("component")).select(F.col("v").alias("node"), "component")
    roots = leaves.select("component").distinct().select(F.col("component").alias("node"), "component")
    return leaves.union(roots)
