"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbsight.operators.scratch import written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Returns ``(node, component)`` for every node that has an edge; the component is its smallest node.

    Alternating large-star and small-star steps (Kiveris et al. 2014). Each step is two partial aggregates and joins,
    so the neighbours of a hub are never gathered; the edge table is written to the shared folder after each round, and
    the rounds end when it no longer changes. Null ends and loops are ignored; no edges give no rows.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct()
    seal = F.struct(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)))
    before = None
    e = written(e, "edges")
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.select("u", F.col("m").alias("v"))).distinct()
        e = written(small, "edges")
        now = e.agg(seal.alias("s")).first()["s"]
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
