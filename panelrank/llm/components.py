"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a grouped minimum and a join, so a node with a third of all edges is only a skewed join key
(which adaptive execution splits). Edges are written after every round; nothing reaches the driver but a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelrank.llm.store import Store


def components(edges: DataFrame, store: Store, tag: str = "cc", rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long); component is the smallest node reachable."""
    def mark(df: DataFrame) -> tuple:
        r = df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(r)

    e = store.write(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), f"{tag}-0")
    seen = mark(e)
    for i in range(1, rounds + 1):
        if not seen[0]:
            break
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
        e = store.write(small, f"{tag}-{i}")
        store.drop(f"{tag}-{i - 1}")
        now = mark(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component").unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
