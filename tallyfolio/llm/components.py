"""Connected components of links by alternating stars, each step written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfolio.llm.common import join_groups, written

STEPS = 60


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, label): the smallest id each linked id can reach. Ids without links don't appear.

    A large star hangs the larger neighbours of a node on the smallest one; a small star does so with
    the smaller ones. Minima are partial sums and a hot node's edges are a join that can be split, so no
    neighbourhood is gathered. It ends when every edge points at the smallest id of its component."""
    high, low = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    edges = written(links.filter(F.col(a) != F.col(b)).select(high, low).distinct(), "stars")
    before = None
    for _ in range(STEPS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = join_groups(both, least, ["u"], "inner").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = join_groups(large, least, ["u"], "inner")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(least.select("u", F.col("m").alias("v")))
        edges = written(small.distinct(), "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {STEPS} steps")
    tops = edges.select(F.col("v").alias("id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(tops.select("id", F.col("id").alias("label")))
