"""Connected components of an edge table by alternating large-star and
small-star rounds (Kiveris et al., "Connected Components in MapReduce and
Beyond"): every round is two grouped minima and two joins over the edges
that are left, written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aerocast.llm.common import discard, stored


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(a, b) longs → (id, comp) for every id that has an edge; comp is the
    smallest id reachable.  An empty table gives an empty table; loops and
    repeated edges do not matter; nulls in either column are left out.

    A vertex with very many edges is pre-aggregated by the grouped minimum
    and its join partition can be split by adaptive execution."""
    e = (edges.where(F.col("a") != F.col("b"))
         .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    e, before = stored(e, name), None
    while True:
        seen = e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("b").cast("long"))).first()
        if not seen[0] or seen == before:
            break
        before = seen
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                 .union(low.select("a", F.col("m").alias("b"))).distinct())
        last, e = e, stored(small, name)
        discard(last)
    return e.select(F.col("a").alias("id"), F.col("b").alias("comp")).union(e.select("b", "b").distinct())
