"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, root) for each node that isn't the smallest of its component; root is the smallest.

    Links are never gathered: a step is two joins on a node, whose minimum is aggregated before the shuffle and, in the first, checkpointed, so
    that Spark can split the join at nodes of many links; the driver sees a count and a checksum. Loops and rows with a
    null end are left out.
    """
    u, v = F.col("u"), F.col("v")
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).isNull().alias("x"), F.col(b).isNull().alias("y"))
    e = cut(e.where((u > v) & ~F.col("x") & ~F.col("y")).select("u", "v").distinct())
    seen = None
    while True:
        now = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now[0] == 0 or now == seen:
            return e.select(u.alias("node"), v.alias("root"))
        seen = now
        both = e.unionByName(e.select(v.alias("u"), u.alias("v")))
        least = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.where(v > u).join(least, "u").select(v.alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(v > F.col("m")).select(v.alias("u"), F.col("m").alias("v"))
        e = cut(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
