"""Connected components of a stored edge list, by alternating large and small stars.

Each round connects every vertex to the smallest one near it and is stored; the number of rounds
is logarithmic in the longest path for usual graphs. A vertex with many neighbours is met by
aggregates with map-side combine and by joins that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratingloom import staging


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``u`` and ``v``: each vertex of an edge but the smallest of its component, and that smallest one.

    Null ends and loops connect nothing; repeated edges count once. No edges give no rows.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull())
    current = staging.stage(pairs.where("u <> v").distinct(), "edges")
    mark = _mark(current)
    while mark[0]:
        # both ways by one scan, not by a union of two: this plan reads it twice, and each scan and its tasks cost the driver memory
        ways = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
        both = current.select(F.inline(ways))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = staging.stage(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = staging.stage(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "small")
        before, mark = mark, _mark(current)
        if mark == before:
            break
    return current
