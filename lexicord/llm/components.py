"""Connected components of an edge table, by alternating large-star and small-star rounds.

Each round hangs neighbours on the least id around them; the number of rounds
grows with the logarithm of the longest path.  A round is two aggregations that
combine before their shuffle and two joins; its result is a table in the shared
folder, so lineage stays short and lost executors cost one round at most.
Nothing is collected but one row of sums a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicord.llm.shared import dropped, written


def _turn(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star round over edges (u, v) with u > v."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
    down = large.groupBy("u").agg(F.min("v").alias("m"))
    joined = large.join(down, "u")
    small = joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.select("u", F.col("m").alias("v")))
    return small.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component_id) of every id in edges (a, b); component_id is the least id reachable."""
    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    sums = None
    while True:
        then = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if sums == then:
            break
        before, sums, now = now, then, written(_turn(now))
        dropped(before)
    ids = now.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    return ids.unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct())
