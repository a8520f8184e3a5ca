"""Carry-forward and adjacency over sequences of any length: a segment is a task's work, not a whole sequence.

Each scan takes rows of sequences (`by`) and a `segment` column that does not fall
along the order (a range of places or times).  A window runs inside each segment;
one row a segment tells what it hands on; those few rows are scanned by sequence,
and what a segment is handed joins its rows.  Rows are read twice, so they should
be a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _joined(rows: DataFrame, handed: DataFrame, by: str) -> DataFrame:
    """Rows with the columns that their segment is handed."""
    more = [c for c in handed.columns if c not in (by, "segment")]
    told = handed.select(F.col(by).alias("_by"), F.col("segment").alias("_segment"), *more)
    on = rows[by].eqNullSafe(told["_by"]) & rows["segment"].eqNullSafe(told["_segment"])
    return rows.join(told, on, "left").drop("_by", "_segment")


def carried(rows: DataFrame, by: str, order: str, values: dict[str, Column]) -> DataFrame:
    """Rows with each named value: the last that was not null up to and with the row, in its sequence."""
    rows = rows.withColumns({f"_v_{n}": F.struct(v.alias("v")) for n, v in values.items()})
    told = {n: F.when(F.col(f"_v_{n}")["v"].isNotNull(), F.col(f"_v_{n}")) for n in values}
    inside = Window.partitionBy(by, "segment").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumns({f"_l_{n}": F.last(t, True).over(inside) for n, t in told.items()})
    last = rows.groupBy(by, "segment").agg(*[F.max_by(t, F.when(t.isNotNull(), F.col(order))).alias(f"_s_{n}") for n, t in told.items()])
    before = Window.partitionBy(by).orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    handed = last.select(by, "segment", *[F.last(f"_s_{n}", True).over(before).alias(f"_h_{n}") for n in values])
    out = _joined(local, handed, by)
    return out.withColumns({n: F.coalesce(f"_l_{n}", f"_h_{n}")["v"] for n in values}).drop(*[f"_{k}_{n}" for k in "vlh" for n in values])


def adjacent_groups(rows: DataFrame, by: str, key: str, order: str) -> DataFrame:
    """`run`: number of the run of equal keys next to each other, per `by`; the same as records.adjacent_groups()."""
    inside = Window.partitionBy(by, "segment").orderBy(order)
    boxed = rows.withColumn("_k", F.struct(F.col(key).alias("k")))
    # the first row of a segment starts a run or not by what the segment before ends with
    starts = F.lag("_k").over(inside).isNotNull() & ~F.col("_k").eqNullSafe(F.lag("_k").over(inside))
    local = boxed.withColumn("_start", starts.cast("long"))
    local = local.withColumn("_run", F.sum("_start").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ends = local.groupBy(by, "segment").agg(F.min_by("_k", order).alias("_first"), F.max_by("_k", order).alias("_last"), F.sum("_start").alias("_more"))
    along = Window.partitionBy(by).orderBy("segment")
    ends = ends.withColumn("_opens", (~F.col("_first").eqNullSafe(F.lag("_last").over(along))).cast("long"))
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.select(by, "segment", (F.coalesce(F.sum(F.col("_opens") + F.col("_more")).over(before), F.lit(0)) + F.col("_opens")).alias("_base"))
    return _joined(local, handed, by).withColumn("run", F.col("_base") + F.col("_run")).drop("_k", "_start", "_run", "_base")
