"""Near duplicates among embeddings by collision counting on random projections.

Unit vectors are projected onto many random directions.  Vectors whose cosine is
c lie sqrt(2 - 2c) apart, so on one direction their values differ by a normal
variable of that deviation, and a window around a query's value holds its partner
with a known probability.  A pair that misses fewer projections than there are
groups of projections is verified; the windows are just so wide that a pair at the
threshold passes this count with the recall asked for (0.999, exact for
independent normal directions, whatever the vectors).

A pair that passes the count hits every projection of at least one group, as its
misses are fewer than the groups.  So pairs meet group by group: rows are sorted by
the cells of a group's first projections, a query goes to the cells its windows
touch, and there the join hands on only pairs that collide on the whole group, whose
collisions are then counted.  How many projections make a cell grows with
the logarithm of the rows, which keeps the rows of a cell few; it changes where
pairs meet, never which pairs pass.  A cell of any size is a skewed key of a
sort-merge join, which adaptive execution splits.  Exact copies are one row until
the end, so a vector of any number of copies makes no pairs.

Edge cases: vectors that are null, empty or zero or that hold null or non-finite
components, and vectors without label or id, link with nothing; so do vectors of
different lengths.  Rows that repeat id, vector and label count once; different
vectors of one id count as one in components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from math import ceil, comb, erf, log, sqrt
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexicord.llm.components import components
from lexicord.llm.shared import dropped, written

SEED = 20240229

#: Projections are kept in whole steps between -FAR and FAR; what lies further out only comes nearer.
FAR = 16_000

#: Rows of a cell, all labels taken together, below which no further projection cuts cells.
FEW = 1_000


def passing(hit: float, projections: int, spare: int) -> float:
    """Probability of at most `spare` misses."""
    return sum(comb(projections, k) * (1 - hit) ** k * hit ** (projections - k) for k in range(spare + 1))


def half_width(threshold: float, projections: int, groups: int, recall: float) -> float:
    """Half-width of the windows with which a pair at the threshold misses fewer projections than there are groups."""
    low, high = 0.0, 10.0
    for _ in range(60):
        width = (low + high) / 2
        low, high = (width, high) if passing(erf(width / sqrt(2)), projections, groups - 1) < recall else (low, width)
    return high * sqrt(2 - 2 * threshold)


@lru_cache(maxsize=8)
def directions(length: int, projections: int) -> np.ndarray:
    """The same for all workers; one matrix for each length of vectors."""
    return np.random.default_rng([SEED, length]).standard_normal((length, projections))


def projected(flat: np.ndarray, lengths: np.ndarray, projections: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Projections of the unit vectors, powers of two that bring the vectors near one, and lengths of the vectors so brought."""
    starts, at = np.cumsum(lengths) - lengths, np.zeros((len(lengths), projections))
    scale, norm = np.ones(len(lengths)), np.ones(len(lengths))
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        m = flat[starts[rows][:, None] + np.arange(length)]
        scale[rows] = np.ldexp(1.0, np.clip(-np.frexp(np.abs(m).max(axis=1))[1], -1022, 1000))
        m = m * scale[rows][:, None]
        norm[rows] = np.linalg.norm(m, axis=1)
        at[rows] = m / norm[rows][:, None] @ directions(int(length), projections)
    return at, scale, norm


def meetings(points: DataFrame, step: int, groups: int, size: int, cut: int) -> DataFrame:
    """(a, b), a the lesser, of points (id, base, at) with equal base whose windows collide on every projection of a group; a row for each such group."""
    reach, wide = step + 1, 2 * step + 4  # a step of slack for rounding; a window touches two cells at most
    dealt = points.select("id", "base", "at", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("j")).select("id", "base", "j", F.slice("at", F.col("j") * size + 1, size).alias("at"))

    def value(name: str, k: int) -> Column:
        return F.get(name, F.lit(k)).cast("int")

    def cell(at: Column) -> Column:
        return F.floor(at / wide)

    home = dealt.select(F.xxhash64("base", "j", *(cell(value("at", k)) for k in range(cut))).alias("key"), F.col("id").alias("b"), F.col("at").alias("at2"))
    query = dealt
    for k in range(cut):  # of a pair the one with the lower first value asks
        query = query.withColumn(f"c{k}", F.explode(F.array_distinct(F.array(cell(value("at", k) - (reach if k else 0)), cell(value("at", k) + reach)))))
    query = query.select(F.xxhash64("base", "j", *(f"c{k}" for k in range(cut))).alias("key"), F.col("id").alias("a"), "at")
    ahead = value("at2", 0) - value("at", 0)
    asks = ahead.between(0, reach) & ((ahead > 0) | (F.col("a") < F.col("b")))
    return query.hint("merge").join(home, "key").where(reduce(and_, (F.abs(value("at", k) - value("at2", k)) <= reach for k in range(1, size)), asks)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def collisions(step: int) -> Column:
    """On how many projections the windows of at1 and at2 collide."""
    return F.aggregate(F.zip_with("at1", "at2", lambda x, y: F.abs(x.cast("int") - y.cast("int")) <= step + 1), F.lit(0), lambda n, hit: n + hit.cast("int"))


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, groups: int = 4, size: int = 8, recall: float = 0.999) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each vector."""
    projections, half = groups * size, half_width(threshold, groups * size, groups, recall)
    step = min(1_000, max(8, int(FAR * half / 6)))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), F.col("embedding").cast("array<double>").alias("v")).dropDuplicates(["vec_id", "label", "v"])
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    copies = rows.where(sound).groupBy("label", "v").agg(F.min("vec_id").alias("id"), F.count("*").alias("times"))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            at, scale, norm = projected(v.flatten().to_numpy(zero_copy_only=False), np.diff(v.offsets.to_numpy()), projections)
            steps = pa.array(np.clip(np.rint(at * (step / half)), -FAR, FAR).astype(np.int16).ravel())
            ends = pa.array(np.arange(len(at) + 1, dtype=np.int32) * projections)
            yield pa.record_batch([*batch.columns, pa.ListArray.from_arrays(ends, steps), pa.array(scale), pa.array(norm)], [*batch.schema.names, "at", "scale", "norm"])

    label_type = copies.schema["label"].dataType.simpleString()
    based = copies.withColumn("base", F.xxhash64("label", F.size("v")))
    points = written(based.mapInArrow(project, f"label {label_type}, v array<double>, id long, times long, base long, at array<smallint>, scale double, norm double"))
    cut = min(size, max(1, ceil(log(max(1, points.count()) / FEW) / log(4))))  # about four cells hold what one projection spreads
    passed = written(meetings(points, step, groups, size, cut).distinct())  # a pair is verified once, however many groups it hits

    def end(name: str, mark: str) -> DataFrame:
        return points.select(F.col("id").alias(name), *(F.col(c).alias(c + mark) for c in ("label", "v", "at", "scale", "norm")))

    dot = F.aggregate(F.zip_with("v1", "v2", lambda x, y: (x * F.col("scale1")) * (y * F.col("scale2"))), F.lit(0.0), lambda s, x: s + x)
    alike = (F.col("label1") == F.col("label2")) & (F.size("v1") == F.size("v2"))
    near = passed.join(end("a", "1"), "a").join(end("b", "2"), "b").where(alike & (collisions(step) > projections - groups)).where(dot / (F.col("norm1") * F.col("norm2")) >= threshold)
    edges = written(near.where("a != b").select("a", "b").distinct())
    dropped(passed)
    ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = written(ends.join(points.select(F.col("id").alias("b"), "times"), "b").groupBy(F.col("a").alias("id")).agg(F.sum("times").alias("others")))
    joined = components(edges)
    dropped(edges)
    found = points.select("label", "v", "id", "times").join(links, "id", "left").join(joined, "id", "left")
    told = found.select("label", "v", (F.col("times") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    out = rows.withColumn("sound", sound).join(told, ["label", "v"], "left")
    own = F.when(F.col("sound"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.when(F.col("sound"), F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), (own == F.col("vec_id")).alias("kept"))
