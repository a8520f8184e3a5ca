"""Change detection between runs: keyed diff, upsert, coverage, status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEW, MODIFIED, SAME, GONE = "νέο", "τροποποιημένο", "αμετάβλητο", "απόν"


def diff(old: DataFrame, new: DataFrame, key: str = "id", checksum: str = "checksum_keimenou") -> DataFrame:
    """(id, kind, old, new) of every id on either side; equal checksums, both null included, are unchanged."""
    a = old.select(key, F.col(checksum).alias("old"), F.lit(True).alias("was"))
    b = new.select(key, F.col(checksum).alias("new"), F.lit(True).alias("is"))
    kind = F.when(F.col("was").isNull(), NEW).when(F.col("is").isNull(), GONE).when(F.col("old").eqNullSafe(F.col("new")), SAME).otherwise(MODIFIED)
    return a.join(b, key, "full_outer").select(key, kind.alias("kind"), "old", "new")


def material(changes: DataFrame) -> DataFrame:
    return changes.where(F.col("kind") != SAME)


def upsert(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Old entries, with those of `new` in place of them as a whole; ids that only one side has stay."""
    columns = [c for c in old.columns if c != key]
    a = old.select(key, F.struct(*columns).alias("a"))
    b = new.select(key, F.struct(*columns).alias("b"))
    return a.join(b, key, "full_outer").select(key, F.coalesce("b", "a").alias("e")).select(key, "e.*")


def missing(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """Rows of `left` whose id `right` lacks."""
    return left.join(right.select(key), key, "left_anti")


def status(laws: DataFrame, manifest: DataFrame, files: DataFrame, count: str = "plithos_arthron") -> DataFrame:
    """(id, present, articles): the count where file and entry both exist, `?` if the entry lacks it."""
    entry = manifest.select("id", F.lit(True).alias("entered"), F.col(count).cast("string").alias("n"))
    there = files.select("id", F.lit(True).alias("there"))
    rows = laws.select("id").join(entry, "id", "left").join(there, "id", "left")
    both = F.col("entered") & F.col("there")
    return rows.select("id", F.coalesce("there", F.lit(False)).alias("present"), F.when(both, F.coalesce("n", F.lit("?"))).otherwise("").alias("articles"))


def presence_totals(told: DataFrame) -> DataFrame:
    """(present, missing, laws) of status()."""
    return told.agg(F.count_if("present").alias("present"), F.count_if(~F.col("present")).alias("missing"), F.count("*").alias("laws"))


def run_totals(entries: DataFrame) -> DataFrame:
    """(successes, failures) of a run's entries; those with an error failed."""
    return entries.agg(F.count_if(F.col("error").isNull()).alias("successes"), F.count_if(F.col("error").isNotNull()).alias("failures"))


def manifest_json(entries: DataFrame, stamp: Column) -> DataFrame:
    """One row (json): stamp, number of entries, and the entries by id, keys in order; for manifests of some thousand laws."""
    fields = F.struct(*[c for c in entries.columns if c != "id"])
    one = entries.agg(F.count("*").alias("plithos"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("id"), fields.alias("e"))))).alias("nomothetimata"))
    return one.select(F.to_json(F.struct(stamp.alias("enimerosi"), "plithos", "nomothetimata")).alias("json"))
