"""The response cache: answers by address in a versioned table, asked before a run and merged after it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexicord.operators import fallback
from lexicord.sources.buckets import BucketTable
from lexicord.sources.tables import cache_key

CACHED = "key string, url string, etag string, last_modified string, content_type string, content binary"


class ResponseCache:
    """One entry for each address; a run asks with its headers, and its answers make the next version."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.table = BucketTable(spark, root, CACHED, key="key", buckets=buckets)

    def read(self, version: int | None = None) -> DataFrame:
        return self.table.read(version)

    def requests(self, urls: DataFrame, fresh: bool = False) -> DataFrame:
        """(url, etag, last_modified) of each distinct address: what to send; nulls where there is no entry, or fresh copies are wanted."""
        return fallback.conditional_headers(urls.select("url").distinct(), self.read(), fresh)

    def store(self, answers: DataFrame, version: int) -> bool:
        """Merge (url, attempt, status, etag, last_modified, content_type, content, error) of a run.

        Of an address's attempts the last counts.  An answer with a body replaces
        the entry as a whole, missing headers as empty strings; 304 and failures
        keep it.
        """
        last = answers.groupBy("url").agg(F.max_by(F.struct("status", "etag", "last_modified", "content_type", "content", "error"), "attempt").alias("a"))
        outcome = fallback.http_outcome(F.col("a.status"), F.coalesce(F.octet_length("a.content"), F.lit(0)), F.lit(True), F.col("a.error"))
        headers = [F.coalesce(F.col(f"a.{c}"), F.lit("")).alias(c) for c in ("etag", "last_modified", "content_type")]
        good = last.where(outcome == "done").select(cache_key(F.col("url")).alias("key"), "url", *headers, F.col("a.content").alias("content"))
        return self.table.merge(good, version, replaced)

    def answered(self, answers: DataFrame) -> DataFrame:
        """(url, content, content_type, from_cache) of each address: the new body, or for 304 the one that is kept."""
        last = answers.groupBy("url").agg(F.max_by(F.struct("status", "content", "content_type", "error"), "attempt").alias("a"))
        rows = last.select("url", "a", cache_key(F.col("url")).alias("key")).join(self.read().select("key", F.col("content").alias("kept"), F.col("content_type").alias("kept_type")), "key", "left")
        outcome = fallback.http_outcome(F.col("a.status"), F.coalesce(F.octet_length("a.content"), F.lit(0)), F.col("kept").isNotNull(), F.col("a.error"))
        rows = rows.withColumn("outcome", outcome).where("outcome in ('done', 'cached')")
        old = F.col("outcome") == "cached"
        return rows.select("url", F.when(old, F.col("kept")).otherwise(F.col("a.content")).alias("content"), F.when(old, F.col("kept_type")).otherwise(F.coalesce("a.content_type", F.lit(""))).alias("content_type"), old.alias("from_cache"))


def replaced(old: DataFrame, new: DataFrame) -> DataFrame:
    """New entries, and old ones of other keys."""
    return old.join(new.select("key"), "key", "left_anti").unionByName(new)
