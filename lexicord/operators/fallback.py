"""Sources of laws: order of preference, first success, attempts over HTTP."""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexicord.functions import rules

UNLISTED = 999


def rank(law_type: Column, source_type: Column) -> Column:
    """Place of a source type for a law type; types that are not listed come last."""

    def placed(order: tuple[str, ...]) -> Column:
        out = F.lit(UNLISTED)
        for k, t in enumerate(order):
            out = F.when(source_type == t, k).otherwise(out)
        return out

    return F.when(law_type.isin(*rules.EU_ACTS), placed(rules.SOURCE_ORDER_EU)).otherwise(placed(rules.SOURCE_ORDER))


def ranked_sources(laws: DataFrame) -> DataFrame:
    """(id, nth, source_type, url): all sources but supplements, the preferred first, equals in file order."""
    rows = laws.select("id", "typos", F.posexplode("piges").alias("at", "s")).where(F.col("s.typos") != rules.SUPPLEMENT)
    order = Window.partitionBy("id").orderBy(rank(F.col("typos"), F.col("s.typos")), "at")
    return rows.select("id", F.row_number().over(order).alias("nth"), F.col("s.typos").alias("source_type"), F.col("s.url").alias("url"))


def first_success(attempts: DataFrame, key: str, order: str, ok: Column) -> DataFrame:
    """(key, winner, failures): the least place that succeeded, null if none, and the places that failed before it."""
    best = F.min(F.when(ok, F.col(order)))
    failed = F.array_sort(F.collect_list(F.when(~ok, F.col(order))))
    told = attempts.groupBy(key).agg(best.alias("winner"), failed.alias("failed"))
    return told.select(key, "winner", F.filter("failed", lambda x: F.col("winner").isNull() | (x < F.col("winner"))).alias("failures"))


def supplements(laws: DataFrame) -> DataFrame:
    """(id, file, url): supplements of each law, in file order."""
    rows = laws.select("id", F.posexplode("piges").alias("file", "s")).where(F.col("s.typos") == rules.SUPPLEMENT)
    return rows.select("id", "file", F.col("s.url").alias("url"))


def waves(ranked: DataFrame, extract: Callable[[DataFrame], DataFrame], most: int | None = None) -> DataFrame:
    """Try sources rank by rank: wave n takes the n-th source of laws without success yet.

    extract adds `text` and `error` to its rows; a row without error is a success.
    A lower source of a law whose higher source worked is never asked.  The result
    has a row for each try; all sources are tried unless `most` bounds the tries.
    plans.pipelines.settled() judges sources by their articles.
    """
    from lexicord.sources.tables import checkpointed

    tried, left = None, ranked
    for n in count(1):
        turn = checkpointed(extract(left.where(F.col("nth") == n)))
        tried = turn if tried is None else tried.unionByName(turn)
        left = left.join(turn.where("error is null").select("id").distinct(), "id", "left_anti")
        if n == most or left.where(F.col("nth") > n).isEmpty():
            return tried


def warnings(tried: DataFrame) -> DataFrame:
    """(id, url, proeidopoiiseis): the source that worked, and what failed before, the notice of another source first."""
    good = F.col("error").isNull()
    won = F.min_by(F.when(good, F.struct("nth", "source_type", "url")), F.when(good, F.col("nth")))
    told = tried.groupBy("id").agg(won.alias("won"), F.transform(F.array_sort(F.collect_list(F.when(~good, F.struct("nth", "source_type", "error")))), lambda x: F.concat(x["source_type"], F.lit(": "), x["error"])).alias("failed"))
    other = F.when(F.col("won.source_type") == rules.LOCAL_COPY, F.format_string(rules.SAYS_LOCAL_COPY, "won.url")).otherwise(F.format_string(rules.SAYS_OTHER_SOURCE, "won.source_type", "won.url"))
    notice = F.when(F.col("won").isNotNull() & (F.size("failed") > 0), F.array(other)).otherwise(F.array().cast("array<string>"))
    return told.select("id", F.col("won.url").alias("url"), F.concat(notice, "failed").alias("proeidopoiiseis"))


def http_outcome(status: Column, size: Column, cached: Column, error: Column) -> Column:
    """What one attempt means: done, cached, retry or failed."""
    return (
        F.when(error == "proxy", "failed")
        .when(error.isNotNull(), "retry_transport")
        .when((status == 304) & cached, "cached")
        .when((status == 429) | (status >= 500), "retry_busy")
        .when(status >= 400, "failed")
        .when(size == 0, "retry_busy")
        .otherwise("done")
    )


def pause_seconds(outcome: Column, attempt: Column) -> Column:
    """Seconds before the next attempt; attempts count from 0."""
    return F.when(outcome == "retry_transport", F.pow(F.lit(2), attempt)).when(outcome == "retry_busy", F.least(F.lit(5) * F.pow(F.lit(2), attempt), F.lit(60))).otherwise(0).cast("long")


def final_outcome(attempts: DataFrame, key: str, attempt: str, most: int = 4) -> DataFrame:
    """(key, outcome, attempts, waited) from rows with `outcome`: the first that ends the matter within `most` attempts, else failed."""
    rows = attempts.where(F.col(attempt) < most)
    ends = ~F.col("outcome").startswith("retry")
    last = rows.groupBy(key).agg(F.min(F.when(ends, F.col(attempt))).alias("end"), F.min_by(F.when(ends, F.col("outcome")), F.when(ends, F.col(attempt))).alias("found"))
    kept = rows.join(last, key).where(F.col("end").isNull() | (F.col(attempt) <= F.col("end")))
    return kept.groupBy(key, "found").agg(F.count("*").alias("attempts"), F.sum(pause_seconds(F.col("outcome"), F.col(attempt))).alias("waited")).select(key, F.coalesce("found", F.lit("failed")).alias("outcome"), "attempts", "waited")


def conditional_headers(requests: DataFrame, cache: DataFrame, fresh: bool = False) -> DataFrame:
    """(url, etag, last_modified) to send with each request: from the cache, none when fresh copies are asked for."""
    key = F.substring(F.sha2(F.encode("url", "UTF-8"), 256), 1, 24)
    joined = requests.select("url", key.alias("key")).join(cache.select("key", "etag", "last_modified"), "key", "left")
    keep = F.lit(not fresh)
    return joined.select("url", F.when(keep, F.col("etag")).alias("etag"), F.when(keep, F.col("last_modified")).alias("last_modified"))
