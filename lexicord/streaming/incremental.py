"""Incremental runs: new texts arrive as files, the manifest is merged batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexicord.operators import changes
from lexicord.sources.buckets import BucketTable

ENTRY = "id string, checksum_keimenou string"


def checksums(texts: DataFrame) -> DataFrame:
    """(id, checksum_keimenou) of each id, the latest text where a batch has several."""
    last = texts.groupBy("id").agg(F.max_by("text", "seen").alias("text"))
    return last.select("id", F.sha2(F.encode("text", "UTF-8"), 256).alias("checksum_keimenou"))


def manifest_table(spark: SparkSession, state: str, buckets: int = 64) -> BucketTable:
    return BucketTable(spark, state, ENTRY, key="id", buckets=buckets)


def merge_available(spark: SparkSession, source: str, schema: str, state: str, checkpoint: str, report: Callable[[DataFrame, int], None], buckets: int = 64, keep: int = 10) -> StreamingQuery:
    """Read what is new below `source` (parquet with id, text, seen), merge it into the manifest table below `state`, report material changes.

    A batch's number is its version, and only the buckets that its ids hit are read
    and written, so a batch costs what it holds.  A batch that runs again after a
    failure finds its version there, or writes the same one; it is reported again,
    since the report may not have come through.
    """
    table = manifest_table(spark, state, buckets)

    def merge(rows: DataFrame, batch: int) -> None:
        table.merge(checksums(rows), batch, changes.upsert)
        before = [v for v in table.versions() if v < batch]
        ids = rows.select("id").distinct()
        now, _ = table.hit(ids, batch)
        was = table.hit(ids, before[-1])[0] if before else now.limit(0)
        report(changes.material(changes.diff(was, now)), batch)
        table.clean(keep)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
