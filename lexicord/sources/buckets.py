"""Keyed tables in bucket folders with a version log: a merge rewrites only the buckets that its keys hit.

    <root>/data/v<version>/bucket=<k>/part-*.parquet
    <root>/log/<version>.json      {"buckets": n, "key": key, "folders": {bucket: version}}

A version is the log file of its number, which is written aside and renamed, so a
reader sees the old state or the new one.  A merge that is run again under a
version that exists changes nothing; data that a failed one left are overwritten.
A log has one entry for each bucket, whatever the table's size.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class BucketTable:
    """A keyed table below `root`; `schema` is DDL and holds the key column, of which no two rows have the same."""

    def __init__(self, spark: SparkSession, root: str, schema: str, key: str = "id", buckets: int = 64):
        self.spark, self.root, self.schema, self.key, self.buckets = spark, root.rstrip("/"), schema, key, buckets
        self._jvm = spark.sparkContext._jvm
        self._log = self._path("log")
        self._fs = self._log.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def versions(self) -> list[int]:
        """Numbers of all versions, ascending."""
        found = self._fs.listStatus(self._log) if self._fs.exists(self._log) else []
        names = [f.getPath().getName() for f in found]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit())

    def folders(self, version: int | None = None) -> dict[int, int]:
        """The version that wrote each bucket which has rows, as of a version (the latest if none is named)."""
        known = self.versions()
        if version is None:
            version = known[-1] if known else None
        if version is None:
            return {}
        stream = self._fs.open(self._path("log", f"{version}.json"))
        try:
            told = json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        if told["buckets"] != self.buckets or told["key"] != self.key:
            raise ValueError(f"the table has {told['buckets']} buckets by {told['key']}")
        return {int(k): v for k, v in told["folders"].items()}

    def _read(self, folders: dict[int, int]) -> DataFrame:
        paths = [f"{self.root}/data/v{v}/bucket={k}" for k, v in sorted(folders.items())]
        reader = self.spark.read.schema(self.schema)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self, version: int | None = None) -> DataFrame:
        """All rows as of a version."""
        return self._read(self.folders(version))

    def bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def hit(self, keys: DataFrame, version: int | None = None) -> tuple[DataFrame, set[int]]:
        """Rows of the buckets that the keys fall into, and those buckets."""
        own = {r.b for r in keys.select(self.bucket().alias("b")).distinct().collect()}  # `buckets` at most
        return self._read({k: v for k, v in self.folders(version).items() if k in own}), own

    def merge(self, new: DataFrame, version: int, rule: Callable[[DataFrame, DataFrame], DataFrame]) -> bool:
        """Make `version` of the latest one before it: rule(old, new) gives the rows of the buckets that new's keys hit.

        False, and nothing is written, if the version exists.
        """
        known = self.versions()
        if version in known:
            return False
        before = [v for v in known if v < version]
        base = self.folders(before[-1]) if before else {}
        old, own = (self.hit(new, before[-1]) if before else self.hit(new))
        folder = f"{self.root}/data/v{version}"
        rows = rule(old, new).withColumn("bucket", self.bucket())
        # rows of a bucket meet in one task, so that a bucket is a file; only hit buckets are rewritten
        rows.repartition(F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(folder)
        written = {k for k in own if self._fs.exists(self._path("data", f"v{version}", f"bucket={k}"))}
        now = {k: v for k, v in base.items() if k not in own} | dict.fromkeys(written, version)
        aside = self._path("log", f".{version}.tmp")
        out = self._fs.create(aside, True)
        try:
            out.write(json.dumps({"buckets": self.buckets, "key": self.key, "folders": now}).encode())
        finally:
            out.close()
        if not self._fs.rename(aside, self._path("log", f"{version}.json")):
            self._fs.delete(aside, False)
            raise RuntimeError(f"version {version} was written by another run")
        return True

    def clean(self, keep: int = 2) -> None:
        """Remove all versions but the latest `keep`, and the data that none of those names."""
        known = self.versions()
        kept = known[-keep:] if keep else []
        used = {(v, k) for version in kept for k, v in self.folders(version).items()}
        for version in known:
            if version not in kept:
                self._fs.delete(self._path("log", f"{version}.json"), False)
        data = self._path("data")
        for f in self._fs.listStatus(data) if self._fs.exists(data) else []:
            name = f.getPath().getName()
            v = int(name[1:])
            if kept and v > kept[-1]:
                continue  # of a merge that is going on
            own = {k for w, k in used if w == v}
            if not own:
                self._fs.delete(f.getPath(), True)
                continue
            for b in self._fs.listStatus(f.getPath()):
                part = b.getPath().getName()
                if part.startswith("bucket=") and int(part.removeprefix("bucket=")) not in own:
                    self._fs.delete(b.getPath(), True)
