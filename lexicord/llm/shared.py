"""The folder that the driver and all executors share, and tables written there."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; that setting is made only where it is unset and Spark runs on one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/lexicord-{uuid.uuid4().hex}"


#: With it Spark removes a statement's shuffle files when the statement ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there, and lost executors cost nothing.

    The shuffle files behind it go at once, so the disk holds what the next step needs.
    """
    spark = df.sparkSession
    path, before = shared_folder(spark), spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Remove tables of written() from the shared folder, once all that was made from them is written too."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles() if "/lexicord-" in f}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def in_waves(rows: DataFrame, key: str, step: Callable[[DataFrame], DataFrame], waves: int = 4) -> DataFrame:
    """What step makes of the rows of one part of the keys after another, at every size.

    The keys are hashes, so parts are alike, and the disk holds the shuffled rows of one part only.
    """
    return reduce(DataFrame.unionByName, [written(step(rows.where(F.pmod(key, F.lit(waves)) == wave))) for wave in range(waves)])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
