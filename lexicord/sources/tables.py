"""Tables of the corpus: registry, records, manifest, files, cache; readers and writers."""

from __future__ import annotations

import datetime
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexicord.functions import rules
from lexicord.functions.text import content_kind

FEK = T.StructType([T.StructField("teuxos", T.StringType()), T.StructField("arithmos", T.IntegerType()), T.StructField("imerominia", T.DateType())])
SOURCE = T.StructType([T.StructField("typos", T.StringType()), T.StructField("url", T.StringType())])
LAW = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id", "titlos", "syntomos_titlos", "typos", "arithmos")]
    + [T.StructField("etos", T.IntegerType()), T.StructField("fek", FEK), T.StructField("celex", T.StringType()), T.StructField("thematiki", T.StringType())]
    + [T.StructField("proteraiotita", T.IntegerType()), T.StructField("katastasi", T.StringType()), T.StructField("isxys_apo", T.DateType()), T.StructField("epalithevmeno", T.BooleanType()), T.StructField("perigrafi", T.StringType())]
    + [T.StructField("relevanta_arthra", T.ArrayType(T.IntegerType())), T.StructField("scheseis", T.StructType([T.StructField(r, T.ArrayType(T.StringType())) for r in rules.RELATIONS]))]
    + [T.StructField("piges", T.ArrayType(SOURCE)), T.StructField("simeioseis", T.StringType()), T.StructField("prosochi", T.StringType())]
)
RECORD = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "nomothetima_id", "nomothetima", "titlos_nomothetimatos", "thematiki", "arthro", "titlos_arthrou", "paragrafos", "meros", "meros_titlos", "kefalaio", "kefalaio_titlos", "keimeno", "fek", "celex", "isxys_apo", "katastasi")] + [T.StructField("epalithevmeno", T.BooleanType()), T.StructField("pigi_url", T.StringType()), T.StructField("anaktithike", T.StringType())])
ENTRY = "checksum_pigis string, checksum_keimenou string, plithos_arthron long, plithos_paragrafon long, pigi_url string, epalithevmeno_fek boolean"


def shared_root(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, or the one that is set; one is made only where Spark runs on one machine."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def new_folder(spark: SparkSession) -> str:
    """A place below the shared folder that no one else uses."""
    return f"{shared_root(spark)}/corpus-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows from the shared checkpoint folder; lineage ends there."""
    shared_root(df.sparkSession)
    return df.checkpoint()


def registry(spark: SparkSession, path: str) -> DataFrame:
    """Laws of a registry file (YAML, some hundred entries), with the fixed schema; absent lists are empty."""
    import yaml

    text = spark.read.text(path, wholetext=True).first()[0]

    def day(x):
        return datetime.date.fromisoformat(str(x)) if x else None

    def row(law: dict) -> dict:
        fek, relations = law.get("fek"), law.get("scheseis") or {}
        return {n: law.get(n) for n in LAW.names} | {
            "arithmos": str(law["arithmos"]),
            "fek": fek and {"teuxos": fek["teuxos"], "arithmos": fek["arithmos"], "imerominia": day(fek["imerominia"])},
            "isxys_apo": day(law.get("isxys_apo")),
            "katastasi": law.get("katastasi", rules.IN_FORCE),
            "epalithevmeno": bool(law.get("epalithevmeno", False)),
            "relevanta_arthra": law.get("relevanta_arthra") or [],
            "scheseis": {r: relations.get(r) or [] for r in rules.RELATIONS},
            "piges": [{"typos": s["typos"], "url": str(s["url"])} for s in law.get("piges") or []],
        }

    return spark.createDataFrame([row(law) for law in yaml.safe_load(text)["nomothetimata"]], LAW)


def records(spark: SparkSession, path: str) -> DataFrame:
    """Paragraph records of JSON lines; blank lines are skipped, missing texts are empty."""
    rows = spark.read.schema(RECORD).json(path)
    return rows.select(*[F.coalesce(c, F.lit("")).alias(c) if c in ("titlos_arthrou", "paragrafos", "meros_titlos", "kefalaio_titlos") else F.col(c) for c in rows.columns])


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a manifest file, one row for each law; a missing file has none."""
    try:
        found = spark.read.schema(f"enimerosi string, plithos long, nomothetimata map<string, struct<{ENTRY.replace(' ', ':').replace(',:', ',')}>>").json(path, multiLine=True)
        found.limit(1).collect()
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], f"id string, {ENTRY}")
    return found.select(F.explode("nomothetimata").alias("id", "e")).select("id", "e.*")


def files(spark: SparkSession, path: str) -> DataFrame:
    """(url, content, content_type, kind, checksum) of the files below a folder."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    kind = F.when(F.lower("path").endswith(".pdf"), "application/pdf").otherwise("text/html")
    return rows.select(F.col("path").alias("url"), "content", kind.alias("content_type"), content_kind(F.col("content")).alias("kind"), F.sha2("content", 256).alias("checksum"))


def cache_key(url) -> F.Column:
    """The name under which an answer is kept."""
    return F.substring(F.sha2(F.encode(url, "UTF-8"), 256), 1, 24)


def write_records(rows: DataFrame, path: str) -> None:
    """JSON lines, a folder for each theme and law."""
    rows.withColumns({"theme": F.col("thematiki"), "law": F.col("nomothetima_id")}).write.partitionBy("theme", "law").mode("overwrite").json(path)


def write_meta(rows: DataFrame, path: str) -> None:
    """A JSON object for each law, with its null fields, in a folder for each theme and law."""
    rows.withColumns({"theme": F.col("thematiki"), "law": F.col("id")}).write.partitionBy("theme", "law").option("ignoreNullFields", "false").mode("overwrite").json(path)


def write_documents(rows: DataFrame, path: str, *folders: str) -> None:
    """One text file (or few) of column `document` in a folder for each value of `folders`."""
    named = rows.withColumns({f"by_{c}": F.col(c) for c in folders})
    named.select("document", *[f"by_{c}" for c in folders]).write.partitionBy(*[f"by_{c}" for c in folders]).option("lineSep", "").mode("overwrite").text(path)


