"""A training corpus from raw documents: five stages, each a Spark job over all that its predecessor kept.

Each stage takes (spark, docs, sf_dir), docs with the columns of `documents`,
and returns a DataFrame; run() writes each result as Parquet in the shared
folder and reads it again as the next stage's docs.

1. quality: documents that the line field rejects go.
2. lines: lines that repeat an earlier line, exactly (of any length) or but for
   one word, go; a document of whose lines only blank ones stay is a copy and
   goes with them, unless it had no others before.
3. near_duplicates: of each group of documents linked by five-word shingles at a
   Jaccard similarity of 0.8 or more, the one with the least id stays.
4. decontamination: documents that hold a passage of the benchmark go.
5. tokens: the ids of what is left, and the text they decode to.

In every stage null text counts as empty, columns beyond those of documents pass
through (all stages but the last), and an empty table gives an empty table.  Rows
without id are judged by their own text in `quality` and `decontamination`, come
last in `lines`, where copies go, and stay in `near_duplicates`.  Repeated rows are
judged alike; in `lines` and `near_duplicates` rows of one id are no copies of each
other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexicord.llm.bpe import encode_documents
from lexicord.llm.decontam import drop_contaminated
from lexicord.llm.linededup import line_dedup
from lexicord.llm.ngramjoin import document_components
from lexicord.llm.quality import fit, keep_good
from lexicord.llm.queries import tokenizer_path
from lexicord.llm.shared import dropped, table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.3 or more."""
    return keep_good(docs, fit(docs, table(spark, sf_dir, "labels")), threshold=0.3)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated lines; n_chars is counted anew."""
    kept = line_dedup(docs, exact_words=1).where(F.coalesce("text", F.lit("")).rlike(r"[^ \t\r\n]") | (F.col("n_exact") + F.col("n_near") == 0))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each component; rows without id stay."""
    found = document_components(docs, k=5, percent=80)
    gone = found.where("component_id != doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document."""
    coded = encode_documents(docs, tokenizer_path("byte_bpe_50k.json"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("tokens", token_stage),
]

#: The classifier and the latent retrieval have no SQL form.  Operators are tested against brute force, stages for what they keep.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        before, docs = docs, written(stage(spark, docs, sf_dir))
        dropped(before)  # a stage's result goes when the next one has read it
    return docs
