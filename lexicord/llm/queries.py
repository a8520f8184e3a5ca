"""The registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexicord.llm.bpe import encode_documents
from lexicord.llm import secrets
from lexicord.llm.decontam import contaminated
from lexicord.llm.filteraudit import filter_audit
from lexicord.llm.linededup import line_dedup
from lexicord.llm.neardup import near_duplicates
from lexicord.llm.ngramjoin import document_components
from lexicord.llm.quality import quality
from lexicord.llm.repair import structure_repair
from lexicord.llm.shared import table, written
from lexicord.llm.suffixdedup import repeated_strings
from lexicord.llm.tokencounts import token_counts
from lexicord.llm.tokenfiles import token_files
from lexicord.llm.toxicity import toxicity


# Spans of each kind from the matches and what stands between them; base_sha256 and spans as the operator renders them.
OP5_SQL = """
WITH rules(rank, kind, pat, least) AS (VALUES
    (0, 'assign', '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\\x20*[:=]\\x20*["'']?[A-Za-z0-9+/_.=-]+', 6),
    (1, 'access', 'AKIA[A-Z0-9]+', 20),
    (2, 'hex', '[0-9a-f]+', 24)),
cut AS (
    SELECT doc_id, rank, kind, least, regexp_extract_all(coalesce(text, ''), pat) AS m, string_split_regex(coalesce(text, ''), pat) AS p
    FROM documents, rules),
spans AS (
    SELECT doc_id, rank, kind, least, m[i] AS hit,
        list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS a
    FROM cut, unnest(generate_series(1, len(m))) AS t(i)),
kept AS (
    SELECT doc_id, rank, kind, CAST(a AS BIGINT) AS a, CAST(a + length(hit) AS BIGINT) AS b FROM spans
    WHERE CASE kind WHEN 'assign' THEN length(regexp_replace(hit, '^[A-Za-z_]+["'']?\\x20*[:=]\\x20*["'']?', '')) ELSE length(hit) END >= least),
told AS (
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) AS spans
    FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN told USING (doc_id)
"""


# Failures as flags of each document, grouped by pattern; each step of each order asks which filters came before.
OP12_SQL = """
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (
    SELECT part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
        100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
        coalesce(doc_id > first, false) AS e, coalesce(good, 0) AS good, coalesce(l.toxic, 0) AS toxic
    FROM w LEFT JOIN l USING (doc_id)),
p AS (
    SELECT part, concat(if(a, 'A', ''), if(b, 'B', ''), if(c, 'C', ''), if(d, 'D', ''), if(e, 'E', '')) AS fails, good, toxic, count(*) AS n
    FROM f GROUP BY ALL),
x(y) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.y || b.y || c.y || d.y || e.y AS filter_order FROM x a, x b, x c, x d, x e
    WHERE len(list_distinct([a.y, b.y, c.y, d.y, e.y])) = 5),
s AS (SELECT filter_order, CAST(i AS INT) AS step, filter_order[i] AS own, filter_order[1:i-1] AS prior FROM o, generate_series(1, 5) AS g(i)),
h AS (SELECT *, contains(fails, own) AS hit, length(translate(fails, prior, '')) < length(fails) AS gone FROM p, s),
r AS (
    SELECT part, filter_order, step, own,
        coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0) AS kept, coalesce(sum(n) FILTER (hit AND NOT gone), 0) AS removed,
        coalesce(sum(n) FILTER (hit AND gone), 0) AS redundant, coalesce(sum(n) FILTER (fails = own), 0) AS unique_fails,
        coalesce(sum(n) FILTER (hit AND NOT gone AND good = 1), 0) AS good_lost, coalesce(sum(n) FILTER (hit AND NOT gone AND toxic = 1), 0) AS toxic_lost
    FROM h GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
    good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r
"""


def tokenizer_path(name: str) -> str:
    """Place of an installed vocabulary file; pass another path to the operators to use another."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_components(table(spark, sf_dir, "documents"), k=3, percent=90)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=1)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeated_strings(table(spark, sf_dir, "documents"), length=50)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secrets.versions(table(spark, sf_dir, "documents"))
    later = F.pmod(F.xxhash64("path"), F.lit(2)) == 1
    first = written(secrets.scan_unseen(rows.where(~later), None))
    ledger = first.unionByName(written(secrets.scan_unseen(rows.where(later), first)))
    return secrets.findings(rows, ledger).select(F.col("path").alias("doc_id"), "n_assign", "n_access", "n_hex", F.sha2(F.encode("spans", "UTF-8"), 256).alias("base_sha256"), "spans")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), folds=3, held_out=1, threshold=0.7)


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), folds=5, held_out=0, threshold=0.3)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(table(spark, sf_dir, "documents"), exact_words=1)
    return kept.select("doc_id", "n_lines", "n_exact", "n_near", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), limit=2048)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure_repair(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_join": op1_ngram_join,
        "op2_token_files": op2_token_files,
        "op3_decontamination": op3_decontamination,
        "op4_suffix_dedup": op4_suffix_dedup,
        "op5_secrets": op5_secrets,
        "op6_toxicity": op6_toxicity,
        "op7_near_dedup": op7_near_dedup,
        "op8_bpe": op8_bpe,
        "op9_quality": op9_quality,
        "op10_line_dedup": op10_line_dedup,
        "op11_token_counts": op11_token_counts,
        "op12_filter_audit": op12_filter_audit,
        "op13_structure_repair": op13_structure_repair,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_secrets": OP5_SQL, "op12_filter_audit": OP12_SQL}
