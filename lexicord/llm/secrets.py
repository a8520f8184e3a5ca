"""Secret scans over an incremental blob ledger, in DataFrame operations alone.

Every version of a text is a blob, named by the SHA-256 of its bytes.  A ledger
holds, for each blob and version of the rules that was scanned, the spans found.
A scan reads the blobs of the versions at hand, leaves out the pairs of blob and
rule version that the ledger has, scans one text of each remaining blob, adds
the result to the ledger, and joins findings back to every path that holds the
blob.  Text that comes again, under any path or in any later run, is never
scanned again.

Places of matches: the text split at a pattern gives what stands between its
matches, so running lengths of parts and matches give where each begins, in code
points.

Edge cases: null counts as empty text and has no finding; repeated rows each get
the findings; a blob without findings stands in the ledger with none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds in order, their patterns, and the least number of
# characters of a match (of group 2 for `assign`).
RULES = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
RULE_VERSION = "base-1"

#: Runs of hex digits shorter than this never count, so the pattern that cuts texts leaves them out.
CUTS = {"hex": "[0-9a-f]{24,}+", "access": "AKIA[A-Z0-9]{16,}+"}


def found(text: Column, kind: str) -> Column:
    """Spans (start, rank, kind, end) of one kind in order of place."""
    pattern, group, least = RULES[kind]
    cut = CUTS.get(kind, pattern)
    rank = list(RULES).index(kind)
    matches = F.regexp_extract_all(text, F.lit(cut), F.lit(0))
    between = F.split(text, cut, -1)
    steps = F.zip_with(matches, F.slice(between, F.lit(1), F.size(matches)), lambda m, p: F.struct(m.alias("m"), p.alias("p")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["p"])
        end = begin + F.length(x["m"])
        value = F.regexp_extract(x["m"], pattern, group) if group else x["m"]
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(F.length(value) >= least, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return F.when(text.rlike(cut), F.aggregate(steps, start, step, lambda acc: acc["spans"])).otherwise(start["spans"])


def rendered(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def versions(docs: DataFrame, path_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(path, blob, text) of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(path_col).alias("path"), F.sha2(F.encode(text, "UTF-8"), 256).alias("blob"), text.alias("text"))


def scan_unseen(rows: DataFrame, ledger: DataFrame | None, rule_version: str = RULE_VERSION) -> DataFrame:
    """New ledger rows (blob, rule_version, n_assign, n_access, n_hex, spans): one for each blob the ledger lacks.

    The text that is scanned is that of the least path of a blob, so only ids
    and hashes are grouped, and a blob of any number of copies is one row.
    """
    one = rows.groupBy("blob").agg(F.min("path").alias("path"))
    if ledger is not None:
        one = one.join(ledger.where(F.col("rule_version") == rule_version).select("blob"), "blob", "left_anti")
    wanted = one.select(F.col("path").alias("least"), F.col("blob").alias("wanted"))
    text = rows.join(wanted, F.col("path").eqNullSafe(F.col("least")) & (F.col("blob") == F.col("wanted")))
    spans = text.select("blob", F.array_sort(F.concat(*[found(F.col("text"), kind) for kind in RULES])).alias("spans"))

    def times(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [times(kind) for kind in RULES]
    return spans.select("blob", F.lit(rule_version).alias("rule_version"), *counts, rendered(F.col("spans")).alias("spans")).distinct()


def findings(rows: DataFrame, ledger: DataFrame, rule_version: str = RULE_VERSION) -> DataFrame:
    """(path, n_assign, n_access, n_hex, spans) of every row, from the ledger."""
    some = ledger.where((F.col("rule_version") == rule_version) & (F.col("spans") != "")).drop("rule_version")
    joined = rows.select("path", "blob").join(some, "blob", "left")
    return joined.select("path", *[F.coalesce(f"n_{kind}", F.lit(0)).alias(f"n_{kind}") for kind in RULES], F.coalesce("spans", F.lit("")).alias("spans"))
