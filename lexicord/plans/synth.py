"""Greek legal texts derived from the given tables, for queries on tables that hold none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters of synthetic Parts and Chapters.
NUMERALS = "ΑΒΓΔΕΖΗΘ"


def letter(k: Column, every: int) -> Column:
    return F.substr(F.lit(NUMERALS), F.floor(k / every).cast("int") % 8 + 1, F.lit(1))


def law_text(text: Column) -> Column:
    """Each line is an article with a title and one numbered paragraph; every fifth opens a Part, every third a Chapter."""

    def article(line: Column, i: Column) -> Column:
        k = i + 1
        part = F.when(k % 5 == 0, F.concat(F.lit("ΜΕΡΟΣ "), letter(k, 5), F.lit("΄\nΤίτλος μέρους\n"))).otherwise("")
        chapter = F.when(k % 3 == 0, F.concat(F.lit("ΚΕΦΑΛΑΙΟ "), letter(k, 3), F.lit("΄\nΤίτλος κεφαλαίου\n"))).otherwise("")
        return F.concat(part, chapter, F.lit("Άρθρο "), k.cast("string"), F.lit("\nΤίτλος άρθρου\n1. "), line)

    return F.array_join(F.transform(F.split(text, "\n"), article), "\n")


def laws(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").alias("law"), law_text(F.col("text")).alias("text"))


def lines(docs: DataFrame) -> DataFrame:
    """(law, pos, line) with places from 1."""
    rows = docs.select(F.col("doc_id").alias("law"), F.posexplode(F.split("text", "\n")).alias("p", "line"))
    return rows.select("law", (F.col("p") + 1).alias("pos"), "line")
