"""Columns of printed pages: where the gutter between two columns is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicord.functions import rules


def gutters(words: DataFrame, page: str = "page") -> DataFrame:
    """(page, gutter): the position that fewest words cross, null for pages of one column.

    Each word counts for each of 31 positions in one aggregation; a page's words
    need not come together.  Of equal positions the middle one is taken.  Pages
    with few words, or where too many cross, have no gutter.
    """
    low, high = rules.GUTTER_PERCENTS
    counts = [F.sum(((F.col("x0") < F.col("width") * p / 100) & (F.col("width") * p / 100 < F.col("x1"))).cast("long")).alias(f"c{p}") for p in range(low, high + 1)]
    told = words.groupBy(page).agg(F.count("*").alias("n"), F.max("width").alias("width"), *counts)
    crossed = F.array(*[F.struct(F.col(f"c{p}").alias("c"), F.lit(p).alias("p")) for p in range(low, high + 1)])
    least = F.array_min(F.transform(crossed, lambda x: x["c"]))
    ties = F.transform(F.filter(crossed, lambda x: x["c"] == least), lambda x: x["p"])
    middle = F.element_at(ties, (F.floor(F.size(ties) / 2) + 1).cast("int"))
    clear = (F.col("n") >= rules.LEAST_WORDS) & (least / F.col("n") < rules.CROSSING_SHARE)
    return told.select(page, F.when(clear, F.col("width") * middle / 100).alias("gutter"))


def has_text_layer(pages: DataFrame, doc: str = "doc", page: str = "page", text: str = "text") -> DataFrame:
    """(doc, has_text): whether any of the first three pages has text."""
    return pages.groupBy(doc).agg(F.coalesce(F.max(F.when(F.col(page) <= 3, F.length(F.btrim(F.coalesce(F.col(text), F.lit("")))) > 0)), F.lit(False)).alias("has_text"))
