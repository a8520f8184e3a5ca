"""Checks and selections on the registry of laws."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicord.functions import rules


def relations(laws: DataFrame) -> DataFrame:
    """(src, rel, dst) of all relations between laws."""
    rows = [laws.select(F.col("id").alias("src"), F.lit(r).alias("rel"), F.explode(F.col(f"scheseis.{r}")).alias("dst")) for r in rules.RELATIONS]
    return reduce(DataFrame.unionByName, rows)


def dangling(edges: DataFrame, laws: DataFrame) -> DataFrame:
    """Relations to laws that do not exist."""
    return edges.join(laws.select(F.col("id").alias("dst")), "dst", "left_anti").select("src", "rel", "dst")


def duplicates(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("times")).where("times > 1")


def violations(laws: DataFrame) -> DataFrame:
    """(rule, id, detail) of every broken rule; a sound registry has none."""
    eu = F.col("typos").isin(*rules.EU_ACTS)
    checks = {
        "series": (F.col("fek").isNotNull() & ~F.col("fek.teuxos").isin(*rules.SERIES_CODES), F.col("fek.teuxos")),
        "eu_act_needs_celex": (eu & F.col("celex").isNull(), F.col("typos")),
        "act_needs_gazette": (~eu & F.col("fek").isNull(), F.col("typos")),
        "needs_source": (F.coalesce(F.size("piges"), F.lit(0)) <= 0, F.lit("")),
        "priority": (~F.col("proteraiotita").between(1, 3), F.col("proteraiotita").cast("string")),
        "type": (~F.col("typos").isin(*rules.ACT_SHORT), F.col("typos")),
        "status": (~F.col("katastasi").isin(*rules.STATUSES), F.col("katastasi")),
        "source_type": (F.exists("piges", lambda s: ~s["typos"].isin(*rules.SOURCE_TYPES)), F.lit("")),
    }
    found = [laws.where(bad).select(F.lit(rule).alias("rule"), "id", detail.alias("detail")) for rule, (bad, detail) in checks.items()]
    found.append(duplicates(laws, "id").select(F.lit("unique_id").alias("rule"), "id", F.col("times").cast("string").alias("detail")))
    found.append(dangling(relations(laws), laws).select(F.lit("relation_target").alias("rule"), F.col("src").alias("id"), F.concat("rel", F.lit(" → "), "dst").alias("detail")))
    return reduce(DataFrame.unionByName, found)


def by_priority(laws: DataFrame, most: int | None = None) -> DataFrame:
    """Laws by priority, then id; with `most`, only up to that priority."""
    return (laws if most is None else laws.where(F.col("proteraiotita") <= most)).orderBy("proteraiotita", "id")


def selected(laws: DataFrame, id: str | None = None, theme: str | None = None) -> DataFrame:
    """One law, the laws of a theme, or all; an unknown id or theme is an error."""
    for column, value in (("id", id), ("thematiki", theme)):
        if value is not None:
            laws = laws.where(F.col(column) == value)
            if laws.isEmpty():
                raise KeyError(f"no law with {column} = {value}")
    return laws


def themes(laws: DataFrame) -> DataFrame:
    return laws.groupBy("thematiki").agg(F.count("*").alias("laws")).orderBy("thematiki")


def report(laws: DataFrame) -> DataFrame:
    """(laws, unverified, not_in_force, themes) in one row."""
    return laws.agg(F.count("*").alias("laws"), F.count_if(~F.col("epalithevmeno")).alias("unverified"), F.count_if(F.col("katastasi") != rules.IN_FORCE).alias("not_in_force"), F.count_distinct("thematiki").alias("themes"))
