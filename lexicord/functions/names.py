"""Names, identifiers and dates of laws, as column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexicord.functions import rules
from lexicord.functions.text import pronounce


def looked_up(table: dict[str, str], key: Column) -> Column:
    """The entry of a small fixed table, or null."""
    return F.try_element_at(F.create_map(*[F.lit(x) for x in chain(*table.items())]), key)


def pdf_id(year: Column, series: Column, number: Column) -> Column:
    """Year, series code and the number padded to five digits or more."""
    digits = number.cast("string")
    padded = F.when(F.length(digits) < 5, F.lpad(digits, 5, "0")).otherwise(digits)
    return F.concat(year.cast("string"), looked_up(rules.SERIES_CODES, series), padded)


def citation(series: Column, number: Column, day: Column) -> Column:
    return F.concat(looked_up(rules.SERIES_GREEK, series), F.lit("΄"), number.cast("string"), F.lit("/"), F.date_format(day, "dd-MM-yyyy"))


def display_name(kind: Column, number: Column, year: Column) -> Column:
    short = F.concat(looked_up(rules.ACT_SHORT, kind), F.lit(" "), number)
    return F.when(kind.isin(*rules.EU_ACTS), short).otherwise(F.concat(short, F.lit("/"), year.cast("string")))


def spoken_name(kind: Column, number: Column, year: Column) -> Column:
    short = F.concat(looked_up(rules.ACT_SPOKEN, kind), F.lit(" "), pronounce(number))
    return F.when(kind.isin(*rules.EU_ACTS), short).otherwise(F.concat(short, F.lit(" του "), year.cast("string")))


def spoken_date(day: Column) -> Column:
    month = F.element_at(F.array(*[F.lit(m) for m in rules.MONTHS]), F.month(day))
    return F.concat_ws(" ", F.dayofmonth(day).cast("string"), month, F.year(day).cast("string"))


def spoken_series(series: Column) -> Column:
    return F.coalesce(looked_up(rules.SERIES_SPOKEN, F.trim(series)), series)


def identity(kind: Column, number: Column, year: Column, series: Column, issue: Column, issued: Column, in_force: Column) -> Column:
    """Name, gazette and date of force in one sentence; missing parts are left out."""
    gazette = F.concat(F.lit("ΦΕΚ τεύχος "), spoken_series(series), F.lit(", αριθμός "), issue.cast("string"), F.lit(", "), spoken_date(issued))
    force = F.when(in_force.isNotNull(), F.concat(F.lit("Ισχύει από "), spoken_date(in_force)))
    return F.concat(F.concat_ws(". ", spoken_name(kind, number, year), gazette, force), F.lit("."))


def label(short: Column, name: Column) -> Column:
    """The short title, or the name where that is missing or empty."""
    return F.coalesce(F.nullif(short, F.lit("")), name)


def record_id(law: Column, article: Column, paragraph: Column) -> Column:
    return F.concat(law, F.lit(":art-"), article, F.when(paragraph != "", F.concat(F.lit(":par-"), paragraph)).otherwise(""))


def article_order(article: Column) -> list[Column]:
    """Sort keys: the number of up to 38 digits, 0 without any, then the text, so 17 < 17Α < 18."""
    digits = F.nullif(F.regexp_replace(article, "[^0-9]", ""), F.lit(""))
    return [F.coalesce(digits.try_cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")), article]


def section_name(number: Column, title: Column) -> Column:
    return F.when(F.coalesce(title, F.lit("")) != "", F.concat(number, F.lit("΄ "), title)).otherwise(number)
