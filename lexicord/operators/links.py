"""Links of web pages, and laws that they name but the registry lacks."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexicord.functions.text import bound

# One scan cuts a page into comments, raw elements and tags; what it leaves between them is text.
# Loops are possessive and bounded, so no page makes them backtrack or recurse far.
INSIDE = r"""(?:[^>"']++|"[^"]*+"|'[^']*+'){0,300}+"""
RAW = "script|style|textarea|title|xmp|iframe|noembed|noframes"
SKIPPED = rf"""(?is)<!--(?:.*?-->|.*+)|<(?:{RAW})(?=[\s/>]){INSIDE}>(?:.*?</(?:{RAW})\s*>|.*+)|<[!?][^>]*+>|(<[a-z/]{INSIDE}>)"""
ANCHOR = rf"(?is)<a(?=[\s/>])({INSIDE})>"
ANCHOR_END = r"(?is)</a(?=[\s/>])[^>]*+>"
TAG = rf"(?is)<[a-z/]{INSIDE}>"
ATTRIBUTE = r"""[^\s"'>/=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+))?"""
START, CONTENT, END = "\u0001", "\u0002", "\u0003"

#: Numbers 128 to 159 mean these characters; unassigned ones stay control characters.
CONTROLS = "".join(map(chr, range(128, 160)))
WINDOWS = "".join(bytes([k]).decode("cp1252", "ignore") or chr(k) for k in range(128, 160))

#: A name that may go without its semicolon; longer ones first.
OPEN_NAMES = "^&(" + "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))) + ")"
#: The standard table of names, with their semicolons; a map is searched from its begin, so frequent ones stand there.
OFTEN = ("amp;", "nbsp;", "lt;", "gt;", "quot;", "apos;", "laquo;", "raquo;", "ndash;", "mdash;", "hellip;")
NAMES = json.dumps({n: html5[n] for n in (*OFTEN, *html5)})


def one_spaced(c: Column) -> Column:
    return F.btrim(F.regexp_replace(c, r"(?U)\s+", " "))


def numbered_character(digits: Column, base: int) -> Column:
    """The character of a number; 0, surrogates and numbers beyond Unicode are U+FFFD."""
    short = F.regexp_replace(digits, "^0+(?=.)", "")
    n = F.when(F.length(short) <= 7, F.conv(short, base, 10).cast("long"))
    plain = F.decode(F.unhex(F.lpad(F.hex(F.when((n > 0) & (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF), n)), 8, "0")), "UTF-32")
    return F.coalesce(F.translate(plain, CONTROLS, WINDOWS), F.lit("\ufffd"))


def unescaped(c: Column, attribute: bool = False) -> Column:
    """Entities by number and by name, all in one pass, so that nothing is decoded twice.

    A name may lack its semicolon if the standard table lets it, but within an
    attribute not in front of `=`.
    """
    name = r"&[a-zA-Z][a-zA-Z0-9]*+" + (";|&[a-zA-Z][a-zA-Z0-9]*+(?!=)" if attribute else ";?+")
    parts = F.regexp_extract_all(c, F.lit(rf"(?s)(&\#[0-9]++;?+|&\#[xX][0-9a-fA-F]++;?+|{name}|[^&]++|&)"), F.lit(1))
    names = F.from_json(F.lit(NAMES), "map<string,string>")

    def begun(x: Column) -> Column:
        """A name that is none may begin with one that needs no semicolon."""
        known = F.regexp_extract(x, OPEN_NAMES, 1)
        return F.when(known != "", F.concat(F.try_element_at(names, known), F.substring(x, F.length(known) + 2, F.length(x)))).otherwise(x)

    def said(x: Column) -> Column:
        return (
            F.when(~x.startswith("&") | (x == "&"), x)
            .when(x.rlike("^&#[xX]"), numbered_character(F.regexp_replace(x, "^&#.|;$", ""), 16))
            .when(x.startswith("&#"), numbered_character(F.regexp_replace(x, "^&#|;$", ""), 10))
            .otherwise(F.coalesce(F.try_element_at(names, F.substring(x, F.lit(2), F.length(x))), x if attribute else begun(x)))
        )

    return F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(parts, said), "")).otherwise(c)


def joined_path(folders: Column, path: Column) -> Column:
    """A path below `folders`: `.` and `..` are resolved; empty segments between others go, but from a rooted path."""
    every = F.concat(folders, F.split(path, "/"))
    inner = F.filter(F.slice(every, F.lit(2), F.greatest(F.size(every) - 2, F.lit(0))), lambda x: x != "")
    below = F.when(F.size(every) > 1, F.concat(F.slice(every, 1, 1), inner, F.slice(every, -1, 1))).otherwise(every)
    segments = F.when(path.startswith("/"), F.split(path, "/")).otherwise(below)
    none = F.array().cast("array<string>")
    up = lambda done: F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
    step = lambda done, x: F.when(x == ".", done).when(x == "..", up(done)).otherwise(F.concat(done, F.array(x)))
    resolved = F.aggregate(segments, none, step)
    resolved = F.when(F.element_at(segments, -1).isin(".", ".."), F.concat(resolved, F.array(F.lit("")))).otherwise(resolved)
    text = F.array_join(resolved, "/")
    return F.when(text.startswith("/"), text).otherwise(F.concat(F.lit("/"), text))


def absolute(href: Column, base: Column) -> Column:
    """An address seen from the page it stands on, as browsers' and standard libraries' joins give it; without a base it stays."""
    scheme = r"^([a-zA-Z][a-zA-Z0-9+.-]*):"
    split = r"^(//[^/?#]*)?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"  # authority, path, query, fragment

    def parts(address: Column, *names: str) -> Column:
        return F.struct(*[F.regexp_extract(address, f"(?s){split}", k + 1).alias(n) for k, n in enumerate(names)])

    def joined(of: Column) -> Column:
        own, page = of["own"], of["page"]
        mark = lambda sign, c: F.when(c != "", F.concat(F.lit(sign), c)).otherwise("")
        folder = F.when(page["path"] == "", "/").otherwise(F.regexp_replace(page["path"], "[^/]*$", ""))
        near = F.when(own["path"].startswith("/"), own["path"]).otherwise(F.concat(folder, own["path"]))
        folders = F.split(page["path"], "/")
        folders = F.when(F.element_at(folders, -1) != "", F.slice(folders, F.lit(1), F.size(folders) - 1)).otherwise(folders)
        path = F.when(near.rlike(r"/\.{0,2}(/|$)"), joined_path(folders, own["path"])).otherwise(near)
        whole = (
            F.when(F.length(own["host"]) > 2, F.concat(own["host"], own["path"], mark("?", own["query"])))
            .when(own["path"] == "", F.concat(page["host"], page["path"], mark("?", F.when(own["query"] == "", page["query"]).otherwise(own["query"]))))
            .otherwise(F.concat(page["host"], path, mark("?", own["query"])))
        )
        return F.concat(F.lower(of["scheme"]), F.lit(":"), whole, mark("#", own["fragment"]))

    def taken_apart(of: Column) -> Column:
        # an address of the page's own scheme is one without
        rest = F.when(of["own"] != "", F.substring(of["href"], F.length(of["own"]) + 2, F.length(of["href"]))).otherwise(of["href"])
        page = F.substring(of["base"], F.length(of["scheme"]) + 2, F.length(of["base"]))
        both = F.struct(parts(F.regexp_replace(rest, "[\t\r\n]", ""), "host", "path", "query", "fragment").alias("own"), parts(page, "host", "path", "query", "fragment").alias("page"), of["scheme"].alias("scheme"))
        stays = (of["scheme"] == "") | ((of["own"] != "") & (F.lower(of["own"]) != F.lower(of["scheme"])))
        return F.when(stays, of["href"]).otherwise(bound(both, joined))

    return bound(F.struct(href.alias("href"), base.alias("base"), F.regexp_extract(href, scheme, 1).alias("own"), F.regexp_extract(base, scheme, 1).alias("scheme")), taken_apart)


def links(pages: DataFrame, page: str = "page_id", base: str = "url", html: str = "html") -> DataFrame:
    """(page, pos, text, url) of each address a page names first, in order of place; in-page and script links are left out.

    `pos` counts all anchors of the page.  A new anchor ends an open one, as it
    does in browsers; comments and raw elements hold no anchors; an anchor that
    nothing ends goes on to the end of the page.
    """
    clean = F.regexp_replace(F.translate(html, START + CONTENT + END, ""), SKIPPED, "$1")
    marked = F.regexp_replace(F.regexp_replace(clean, ANCHOR, f"{START}$1{CONTENT}"), ANCHOR_END, END)
    rows = pages.select(F.col(page), F.col(base).alias("base"), F.posexplode(F.split(marked, START)).alias("n", "piece")).where("n > 0")
    attributes = F.regexp_extract_all(F.substring_index("piece", CONTENT, 1), F.lit(ATTRIBUTE), F.lit(0))
    href = F.get(F.filter(attributes, lambda x: x.rlike(r"(?is)^href\s*(=|$)")), 0)
    value = F.regexp_replace(F.regexp_replace(href, r"(?is)^href\s*=?\s*", ""), r"""(?s)^"(.*)"$|^'(.*)'$""", "$1$2")
    content = F.substring_index(F.substring_index("piece", CONTENT, -1), END, 1)
    text = one_spaced(unescaped(F.regexp_replace(content, TAG, "")))
    address = F.regexp_replace(unescaped(value, attribute=True), r"(?U)^\s+|\s+$", "")
    rows = rows.select(page, (F.col("n") - 1).alias("pos"), text.alias("text"), address.alias("href"), "base").where(~F.col("href").rlike("^$|^#|^javascript:|^mailto:"))
    rows = rows.select(page, "pos", "text", absolute(F.col("href"), F.coalesce("base", F.lit(""))).alias("url"))
    return first_by(rows, [page, "url"], "pos")


def first_by(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key, by aggregation, so that a key of any number of rows combines before the shuffle."""
    others = [c for c in rows.columns if c not in keys]
    told = rows.groupBy(*keys).agg(F.min_by(F.struct(*others), order).alias("r"))
    return told.select(*[F.col(c) if c in keys else F.col(f"r.{c}").alias(c) for c in rows.columns])


def with_keywords(rows: DataFrame, words: str) -> DataFrame:
    """Rows whose address or text holds any of the comma-separated words, case-blind; no words keep all."""
    terms = [w.strip().lower() for w in words.split(",") if w.strip()]
    if not terms:
        return rows
    return rows.where(F.exists(F.array(*map(F.lit, terms)), lambda t: F.contains(F.lower("url"), t) | F.contains(F.lower("text"), t)))


def not_repealed(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("text").rlike("[Κκ]αταργη"))


def unknown_laws(rows: DataFrame, laws: DataFrame, keys: list[str]) -> DataFrame:
    """Links that name no law of the registry by number/year; links that name none at all stay."""
    pair = r"(?U)(\d{1,6})\s*/\s*((?:19|20)\d{2})"
    named = rows.select(*keys, F.explode(F.regexp_extract_all("text", F.lit(pair), F.lit(0))).alias("m"))
    named = named.select(*keys, F.regexp_extract("m", pair, 1).alias("arithmos"), F.regexp_extract("m", pair, 2).alias("etos"))
    known = named.join(laws.select(F.btrim(F.col("arithmos")).alias("arithmos"), F.col("etos").cast("string").alias("etos")), ["arithmos", "etos"], "left_semi")
    return rows.join(known.select(*keys).distinct(), keys, "left_anti")


def paged_urls(start: DataFrame, url: str, pages: int) -> DataFrame:
    """The address itself as page 1, then without its slashes at the end and with /?page=2 and so on; one page at least."""
    rows = start.withColumn("page", F.explode(F.sequence(F.lit(1), F.lit(max(pages, 1)))))
    return rows.withColumn(url, F.when(F.col("page") == 1, F.col(url)).otherwise(F.concat(F.regexp_replace(url, "/+$", ""), F.lit("/?page="), F.col("page").cast("string"))))


def until_failure(tries: DataFrame, key: str, page: str, failed: Column) -> DataFrame:
    """Pages of each address before its first failing one; an address whose first page fails has none."""
    first = tries.groupBy(key).agg(F.min(F.when(failed, F.col(page))).alias("_first"))
    return tries.join(first, key).where(F.col("_first").isNull() | (F.col(page) < F.col("_first"))).drop("_first")


def top(rows: DataFrame, n: int, *order: str) -> tuple[DataFrame, DataFrame]:
    """The first n rows, and one row with how many more there are."""
    return rows.orderBy(*order).limit(n), rows.agg(F.greatest(F.count("*") - n, F.lit(0)).alias("more"))
