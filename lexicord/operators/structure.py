"""Structure of laws: Parts, Chapters, articles, paragraphs.

A sentinel goes in front of each heading, the text is split there, and each
piece becomes a row; bodies end at the next heading of any kind by construction.
The only shuffle deals rows by law, for carrying Part and Chapter forward.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexicord.functions import rules
from lexicord.functions.names import article_order
from lexicord.functions.text import bound, one_line, strip
from lexicord.operators import scan

MARK, FIELD = "\u0001", "\u0002"
#: How a text's own marks are written while it is cut at marks; no pattern takes them for anything else.
OWN_MARKS = {"\u0003": "\u0003c", MARK: "\u0003a", FIELD: "\u0003b"}


def guarded(text: Column) -> Column:
    """The text with its own marks written out, so that they cut nothing."""
    written = reduce(lambda t, x: F.replace(t, F.lit(x[0]), F.lit(x[1])), OWN_MARKS.items(), text)
    own = reduce(lambda a, b: a | b, [F.contains(text, F.lit(x)) for x in OWN_MARKS])
    return F.when(own, written).otherwise(text)


def restored(text: Column) -> Column:
    """A piece of a guarded text as it was."""
    plain = reduce(lambda t, x: F.replace(t, F.lit(x[1]), F.lit(x[0])), reversed(OWN_MARKS.items()), text)
    return F.when(F.contains(text, F.lit("\u0003")), plain).otherwise(text)


def section_title(body: Column) -> Column:
    """Up to six lines below a Part or Chapter heading, joined."""
    return one_line(F.array_join(F.slice(F.split(body, "\n"), 1, rules.TITLE_LINES + 1), "\n"))


def title_lines(lines: Column) -> Column:
    """How many of an article's first lines are its title.

    The first line, and then lines that start in lower case or follow a line
    that ends in a dash or comma; none if a paragraph starts there, or if the
    title would be longer than the limit.
    """
    first = lines[0]
    start = F.struct(F.lit(1).alias("n"), F.lit(False).alias("done"), strip(first).alias("last"))

    def step(acc: Column, line: Column) -> Column:
        bare = strip(line)
        goes_on = ~acc["done"] & (bare != "") & ~line.rlike(rules.PARAGRAPH) & (bare.rlike(r"(?U)^\p{Lower}") | acc["last"].rlike(rules.TITLE_GOES_ON))
        return F.struct((acc["n"] + goes_on.cast("int")).alias("n"), (~goes_on).alias("done"), F.when(goes_on, bare).otherwise(acc["last"]).alias("last"))

    n = F.aggregate(F.slice(lines, 2, rules.TITLE_LINES), start, step, lambda acc: acc["n"])
    return F.when((strip(first) == "") | first.rlike(rules.PARAGRAPH) | (n > rules.TITLE_LINES), 0).otherwise(n)


def paragraphs(body: Column) -> Column:
    """Array of (arithmos, keimeno): what stands before the first number keeps an empty number; empty ones go."""
    pieces = F.split(F.regexp_replace(bound(strip(body), guarded), rules.PARAGRAPH, f"{MARK}$1{FIELD}"), MARK)

    def made(piece: Column) -> Column:
        numbered = F.contains(piece, F.lit(FIELD))
        return F.struct(F.when(numbered, F.substring_index(piece, FIELD, 1)).otherwise("").alias("arithmos"), one_line(bound(F.when(numbered, F.substring_index(piece, FIELD, -1)).otherwise(piece), restored)).alias("keimeno"))

    return F.filter(F.transform(pieces, made), lambda p: p["keimeno"] != "")


def headings(laws: DataFrame, law: str = "law", text: str = "text") -> DataFrame:
    """(law, pos, part, chapter, article, letter, body) of every heading, in order of place."""
    marked = F.regexp_replace(bound(F.col(text), guarded), rules.HEADING, f"{MARK}$1{FIELD}$2{FIELD}$3{FIELD}$4{FIELD}")
    fields = F.split("piece", FIELD, 5)
    rows = laws.select(F.col(law).alias("law"), F.posexplode(F.split(marked, MARK)).alias("pos", "piece")).where("pos > 0")
    return rows.select("law", "pos", *[F.nullif(fields[k], F.lit("")).alias(n) for k, n in enumerate(("part", "chapter", "article", "letter"))], bound(fields[4], restored).alias("body"))


def articles(laws: DataFrame, law: str = "law", text: str = "text", segment: int | None = None) -> DataFrame:
    """(law, pos, arthro, titlos, meros, meros_titlos, kefalaio, kefalaio_titlos, paragrafoi) of every article.

    A new Part ends the Chapter.  A law without article headings gives no row.  A
    law's headings are carried forward in one task, or, if `segment` is given, in
    pieces of that many headings over as many tasks as they need.
    """
    section = F.when(F.col("part").isNotNull() | F.col("chapter").isNotNull(), section_title(F.col("body")))
    bare = F.regexp_replace(F.coalesce("part", "chapter"), "[΄']+$", "")
    rows = headings(laws, law, text).withColumn("section", F.struct(bare.alias("n"), section.alias("t")))
    part = F.when(F.col("part").isNotNull(), F.col("section"))
    # a Part is a Chapter of no name
    chapter = F.when(F.col("chapter").isNotNull(), F.col("section")).when(F.col("part").isNotNull(), F.struct(F.lit(None).cast("string").alias("n"), F.lit(None).cast("string").alias("t")))
    if segment:
        from lexicord.sources.tables import checkpointed

        rows = checkpointed(rows.withColumn("segment", F.floor(F.col("pos") / segment)))
        rows = scan.carried(rows, "law", "pos", {"m": part, "k": chapter}).drop("segment")
    else:
        before = Window.partitionBy("law").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.withColumns({"m": F.last(part, True).over(before), "k": F.last(chapter, True).over(before)})
    rows = rows.where("article is not null")
    lines = F.split(strip(F.col("body")), "\n")
    rows = rows.withColumn("lines", lines).withColumn("counted", title_lines(F.col("lines")))
    rest = F.array_join(F.expr("slice(lines, counted + 1, size(lines))"), "\n")
    rows = rows.withColumn("n", F.when(strip(rest) == "", 0).otherwise(F.col("counted")))
    body = F.when(F.col("n") > 0, F.array_join(F.expr("slice(lines, n + 1, size(lines))"), "\n")).otherwise(F.col("body"))
    title = strip(F.array_join(F.transform(F.expr("slice(lines, 1, n)"), strip), " "))
    return rows.select(
        "law",
        "pos",
        F.concat("article", F.upper(F.coalesce("letter", F.lit("")))).alias("arthro"),
        title.alias("titlos"),
        F.col("m.n").alias("meros"),
        F.col("m.t").alias("meros_titlos"),
        F.col("k.n").alias("kefalaio"),
        F.col("k.t").alias("kefalaio_titlos"),
        paragraphs(body).alias("paragrafoi"),
    )


def first_articles(rows: DataFrame) -> DataFrame:
    """The first article of each number in each law, by aggregation, which combines before the shuffle."""
    others = [c for c in rows.columns if c not in ("law", "arthro")]
    told = rows.groupBy("law", "arthro").agg(F.min_by(F.struct(*others), "pos").alias("r"))
    return told.select(*[c if c in ("law", "arthro") else F.col(f"r.{c}").alias(c) for c in rows.columns])


def repeated_articles(rows: DataFrame) -> DataFrame:
    """(law, repeated): numbers that occur again, once each, in order of their first repeat."""
    order = Window.partitionBy("law", "arthro").orderBy("pos")
    second = rows.withColumn("nth", F.row_number().over(order)).where("nth = 2")
    return second.groupBy("law").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "arthro"))), lambda x: x["arthro"]).alias("repeated"))


def relevant_articles(rows: DataFrame, wanted: Column) -> DataFrame:
    """Articles whose number, without trailing letters, is in the law's list; an empty or missing list keeps all."""
    bare = F.regexp_replace("arthro", "[ΑΒΓΔΕ]+$", "")
    return rows.where(F.coalesce(F.size(wanted), F.lit(0)).isin(0, -1) | F.array_contains(F.transform(wanted, lambda x: x.cast("string")), bare))


def missing_articles(main: DataFrame, extra: DataFrame) -> DataFrame:
    """Articles of supplements (extra has `file`, its rank) whose numbers the law lacks, for laws that have articles at all.

    A number belongs to the first file that has it; what that file has of it
    stays, repeats included.  Files are folded by one minimum for each number.
    """
    owner = extra.groupBy("law", "arthro").agg(F.min("file").alias("file"))
    owner = owner.join(main.select("law").distinct(), "law", "left_semi").join(main.select("law", "arthro").distinct(), ["law", "arthro"], "left_anti")
    return extra.join(owner, ["law", "arthro", "file"], "left_semi")


def with_supplements(main: DataFrame, extra: DataFrame) -> DataFrame:
    """Main articles and what supplements add, with `pos` counted anew and `file` (null for main ones).

    A law with additions is ordered by number and text of its articles' numbers,
    equal ones by file and place; others keep their order.
    """
    added = missing_articles(main, extra)
    both = main.withColumn("file", F.lit(None).cast(extra.schema["file"].dataType)).unionByName(added.select(*main.columns, "file"))
    law = Window.partitionBy("law")
    number, text = article_order(F.col("arthro"))
    rows = both.withColumn("sorted", F.max(F.col("file").isNotNull()).over(law))
    order = law.orderBy(F.when(F.col("sorted"), number), F.when(F.col("sorted"), text), F.col("file").asc_nulls_first(), "pos")
    return rows.withColumn("pos", (F.row_number().over(order) - 1).cast(main.schema["pos"].dataType)).drop("sorted")
