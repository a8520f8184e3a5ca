"""Paragraph records: the flat, fully attributed rows of the corpus, and documents put together from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexicord.functions import names, rules
from lexicord.functions.text import bound, pronounce, strip


def flatten(articles: DataFrame) -> DataFrame:
    """One row for each paragraph, with its place `seq` in the law."""
    # the plain generator's filter of empty arrays would be pushed below and parse each law again
    rows = articles.select("*", F.posexplode_outer("paragrafoi").alias("par", "p")).where("p is not null").drop("paragrafoi")
    return rows.select("*", F.col("p.arithmos").alias("paragrafos"), F.col("p.keimeno").alias("keimeno"), F.struct("pos", "par").alias("seq")).drop("p", "par")


def numbered_ids(rows: DataFrame, base: Column, order: str = "seq") -> DataFrame:
    """`id`: the base id, with -2, -3, ... from its second row in the law on."""
    nth = F.row_number().over(Window.partitionBy("law", "base_id").orderBy(order))
    return rows.withColumn("base_id", base).withColumn("nth", nth).withColumn("id", F.when(F.col("nth") > 1, F.concat("base_id", F.lit("-"), F.col("nth").cast("string"))).otherwise(F.col("base_id"))).drop("base_id", "nth")


def verified_laws(laws: DataFrame, found: DataFrame | None) -> DataFrame:
    """Laws whose `epalithevmeno` is what (id, epalithevmeno) of this run's texts says, where it says anything."""
    if found is None:
        return laws
    told = found.select(F.col("id").alias("_id"), F.col("epalithevmeno").alias("_told"))
    rows = laws.join(told, F.col("id") == F.col("_id"), "left").withColumn("epalithevmeno", F.coalesce("_told", "epalithevmeno"))
    return rows.select(*laws.columns)


def article_text(paragraphs: Column) -> Column:
    """Paragraphs with their numbers, a blank line between them."""
    return F.array_join(F.transform(paragraphs, lambda p: F.when(p["arithmos"] != "", F.concat(p["arithmos"], F.lit(". "), p["keimeno"])).otherwise(p["keimeno"])), "\n\n")


def law_meta(laws: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """The 16 columns of a law's facts; laws carry pigi_url, checksum_pigis, plithos_arthron, plithos_paragrafon and anaktithike."""
    fek = F.col("fek")
    return verified_laws(laws, found).select(
        "id",
        names.display_name(F.col("typos"), F.col("arithmos"), F.col("etos")).alias("onoma"),
        "titlos",
        "typos",
        "thematiki",
        F.when(fek.isNotNull(), names.citation(fek["teuxos"], fek["arithmos"], fek["imerominia"])).alias("fek"),
        F.when(fek.isNotNull(), names.pdf_id(F.year(fek["imerominia"]), fek["teuxos"], fek["arithmos"])).alias("fek_pdf_id"),
        "celex",
        "katastasi",
        F.col("isxys_apo").cast("string").alias("isxys_apo"),
        "epalithevmeno",
        "pigi_url",
        "checksum_pigis",
        F.col("plithos_arthron").cast("long").alias("plithos_arthron"),
        F.col("plithos_paragrafon").cast("long").alias("plithos_paragrafon"),
        F.col("anaktithike").cast("string").alias("anaktithike"),
    )


def full_markdown(articles: DataFrame, laws: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """(law, document): the whole text of a law: its header, a rule, and its articles."""
    joined = law_header(verified_laws(laws, found)).join(markdown(articles), "law", "left")
    return joined.select("law", F.concat(F.regexp_replace(F.concat_ws("\n", "header", "document"), r"(?U)\s+$", ""), F.lit("\n")).alias("document"))


def export_totals(exported: DataFrame) -> DataFrame:
    """(law, articles, size): a row for each exported law, its characters in rounded thousands, and one of all with law null."""
    each = exported.select("law", F.col("articles").cast("long").alias("articles"), F.concat(F.bround(F.col("characters") / 1000.0, 0).cast("long").cast("string"), F.lit("k")).alias("size"))
    every = exported.agg(F.lit(None).cast(exported.schema["law"].dataType).alias("law"), F.coalesce(F.sum("articles"), F.lit(0)).cast("long").alias("articles"), F.concat(F.count("*").cast("string"), F.lit(" files")).alias("size"))
    return each.unionByName(every)


def paragraph_records(articles: DataFrame, laws: DataFrame, found: DataFrame | None = None, placed: bool = False) -> DataFrame:
    """The 20 columns of a record, and its place `seq` if asked; law metadata joins each paragraph, with the verification that `found` has of it."""
    laws = verified_laws(laws, found)
    rows = numbered_ids(flatten(articles), names.record_id(F.col("law"), F.col("arthro"), F.col("paragrafos")))
    meta = laws.select(
        F.col("id").alias("law"),
        names.display_name(F.col("typos"), F.col("arithmos"), F.col("etos")).alias("nomothetima"),
        F.col("titlos").alias("titlos_nomothetimatos"),
        "thematiki",
        names.citation(F.col("fek.teuxos"), F.col("fek.arithmos"), F.col("fek.imerominia")).alias("fek"),
        "celex",
        F.col("isxys_apo").cast("string").alias("isxys_apo"),
        "katastasi",
        "epalithevmeno",
        "pigi_url",
        F.col("anaktithike").cast("string").alias("anaktithike"),
    )
    columns = ["id", F.col("law").alias("nomothetima_id"), "nomothetima", "titlos_nomothetimatos", "thematiki", "arthro", F.col("titlos").alias("titlos_arthrou"), "paragrafos", "meros", "meros_titlos", "kefalaio", "kefalaio_titlos", "keimeno", "fek", "celex", "isxys_apo", "katastasi", "epalithevmeno", "pigi_url", "anaktithike"]
    return rows.join(meta, "law").select(*columns, *(["seq"] if placed else []))


def adjacent_groups(rows: DataFrame, by: str, key: str, order: str) -> DataFrame:
    """`run`: number of the run of equal keys next to each other, per `by`."""
    w = Window.partitionBy(by).orderBy(order)
    starts = ~F.col(key).eqNullSafe(F.lag(key).over(w)) | F.lag(F.lit(1)).over(w).isNull()
    return rows.withColumn("run", F.sum(starts.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def changed(rows: DataFrame, by: str, order: str, key: Column, flag: str) -> DataFrame:
    """`flag`: this row's key differs by value from that of the row before; the first row counts as changed."""
    w = Window.partitionBy(by).orderBy(order)
    return rows.withColumn("_key", F.struct(key)).withColumn(flag, ~F.col("_key").eqNullSafe(F.lag("_key").over(w))).drop("_key")


def assembled(rows: DataFrame, by: str, order: Column, line: Column) -> DataFrame:
    """(by, document): lines in order, joined by newlines; one document's lines come together."""
    parts = F.array_sort(F.collect_list(F.struct(order.alias("o"), line.alias("line"))))
    return rows.groupBy(by).agg(F.array_join(F.transform(parts, lambda x: x["line"]), "\n").alias("document"))


def markdown(articles: DataFrame) -> DataFrame:
    """(law, document): headings on change of Part and Chapter, articles, paragraphs."""
    w = Window.partitionBy("law").orderBy("pos")
    part, chapter = F.struct("meros", "meros_titlos"), F.struct("kefalaio", "kefalaio_titlos")
    rows = articles.withColumn("p", part).withColumn("k", chapter)
    new_part = ~F.col("p").eqNullSafe(F.lag("p").over(w)) & F.col("meros").isNotNull()
    new_chapter = ~F.col("k").eqNullSafe(F.lag("k").over(w)) & F.col("kefalaio").isNotNull()
    lines = F.concat(
        F.when(new_part, F.array(F.concat(F.lit("## ΜΕΡΟΣ "), names.section_name(F.col("meros"), F.col("meros_titlos"))), F.lit(""))).otherwise(F.array().cast("array<string>")),
        F.when(new_chapter, F.array(F.concat(F.lit("### ΚΕΦΑΛΑΙΟ "), names.section_name(F.col("kefalaio"), F.col("kefalaio_titlos"))), F.lit(""))).otherwise(F.array().cast("array<string>")),
        F.array(F.concat(F.lit("#### Άρθρο "), "arthro", F.when(F.col("titlos") != "", F.concat(F.lit(" — "), "titlos")).otherwise("")), F.lit("")),
        F.flatten(F.transform("paragrafoi", lambda p: F.array(F.when(p["arithmos"] != "", F.concat(p["arithmos"], F.lit(". "), p["keimeno"])).otherwise(p["keimeno"]), F.lit("")))),
    )
    return assembled(rows.withColumn("lines", F.array_join(lines, "\n")), "law", F.col("pos"), F.col("lines"))


def law_header(laws: DataFrame) -> DataFrame:
    """(law, header): the table of facts, the description and the warnings above a law's text."""
    none = F.array().cast("array<string>")

    def fact(name: str, value: Column, when: Column | None = None) -> Column:
        line = F.array(F.concat(F.lit(f"| {name} | "), value, F.lit(" |")))
        return line if when is None else F.when(when, line).otherwise(none)

    day = F.date_format("isxys_apo", "dd-MM-yyyy")
    lines = F.concat(
        F.array(F.concat(F.lit("# "), names.display_name(F.col("typos"), F.col("arithmos"), F.col("etos")), F.lit(" — "), "titlos"), F.lit(""), F.lit("| Πεδίο | Τιμή |"), F.lit("| --- | --- |")),
        fact("Αναγνωριστικό", F.concat(F.lit("`"), "id", F.lit("`"))),
        fact("Τύπος", F.col("typos")),
        fact("ΦΕΚ", names.citation(F.col("fek.teuxos"), F.col("fek.arithmos"), F.col("fek.imerominia")), F.col("fek").isNotNull()),
        fact("CELEX", F.col("celex"), F.col("celex").isNotNull()),
        fact("Ισχύς από", day, F.col("isxys_apo").isNotNull()),
        fact("Κατάσταση", F.col("katastasi")),
        fact("Επαληθευμένο ΦΕΚ", F.when(F.col("epalithevmeno"), "ναι").otherwise("όχι")),
        F.array(F.lit(""), F.concat(F.lit("> "), strip(F.col("perigrafi"))), F.lit("")),
        F.when(F.col("katastasi") != rules.IN_FORCE, F.array(F.lit("> [!WARNING]"), F.lit("> **Δεν αποτελεί ισχύον δίκαιο.** Διατηρείται για ιστορικούς ή μεταβατικούς λόγους."), F.lit(""))).otherwise(none),
        F.when(~F.col("epalithevmeno"), F.array(F.lit("> [!CAUTION]"), F.lit("> Τα στοιχεία ΦΕΚ δεν έχουν ακόμη αντιπαραβληθεί με το επίσημο αρχείο του Εθνικού Τυπογραφείου."), F.lit(""))).otherwise(none),
        F.when(F.col("simeioseis").isNotNull(), F.array(F.concat(F.lit("**Σημειώσεις:** "), strip(F.col("simeioseis"))), F.lit(""))).otherwise(none),
        F.array(F.lit("---"), F.lit("")),
    )
    return laws.select(F.col("id").alias("law"), F.array_join(lines, "\n").alias("header"))


def spoken_export(records: DataFrame, laws: DataFrame) -> DataFrame:
    """(law, document, articles, characters) of laws in force that have records: the text as it is read aloud.

    Records carry `law` and `seq`; equal article numbers next to each other are one article.
    """
    live = laws.where(F.col("katastasi") == rules.IN_FORCE)
    fek = F.col("fek")
    meta = live.select(
        F.col("id").alias("law"),
        pronounce(names.label(F.col("syntomos_titlos"), names.display_name(F.col("typos"), F.col("arithmos"), F.col("etos")))).alias("spoken"),
        pronounce(F.col("titlos")).alias("law_title"),
        pronounce(F.coalesce("perigrafi", F.lit(""))).alias("about"),
        F.when(F.coalesce("prosochi", F.lit("")) != "", pronounce(F.col("prosochi"))).alias("caution"),
        names.identity(F.col("typos"), F.col("arithmos"), F.col("etos"), fek["teuxos"], fek["arithmos"], fek["imerominia"], F.col("isxys_apo")).alias("identity"),
    )
    said = F.concat(F.when(F.col("paragrafos") != "", F.concat(F.lit("Παράγραφος "), "paragrafos", F.lit(". "))).otherwise(""), pronounce(F.col("keimeno")))
    rows = adjacent_groups(records, "law", "arthro", "seq").withColumn("said", said)
    blocks = rows.groupBy("law", "run").agg(
        F.min_by(F.struct("arthro", "titlos", "meros_titlos", "kefalaio_titlos"), "seq").alias("a"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "said"))), lambda x: F.concat(x["said"], F.lit("\n"))), "\n").alias("body"),
    )
    place = F.concat_ws(" — ", *[F.when(F.coalesce(F.col(c), F.lit("")) != "", pronounce(F.col(c))) for c in ("a.meros_titlos", "a.kefalaio_titlos")])
    title = F.when(F.col("a.titlos") != "", F.concat(F.lit(": "), pronounce(F.col("a.titlos")))).otherwise("")
    block = F.concat(F.lit("## "), "spoken", F.lit(" — Άρθρο "), "a.arthro", title, F.lit("\n\n"), "identity", F.lit("\n"), bound(place, lambda p: F.when(p != "", F.concat(p, F.lit("\n"))).otherwise("")), F.lit("\n"), "body")
    texts = blocks.join(meta, "law").withColumn("block", block)
    docs = texts.groupBy("law").agg(F.first("law_title").alias("t"), F.first("identity").alias("i"), F.first("about").alias("d"), F.first("caution").alias("c"), F.count("*").alias("articles"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("run", "block"))), lambda x: x["block"]), "\n").alias("all"))
    top = F.concat(F.lit("# "), "t", F.lit("\n\n"), "i", F.lit("\n\n"), "d", F.lit("\n\n"), F.when(F.col("c").isNotNull(), F.concat(F.lit("## Προσοχή\n\n"), "c", F.lit("\n\n"))).otherwise(""))
    document = F.concat(strip(F.concat(top, "all")), F.lit("\n"))
    return docs.select("law", document.alias("document"), "articles", F.char_length(document).cast("long").alias("characters"))
