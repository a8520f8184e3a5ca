"""The three entry points: build the corpus, export it for reading aloud, find sources."""

from __future__ import annotations

from itertools import count
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexicord.functions import rules
from lexicord.functions.text import content_kind, gazette_verified, normalise
from lexicord.operators import changes, fallback, links, records, structure
from lexicord.sources.extract import extracted
from lexicord.sources.tables import checkpointed


class Built(NamedTuple):
    """What a run gives: articles; manifest entries of laws that worked; (id, proeidopoiiseis, error) of every law."""

    articles: DataFrame
    manifest: DataFrame
    told: DataFrame


def says(pattern: str, *values: Column) -> Column:
    return F.format_string(pattern, *values)


def parsed(texts: DataFrame, laws: DataFrame) -> DataFrame:
    """(id, text, verified, checksum, error) with normalised text; blank texts are errors."""
    rows = texts.join(laws.select("id", "fek"), "id", "left")
    clean = normalise(F.col("raw"))
    rows = rows.select("id", "raw", clean.alias("text"), gazette_verified(F.col("raw"), F.col("fek.arithmos"), F.year("fek.imerominia")).alias("verified"))
    return rows.select("id", "text", "verified", F.sha2(F.encode("text", "UTF-8"), 256).alias("checksum_keimenou"), F.when(F.col("text") == "", "blank text").alias("error"))


def wanted_articles(texts: DataFrame, laws: DataFrame) -> DataFrame:
    """Articles of (id, text) rows that the registry asks for, repeats included."""
    wanted = laws.select(F.col("id").alias("law"), "relevanta_arthra")
    found = structure.articles(texts, "id", "text").join(wanted, "law")
    return structure.relevant_articles(found, F.col("relevanta_arthra")).drop("relevanta_arthra")


def supplement_articles(texts: DataFrame) -> DataFrame:
    """Articles of (id, file, text) rows with `file`; Part and Chapter are carried within a file only."""
    rows = structure.articles(texts.select(F.struct("id", "file").alias("of"), "text"), "of", "text")
    return rows.select(F.col("law.id").alias("law"), F.col("law.file").alias("file"), *[c for c in rows.columns if c != "law"])


def corpus(texts: DataFrame, laws: DataFrame, supplements: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Articles of each law (relevant ones, first of each number, gaps filled), and one manifest row for each law.

    For texts that are at hand as (id, raw); built() finds them in the sources.
    Supplements are (id, file, raw), lower files first.  Laws without articles get
    a manifest row with an error and no articles; a supplement does not rescue them.
    """
    rows = parsed(texts, laws)
    kept = structure.first_articles(wanted_articles(rows.where("error is null"), laws))
    if supplements is not None:
        extra = supplement_articles(supplements.select("id", "file", normalise(F.col("raw")).alias("text")))
        kept = structure.with_supplements(kept, extra).drop("file")
    counts = counted(kept)
    told = rows.join(counts, "id", "left").select("id", "checksum_keimenou", "plithos_arthron", "plithos_paragrafon", F.col("verified").alias("epalithevmeno_fek"), F.coalesce("error", F.when(F.col("plithos_arthron").isNull(), "no articles")).alias("error"))
    return kept, told


def counted(articles: DataFrame) -> DataFrame:
    return articles.groupBy(F.col("law").alias("id")).agg(F.count("*").alias("plithos_arthron"), F.sum(F.size("paragrafoi")).cast("long").alias("plithos_paragrafon"))


def attempted(turn: DataFrame, laws: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What one source of each law gives: written (id, nth, source_type, url, outcome, message, ...) and written articles.

    A source is done only if its text, normalised and parsed, has an article that
    the registry asks for.
    """
    why = F.col("error") if "error" in files.columns else F.lit(None).cast("string")
    got = turn.join(files.select("url", "content", "content_type", why.alias("unread")), "url", "left").join(laws.select("id", "fek"), "id").withColumn("e", extracted("content"))
    raw = F.coalesce("e.text", F.lit(""))
    rows = checkpointed(
        got.select(
            "id",
            "nth",
            "source_type",
            "url",
            F.col("content").isNull().alias("absent"),
            "unread",
            (content_kind(F.col("content")) == "pdf").alias("pdf"),
            F.octet_length("content").alias("size"),
            F.coalesce(F.nullif("content_type", F.lit("")), F.lit(rules.SAYS_UNKNOWN_TYPE)).alias("content_type"),
            F.col("e.error").alias("error"),
            normalise(raw).alias("text"),
            F.col("fek").isNotNull().alias("in_gazette"),
            gazette_verified(raw, F.col("fek.arithmos"), F.year("fek.imerominia")).alias("verified"),
            F.sha2("content", 256).alias("checksum_pigis"),
        )
    )
    found = checkpointed(wanted_articles(rows.where("text != ''").select("id", "text"), laws))
    some = found.groupBy(F.col("law").alias("id")).agg(F.count("*").alias("n"))
    outcome = F.when(F.col("absent"), "absent").when(F.col("error").isNotNull(), "unreadable").when((F.col("text") == "") & F.col("pdf"), "scanned").when(F.col("text") == "", "blank").when(F.col("n").isNull(), "no_articles").otherwise("done")
    message = (
        F.when(F.col("outcome") == "absent", F.coalesce("unread", says(rules.SAYS_NO_FILE, F.col("url"))))
        .when(F.col("outcome") == "unreadable", F.col("error"))
        .when(F.col("outcome") == "scanned", rules.SAYS_SCANNED)
        .when(F.col("outcome") == "blank", says(rules.SAYS_BLANK, F.col("url"), F.col("size"), F.col("content_type")))
        .when(F.col("outcome") == "no_articles", rules.SAYS_NO_ARTICLES)
    )
    tries = rows.join(some, "id", "left").withColumn("outcome", outcome).withColumn("message", message)
    tries = tries.select("id", "nth", "source_type", "url", "outcome", "message", "in_gazette", "verified", "checksum_pigis", F.sha2(F.encode("text", "UTF-8"), 256).alias("checksum_keimenou"))
    return checkpointed(tries), found


def settled(laws: DataFrame, files: DataFrame, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Tries and articles: wave n extracts, normalises and parses the n-th source of laws that no earlier wave settled.

    The tries are the state: a law is settled by its first try that is done.  A
    lower source of a settled law is never read.
    """
    left, tries, articles = fallback.ranked_sources(laws), None, None
    for n in count(1):
        wave, found = attempted(left.where(F.col("nth") == n), laws, files)
        tries, articles = (wave, found) if tries is None else (tries.unionByName(wave), articles.unionByName(found))
        left = left.join(wave.where("outcome = 'done'").select("id"), "id", "left_anti")
        if n == most or left.where(F.col("nth") > n).isEmpty():
            return tries, articles


def built(laws: DataFrame, files: DataFrame, most: int | None = None) -> Built:
    """The whole run: the first source of each law that gives articles, first of each number, gaps filled from supplements.

    files is (url, content, content_type), and `error` where a reader tells why
    there is no content.  Notices come in this order: another
    source than the preferred one, gazette not found in the text, repeated
    articles, supplements that could not be read, articles from supplements.
    """
    tries, found = settled(laws, files, most)
    done = tries.where("outcome = 'done'")
    main = structure.first_articles(found)

    why = F.col("error") if "error" in files.columns else F.lit(None).cast("string")
    given = fallback.supplements(laws).join(done.select("id"), "id", "left_semi").join(files.select("url", "content", why.alias("why")), "url", "left")
    text = normalise(F.make_valid_utf8(F.col("content").cast("string")))
    read = checkpointed(given.select("id", "file", "url", F.coalesce("why", says(rules.SAYS_NO_FILE, F.col("url"))).alias("why"), text.alias("text")))
    extra = checkpointed(supplement_articles(read.where("text is not null").select("id", "file", "text")))
    added = structure.missing_articles(main, extra)
    articles = structure.with_supplements(main, extra)

    def listed(rows: DataFrame, order: list[str], value: Column, name: str) -> DataFrame:
        told = F.transform(F.array_sort(F.collect_list(F.struct(*order, value.alias("said")))), lambda x: x["said"])
        return rows.groupBy("id").agg(told.alias(name))

    repeated = structure.repeated_articles(found).select(F.col("law").alias("id"), F.array_join("repeated", ", ").alias("repeated"))
    unread = listed(read.where("text is null"), ["file"], says(rules.SAYS_NO_SUPPLEMENT, F.col("url"), F.col("why")), "unread")
    filled = listed(added.withColumnRenamed("law", "id"), ["file", "pos"], F.col("arthro"), "filled")
    failed = listed(tries.where("outcome != 'done'"), ["nth"], F.struct("source_type", "message"), "failed")

    rows = laws.select("id").join(done.select("id", "nth", "source_type", "url", "in_gazette", "verified", "checksum_pigis", "checksum_keimenou"), "id", "left")
    for part in (repeated, unread, filled, failed):
        rows = rows.join(part, "id", "left")
    worked, none = F.col("nth").isNotNull(), F.array().cast("array<string>")
    notice = F.when(F.col("source_type") == rules.LOCAL_COPY, says(rules.SAYS_LOCAL_COPY, F.col("url"))).otherwise(says(rules.SAYS_OTHER_SOURCE, F.col("source_type"), F.col("url")))
    notices = F.concat(
        F.when(F.col("nth") > 1, F.array(notice)).otherwise(none),
        F.when(F.col("in_gazette") & ~F.col("verified"), F.array(F.lit(rules.SAYS_UNVERIFIED))).otherwise(none),
        F.when(F.col("repeated").isNotNull(), F.array(says(rules.SAYS_REPEATED, F.col("repeated")))).otherwise(none),
        F.coalesce("unread", none),
        F.when(F.col("filled").isNotNull(), F.array(says(rules.SAYS_SUPPLEMENTED, F.array_join("filled", ", ")))).otherwise(none),
    )
    reasons = F.array_join(F.transform("failed", lambda x: says("%s: %s", x["source_type"], x["message"])), "; ")
    error = (
        F.when(F.coalesce(F.size("failed"), F.lit(0)) < 1, says(rules.SAYS_NO_SOURCE, F.col("id").cast("string")))
        .when(F.size("failed") == 1, says(rules.SAYS_ONE_FAILED, F.col("id").cast("string"), F.get("failed", F.lit(0))["message"]))
        .otherwise(says(rules.SAYS_ALL_FAILED, F.col("id").cast("string"), F.size("failed"), reasons))
    )
    told = rows.select("id", F.when(worked, notices).otherwise(none).alias("proeidopoiiseis"), F.when(~worked, error).alias("error"))
    manifest = rows.where(worked).join(counted(articles), "id").select("id", "checksum_pigis", "checksum_keimenou", "plithos_arthron", "plithos_paragrafon", F.col("url").alias("pigi_url"), F.col("verified").alias("epalithevmeno_fek"))
    return Built(articles, manifest, told)


def refreshed(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The manifest with new entries in place of old ones, and the material changes; laws without a new entry keep their old one.

    Both have whole entries; a column that only one of them has is kept, null for
    the other's entries.
    """
    good = new.where("error is null").drop("error") if "error" in new.columns else new
    columns = [*old.columns, *[c for c in good.columns if c not in old.columns]]

    def whole(rows: DataFrame, other: DataFrame) -> DataFrame:
        return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(other.schema[c].dataType).alias(c) for c in columns])

    merged = changes.upsert(whole(old, good), whole(good, old))
    return merged, changes.material(changes.diff(old, merged))


def export(articles: DataFrame, laws: DataFrame) -> DataFrame:
    """(law, document, articles, characters) of laws in force."""
    return records.spoken_export(records.flatten(articles), laws)


def discovered(pages: DataFrame, laws: DataFrame, words: str = "") -> DataFrame:
    """(text, url): addresses that pages name and the registry does not cover, each once, repealed ones left out."""
    rows = links.with_keywords(links.links(pages), words)
    once = links.first_by(rows.select(F.struct("page_id", "pos").alias("at"), "text", "url"), ["url"], "at")
    return links.unknown_laws(links.not_repealed(once), laws, ["url"]).select("text", "url")
