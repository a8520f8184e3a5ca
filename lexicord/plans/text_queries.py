"""Queries of the text and structure operators, each with the DuckDB SQL that computes the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexicord.functions import names, text
from lexicord.operators import pages, records, scan, structure
from lexicord.plans import synth
from lexicord.sources.extract import page_text as extracted_page_text
from lexicord.sources.tables import checkpointed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def synthetic_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.articles(synth.laws(table(spark, sf_dir, "documents")))


# One row for each line of each document: place k from 1, and the Part and Chapter letters of its article.
LINES_SQL = r"""
WITH cut AS (SELECT doc_id AS law, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
lines AS (SELECT law, CAST(k AS BIGINT) AS k, regexp_replace(l[k], '^\s+|\s+$', '', 'g') AS line, l[k] AS raw FROM cut, unnest(generate_series(1, len(l))) AS t(k)),
placed AS (SELECT *, CASE WHEN k >= 5 THEN substr('ΑΒΓΔΕΖΗΘ', CAST((k // 5) % 8 + 1 AS BIGINT), 1) END AS meros,
    CASE WHEN k >= 3 AND 3 * (k // 3) >= 5 * (k // 5) THEN substr('ΑΒΓΔΕΖΗΘ', CAST((k // 3) % 8 + 1 AS BIGINT), 1) END AS kefalaio FROM lines)
"""


def law_structure(spark, sf_dir):
    rows = synthetic_articles(spark, sf_dir)
    return rows.select("law", "arthro", "titlos", "meros", "meros_titlos", "kefalaio", "kefalaio_titlos", F.size("paragrafoi").cast("long").alias("n_paragraphs"))


LAW_STRUCTURE = LINES_SQL + """
SELECT law, CAST(k AS VARCHAR) AS arthro, 'Τίτλος άρθρου' AS titlos, meros, CASE WHEN meros IS NOT NULL THEN 'Τίτλος μέρους' END AS meros_titlos,
    kefalaio, CASE WHEN kefalaio IS NOT NULL THEN 'Τίτλος κεφαλαίου' END AS kefalaio_titlos, CAST(1 AS BIGINT) AS n_paragraphs FROM placed
"""


def article_counts(spark, sf_dir):
    rows = synthetic_articles(spark, sf_dir)
    return rows.groupBy("law").agg(F.count("*").alias("articles"), F.sum(F.size("paragrafoi")).alias("paragraphs"))


ARTICLE_COUNTS = LINES_SQL + "SELECT law, count(*) AS articles, count(*) AS paragraphs FROM placed GROUP BY law"


def paragraph_records(spark, sf_dir):
    rows = records.flatten(synthetic_articles(spark, sf_dir))
    rows = records.numbered_ids(rows, names.record_id(F.col("law").cast("string"), F.length("keimeno").cast("string"), F.lit("1")))
    return rows.select("id", "law", "arthro", "paragrafos", "keimeno", "meros")


PARAGRAPH_RECORDS = LINES_SQL + """
, numbered AS (SELECT *, row_number() OVER (PARTITION BY law, length(line) ORDER BY k) AS nth FROM placed)
SELECT law || ':art-' || length(line) || ':par-1' || CASE WHEN nth > 1 THEN '-' || nth ELSE '' END AS id, law, CAST(k AS VARCHAR) AS arthro,
    '1' AS paragrafos, line AS keimeno, meros FROM numbered
"""


def part_chapter_counts(spark, sf_dir):
    rows = synthetic_articles(spark, sf_dir)
    return rows.groupBy("meros", "kefalaio").agg(F.count("*").alias("articles"), F.count_distinct("law").alias("laws"))


PART_CHAPTER_COUNTS = LINES_SQL + "SELECT meros, kefalaio, count(*) AS articles, count(DISTINCT law) AS laws FROM placed GROUP BY ALL"


def numbered_lines(spark, sf_dir):
    """Lines as articles whose numbers repeat."""
    rows = synth.lines(table(spark, sf_dir, "documents"))
    return rows.select("law", "pos", (F.length("line") % 23).cast("string").alias("arthro"), F.length("line").cast("long").alias("size"))


NUMBERED_SQL = LINES_SQL + ", arts AS (SELECT law, k AS pos, CAST(length(raw) % 23 AS VARCHAR) AS arthro, length(raw) AS size FROM lines)"


def first_occurrence_articles(spark, sf_dir):
    return structure.first_articles(numbered_lines(spark, sf_dir)).select("law", F.col("pos").cast("long").alias("pos"), "arthro", "size")


FIRST_OCCURRENCE = NUMBERED_SQL + "SELECT law, pos, arthro, size FROM arts QUALIFY row_number() OVER (PARTITION BY law, arthro ORDER BY pos) = 1"


def duplicate_articles_report(spark, sf_dir):
    return structure.repeated_articles(numbered_lines(spark, sf_dir)).select("law", F.array_join("repeated", ",").alias("repeated"))


DUPLICATES = NUMBERED_SQL + """
, second AS (SELECT * FROM arts QUALIFY row_number() OVER (PARTITION BY law, arthro ORDER BY pos) = 2)
SELECT law, string_agg(arthro, ',' ORDER BY pos) AS repeated FROM second GROUP BY law
"""


def relevant_articles(spark, sf_dir):
    rows = numbered_lines(spark, sf_dir).withColumn("arthro", F.concat("arthro", F.when(F.col("pos") % 4 == 0, "Α").otherwise("")))
    wanted = F.when(F.col("law") % 3 == 0, F.array().cast("array<int>")).otherwise(F.array((F.col("law") % 23).cast("int"), F.lit(7)))
    return structure.relevant_articles(rows.withColumn("wanted", wanted), F.col("wanted")).select("law", F.col("pos").cast("long").alias("pos"), "arthro")


RELEVANT = NUMBERED_SQL + "SELECT law, pos, arthro || CASE WHEN pos % 4 = 0 THEN 'Α' ELSE '' END AS arthro FROM arts WHERE law % 3 = 0 OR arthro = CAST(law % 23 AS VARCHAR) OR arthro = '7'"


def supplement_fill(spark, sf_dir):
    """Laws with two supplement files; every fourth number has a letter, every tenth law has no articles of its own, every third no first file."""
    rows = numbered_lines(spark, sf_dir).select("law", "pos", F.concat("arthro", F.when(F.col("pos") % 4 == 0, "Α").otherwise("")).alias("arthro"))
    main = structure.first_articles(rows.where("pos % 3 = 1 and law % 10 != 0").select("law", "pos", "arthro"))
    extra = rows.where("pos % 3 = 2 and law % 3 != 0").withColumn("file", F.lit(1)).unionByName(rows.where("pos % 3 = 0").withColumn("file", F.lit(2)))
    filled = structure.with_supplements(main, extra)
    return filled.select("law", F.col("pos").cast("long").alias("seq"), "arthro", F.col("file").cast("long").alias("file"))


# One file after another: what the law or an earlier file has is not taken again, repeats within a file are.
SUPPLEMENT = NUMBERED_SQL + """
, r AS (SELECT law, pos, arthro || CASE WHEN pos % 4 = 0 THEN 'Α' ELSE '' END AS arthro FROM arts),
main AS (SELECT law, min(pos) AS pos, arthro FROM r WHERE pos % 3 = 1 AND law % 10 != 0 GROUP BY law, arthro),
one AS (SELECT * FROM r a WHERE pos % 3 = 2 AND law % 3 != 0 AND law IN (SELECT law FROM main) AND NOT EXISTS (FROM main m WHERE m.law = a.law AND m.arthro = a.arthro)),
two AS (SELECT * FROM r a WHERE pos % 3 = 0 AND law IN (SELECT law FROM main) AND NOT EXISTS (FROM main m WHERE m.law = a.law AND m.arthro = a.arthro) AND NOT EXISTS (FROM one m WHERE m.law = a.law AND m.arthro = a.arthro)),
every AS (SELECT law, pos, arthro, NULL::BIGINT AS file FROM main UNION ALL SELECT law, pos, arthro, 1 FROM one UNION ALL SELECT law, pos, arthro, 2 FROM two),
f AS (SELECT *, law IN (SELECT law FROM one UNION ALL SELECT law FROM two) AS added FROM every)
SELECT law, row_number() OVER (PARTITION BY law ORDER BY CASE WHEN added THEN CAST(rtrim(arthro, 'Α') AS INT) END, CASE WHEN added THEN arthro END, coalesce(file, 0), pos) - 1 AS seq, arthro, file FROM f
"""


def numeric_suffix_order(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), F.concat(F.col("p_size").cast("string"), F.when(F.col("p_partkey") % 3 == 0, "Α").otherwise("")).alias("arthro"))
    number, suffix = names.article_order(F.col("arthro"))
    return rows.withColumn("number", number.cast("long")).groupBy("number", suffix.alias("arthro")).agg(F.min("part").alias("first_part"))


NUMERIC_SUFFIX = """
WITH a AS (SELECT p_partkey AS part, CAST(p_size AS VARCHAR) || CASE WHEN p_partkey % 3 = 0 THEN 'Α' ELSE '' END AS arthro FROM part)
SELECT coalesce(TRY_CAST(regexp_replace(arthro, '[^0-9]', '', 'g') AS BIGINT), 0) AS number, arthro, min(part) AS first_part FROM a GROUP BY ALL
"""


def normalised_texts(spark, sf_dir):
    """Documents with page noise, ligatures and stray blanks put in, normalised."""
    noise = F.concat(F.lit("ΕΦΗΜΕΡΙ∆Α TΗΣ ΚΥΒΕΡΝΗΣΕΩΣ\n  123  \n- 42 -\nΕφημερις της Κυβερνησεως\n\n"), F.replace(F.col("text"), F.lit(". "), F.lit(".  \n")), F.lit("\n77"))
    docs = table(spark, sf_dir, "documents").select("doc_id", noise.alias("text"))
    out = text.normalise(F.col("text"), unicode_forms=False)
    return docs.select("doc_id", F.length(out).cast("long").alias("n_chars"), F.sha2(F.encode(out, "UTF-8"), 256).alias("text_sha256"))


NORMALISED = r"""
WITH a AS (SELECT doc_id, regexp_replace(replace(replace(replace(translate(replace(text, '. ', '.  ' || chr(10)), '´’“”– ', '΄''""- '), 'ﬀ', 'ff'), 'ﬁ', 'fi'), 'ﬂ', 'fl'),
    '([\p{L}\p{N}_])[-\x{00AD}]\n([\p{L}\p{N}_])', '\1\2', 'g') AS t FROM documents),
b AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: NOT regexp_matches(x, '^\s*$') AND NOT regexp_matches(x, '^\s*\d{1,6}\s*$') AND NOT regexp_matches(x, '^\s*[-—]\s*\d{1,6}\s*[-—]\s*$')) AS l FROM a),
c AS (SELECT doc_id, regexp_replace(array_to_string(list_transform(l, lambda x: rtrim(regexp_replace(x, '[ \t]{2,}', ' ', 'g'), ' ' || chr(9) || chr(13))), chr(10)), '^\s+|\s+$', '', 'g') AS t FROM b)
SELECT doc_id, length(t) AS n_chars, sha256(t) AS text_sha256 FROM c
"""


def composed_keys(spark, sf_dir):
    """Documents with letters taken apart into letter and mark, composed again, and their search keys."""
    apart = F.replace(F.replace("text", F.lit("é"), F.lit("e\u0301")), F.lit("ü"), F.lit("u\u0308"))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, apart).otherwise(F.col("text")).alias("text"))
    return docs.select("doc_id", F.sha2(F.encode(text.composed(F.col("text")), "UTF-8"), 256).alias("text_sha256"), F.sha2(F.encode(text.search_key_of(F.col("text")), "UTF-8"), 256).alias("key_sha256"))


COMPOSED = """
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN replace(replace(text, 'é', 'e' || chr(769)), 'ü', 'u' || chr(776)) ELSE text END AS t FROM documents)
SELECT doc_id, sha256(nfc_normalize(t)) AS text_sha256, sha256(replace(strip_accents(nfc_normalize(lower(t))), 'ς', 'σ')) AS key_sha256 FROM d
"""


def database_markers(spark, sf_dir):
    """Documents whose lines follow a database's markers and traces, some with the article's own heading within reach."""
    marker = lambda i: F.concat(F.lit("Άρθρο :"), (i % 4).cast("string"))
    own = lambda i: F.when(i % 3 == 1, F.concat(F.lit("\nΆρθρο "), (i % 4).cast("string"), F.lit(".\n"))).otherwise("")
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.concat(F.lit("Προισχύσασες μορφές άρθρου : 3"), marker(i), x, own(i)))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.array_join(lines, "\n").alias("text"))
    out = text.drop_database_traces(F.col("text"))
    return docs.select("doc_id", F.length(out).cast("long").alias("n_chars"), F.sha2(F.encode(out, "UTF-8"), 256).alias("text_sha256"))


# A marker's number takes in the figures that its line begins with.  Its reach is the 300 characters after them: its own line's heading is in them, or a later line's of the same number.
MARKERS = r"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
p AS (SELECT doc_id, i, ((i - 1) % 4) || regexp_extract(l[i], '^\p{Nd}*') AS n, regexp_replace(l[i], '^\p{Nd}+', '') || CASE WHEN (i - 1) % 3 = 1 THEN chr(10) || 'Άρθρο ' || ((i - 1) % 4) || '.' || chr(10) ELSE '' END AS below FROM l, unnest(generate_series(1, len(l))) AS t(i)),
q AS (SELECT *, left(below || coalesce(chr(10) || string_agg(chr(10) || 'Άρθρο :' || n || below, chr(10)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND 300 FOLLOWING), ''), 300) AS reach FROM p),
r AS (SELECT doc_id, i, chr(10) || CASE WHEN n = '0' OR regexp_matches(reach, '(?m)^[ 	]*[ΆΑ]ρθρο[νΝ]?[ 	]+' || n || '[ 	]*[.:]?[ 	]*$') THEN chr(10) ELSE chr(10) || 'Άρθρο ' || n || chr(10) END || below AS piece FROM q),
t AS (SELECT doc_id, string_agg(piece, chr(10) ORDER BY i) AS t FROM r GROUP BY doc_id)
SELECT doc_id, length(t) AS n_chars, sha256(t) AS text_sha256 FROM documents LEFT JOIN t USING (doc_id)
"""


def segmented_runs(spark, sf_dir):
    """Runs of equal events of each user, scanned by day, and the last purchase before each, summed up."""
    events = checkpointed(table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", F.struct("ts", "event_id").alias("at"), F.date_trunc("day", "ts").alias("segment")))
    rows = scan.adjacent_groups(events, "user_id", "event_type", "at")
    bought = scan.carried(events, "user_id", "at", {"bought": F.when(F.col("event_type") == "purchase", F.col("event_id"))})
    one = rows.groupBy("user_id").agg(F.max("run").alias("runs"), F.sum(F.col("run") * (F.col("event_id") % 97)).alias("run_sum"))
    two = bought.groupBy("user_id").agg(F.sum("bought").alias("bought_sum"), F.count("bought").alias("with_purchase"))
    return one.join(two, one["user_id"].eqNullSafe(two["user_id"])).select(one["user_id"], "runs", "run_sum", "bought_sum", "with_purchase")


SEGMENTED = """
WITH a AS (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w OR lag(1) OVER w IS NULL THEN 1 ELSE 0 END AS s,
    last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS bought FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
b AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM a)
SELECT user_id, CAST(max(run) AS BIGINT) AS runs, CAST(sum(run * (event_id % 97)) AS BIGINT) AS run_sum, CAST(sum(bought) AS BIGINT) AS bought_sum, count(bought) AS with_purchase FROM b GROUP BY user_id
"""


def homoglyph_repair(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.translate("text", "eu", "ευ").alias("text"))
    return docs.select("doc_id", F.sha2(F.encode(text.repair_lookalikes(F.col("text")), "UTF-8"), 256).alias("text_sha256"))


HOMOGLYPHS = r"""
WITH a AS (SELECT doc_id, regexp_extract_all(translate(text, 'eu', 'ευ'), '\p{L}+|[^\p{L}]+') AS w FROM documents)
SELECT doc_id, sha256(array_to_string(list_transform(w, lambda x: CASE WHEN regexp_matches(x, '[\x{0370}-\x{03FF}\x{1F00}-\x{1FFF}]') THEN translate(x, 'ABEZHIKMNOPTXYovpx', 'ΑΒΕΖΗΙΚΜΝΟΡΤΧΥονρχ') ELSE x END), '')) AS text_sha256 FROM a
"""


def search_keys(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.sha2(F.encode(text.search_key(F.col("text")), "UTF-8"), 256).alias("key_sha256"))


SEARCH_KEYS = "SELECT doc_id, sha256(replace(strip_accents(lower(text)), 'ς', 'σ')) AS key_sha256 FROM documents"


def gazette_verified(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("text", F.concat(F.lit("Τεύχος Α΄"), F.col("doc_id").cast("string"), F.lit("/13.06.2025\n"), "text"))
    number = F.when(F.col("doc_id") % 5 != 0, F.col("doc_id") - F.col("doc_id") % 2)
    return docs.select("doc_id", text.gazette_verified(F.col("text"), number, F.lit(2025)).alias("verified"))


GAZETTE = """
WITH a AS (SELECT doc_id, left('Τεύχος Α΄' || doc_id || '/13.06.2025' || chr(10) || text, 8000) AS t, CASE WHEN doc_id % 5 != 0 THEN doc_id - doc_id % 2 END AS n FROM documents)
SELECT doc_id, coalesce(contains(t, CAST(n AS VARCHAR)), false) AS verified FROM a
"""


def spoken_references(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    key, year = F.col("o_orderkey").cast("string"), F.year("o_orderdate").cast("string")
    kind = F.when(F.col("o_orderkey") % 3 == 0, "ν. ").when(F.col("o_orderkey") % 3 == 1, "π.δ. ").otherwise("κ.υ.α. ")
    written = F.concat(F.lit("Το άρθρ. 5 παρ. 2 περ. β΄ του "), kind, (F.col("o_orderkey") % 9999).cast("string"), F.lit("/"), year, F.lit(" (Α΄ 110), όριο 50 χλμ/ώρα, 12% κ.λπ."))
    return orders.select("o_orderkey", text.pronounce(written).alias("spoken"))


SPOKEN = """
SELECT o_orderkey, 'Το άρθρο 5 παράγραφος 2 περίπτωση βήτα του ' || CASE o_orderkey % 3 WHEN 0 THEN 'νόμου ' WHEN 1 THEN 'προεδρικού διατάγματος ' ELSE 'κοινής υπουργικής απόφασης ' END
    || (o_orderkey % 9999) || ' του ' || year(o_orderdate) || ' (Άλφα 110), όριο 50 χιλιόμετρα την ώρα, 12 τοις εκατό και λοιπά' AS spoken FROM orders
"""


def law_names(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    series = F.element_at(F.array(*map(F.lit, "ABCD")), (F.col("o_orderkey") % 4 + 1).cast("int"))
    kind = F.when(F.col("o_orderkey") % 2 == 0, "nomos").otherwise("odigia_ee")
    number, day = F.col("o_orderkey"), F.col("o_orderdate")
    year = F.year("o_orderdate")
    return orders.select(
        "o_orderkey",
        names.pdf_id(year, series, number).alias("pdf_id"),
        names.citation(series, number, day).alias("citation"),
        names.display_name(kind, number.cast("string"), year).alias("display_name"),
        names.spoken_name(kind, number.cast("string"), year).alias("spoken_name"),
        names.spoken_date(day).alias("spoken_date"),
        names.spoken_series(series).alias("spoken_series"),
    )


LAW_NAMES = """
SELECT o_orderkey, year(o_orderdate) || '0' || (o_orderkey % 4 + 1) || CASE WHEN length(CAST(o_orderkey AS VARCHAR)) < 5 THEN lpad(CAST(o_orderkey AS VARCHAR), 5, '0') ELSE CAST(o_orderkey AS VARCHAR) END AS pdf_id,
    substr('ΑΒΓΔ', CAST(o_orderkey % 4 + 1 AS BIGINT), 1) || '΄' || o_orderkey || '/' || strftime(o_orderdate, '%d-%m-%Y') AS citation,
    CASE WHEN o_orderkey % 2 = 0 THEN 'Ν. ' || o_orderkey || '/' || year(o_orderdate) ELSE 'Οδηγία ' || o_orderkey END AS display_name,
    CASE WHEN o_orderkey % 2 = 0 THEN 'Νόμος ' || o_orderkey || ' του ' || year(o_orderdate) ELSE 'Οδηγία της Ευρωπαϊκής Ένωσης ' || o_orderkey END AS spoken_name,
    day(o_orderdate) || ' ' || (['Ιανουαρίου','Φεβρουαρίου','Μαρτίου','Απριλίου','Μαΐου','Ιουνίου','Ιουλίου','Αυγούστου','Σεπτεμβρίου','Οκτωβρίου','Νοεμβρίου','Δεκεμβρίου'])[month(o_orderdate)] || ' ' || year(o_orderdate) AS spoken_date,
    (['Άλφα','Βήτα','Γάμμα','Δέλτα'])[o_orderkey % 4 + 1] AS spoken_series
FROM orders
"""


def export_documents(spark, sf_dir):
    rows = synth.lines(table(spark, sf_dir, "documents"))
    out = records.assembled(rows, "law", F.col("pos"), F.concat(F.lit("Παράγραφος "), F.col("pos").cast("string"), F.lit(". "), F.col("line"), F.lit("\n")))
    return out.select("law", F.sha2(F.encode("document", "UTF-8"), 256).alias("document_sha256"), F.char_length("document").cast("long").alias("characters"))


EXPORT_DOCUMENTS = LINES_SQL + """
, d AS (SELECT law, string_agg('Παράγραφος ' || k || '. ' || raw || chr(10), chr(10) ORDER BY k) AS t FROM lines GROUP BY law)
SELECT law, sha256(t) AS document_sha256, length(t) AS characters FROM d
"""


def markdown_documents(spark, sf_dir):
    out = records.markdown(synthetic_articles(spark, sf_dir))
    return out.select("law", F.sha2(F.encode("document", "UTF-8"), 256).alias("document_sha256"))


MARKDOWN = LINES_SQL + """
, d AS (SELECT law, k, CASE WHEN k % 5 = 0 THEN '## ΜΕΡΟΣ ' || meros || '΄ Τίτλος μέρους' || chr(10) || chr(10) ELSE '' END
    || CASE WHEN kefalaio IS NOT NULL AND (k % 3 = 0 OR lag(kefalaio) OVER (PARTITION BY law ORDER BY k) IS DISTINCT FROM kefalaio) THEN '### ΚΕΦΑΛΑΙΟ ' || kefalaio || '΄ Τίτλος κεφαλαίου' || chr(10) || chr(10) ELSE '' END
    || '#### Άρθρο ' || k || ' — Τίτλος άρθρου' || chr(10) || chr(10) || '1. ' || line || chr(10) AS t FROM placed)
SELECT law, sha256(string_agg(t, chr(10) ORDER BY k)) AS document_sha256 FROM d GROUP BY law
"""


def preview_lines(spark, sf_dir):
    cut = F.transform(F.slice(F.split("text", "\n"), 1, 5), lambda x: F.left(x, F.lit(100)))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(cut, "\n").alias("preview"))


PREVIEW = "SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10))[1:5], lambda x: left(x, 100)), chr(10)) AS preview FROM documents"


def text_checksums(spark, sf_dir):
    rows = table(spark, sf_dir, "pages")
    return rows.select("page_id", F.sha2(F.encode("html", "UTF-8"), 256).alias("checksum"), F.substring(F.sha2(F.encode("url", "UTF-8"), 256), 1, 24).alias("cache_key"))


CHECKSUMS = "SELECT page_id, sha256(html) AS checksum, left(sha256(url), 24) AS cache_key FROM pages"


def content_kinds(spark, sf_dir):
    rows = table(spark, sf_dir, "pages")
    magic = F.element_at(F.array(*[F.lit(bytearray(m)) for m in (b"%PDF-1.7", b"\xd0\xcf\x11\xe0", b"PK\x03\x04", b"{\\rtf1", b" \n", b"x")]), (F.col("page_id") % 6 + 1).cast("int"))
    return rows.select("page_id", text.content_kind(F.concat(magic, F.encode("html", "UTF-8"))).alias("kind"))


KINDS = "SELECT page_id, (['pdf', 'doc', 'zip', 'rtf', 'html', 'unknown'])[page_id % 6 + 1] AS kind FROM pages"


def page_texts(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", extracted_page_text("html").alias("text"))


def column_gutters(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    words = rows.select((F.col("l_orderkey") % 50).alias("page"), (F.col("l_quantity") * 12.0).alias("x0"), F.lit(600.0).alias("width"), F.col("l_partkey"))
    left = F.when(F.col("l_partkey") % 2 == 0, F.col("x0") / 3).otherwise(330 + F.col("x0") / 3)
    wide = F.when(F.col("l_partkey") % (F.col("page") * 5 + 7) == 0, 250.0).otherwise(60.0)
    return pages.gutters(words.select("page", left.alias("x0"), (left + wide).alias("x1"), "width"))


GUTTERS = """
WITH w AS (SELECT l_orderkey % 50 AS page, CASE WHEN l_partkey % 2 = 0 THEN l_quantity * 12.0 / 3 ELSE 330 + l_quantity * 12.0 / 3 END AS x0, CASE WHEN l_partkey % (l_orderkey % 50 * 5 + 7) = 0 THEN 250.0 ELSE 60.0 END AS wide FROM lineitem),
c AS (SELECT page, p, count(*) AS n, count(*) FILTER (x0 < 600.0 * p / 100 AND 600.0 * p / 100 < x0 + wide) AS c FROM w, generate_series(35, 65) AS t(p) GROUP BY ALL),
m AS (SELECT page, n, min(c) AS least FROM c GROUP BY ALL),
t AS (SELECT page, list(p ORDER BY p) AS ties FROM c JOIN m USING (page, n) WHERE c = least GROUP BY page)
SELECT page, CASE WHEN n >= 40 AND least / n < 0.02 THEN CAST(600.0 * ties[len(ties) // 2 + 1] / 100 AS DOUBLE) END AS gutter FROM m JOIN t USING (page)
"""


def text_layers(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", (F.col("turn") + 1).alias("turn"), F.when(F.col("role") == "user", " ").otherwise(F.col("text")).alias("text"))
    return pages.has_text_layer(rows, "conv_id", "turn")


TEXT_LAYERS = "SELECT conv_id, coalesce(max(CASE WHEN turn + 1 <= 3 THEN length(trim(CASE WHEN role = 'user' THEN ' ' ELSE coalesce(text, '') END)) > 0 END), false) AS has_text FROM conversations GROUP BY conv_id"

QUERIES = {
    "law_structure": (law_structure, LAW_STRUCTURE),
    "article_paragraph_counts": (article_counts, ARTICLE_COUNTS),
    "paragraph_records": (paragraph_records, PARAGRAPH_RECORDS),
    "part_chapter_counts": (part_chapter_counts, PART_CHAPTER_COUNTS),
    "first_occurrence_articles": (first_occurrence_articles, FIRST_OCCURRENCE),
    "duplicate_articles_report": (duplicate_articles_report, DUPLICATES),
    "relevant_articles": (relevant_articles, RELEVANT),
    "supplement_fill": (supplement_fill, SUPPLEMENT),
    "numeric_suffix_order": (numeric_suffix_order, NUMERIC_SUFFIX),
    "normalised_texts": (normalised_texts, NORMALISED),
    "composed_keys": (composed_keys, COMPOSED),
    "database_markers": (database_markers, MARKERS),
    "segmented_runs": (segmented_runs, SEGMENTED),
    "homoglyph_repair": (homoglyph_repair, HOMOGLYPHS),
    "search_keys": (search_keys, SEARCH_KEYS),
    "gazette_verified": (gazette_verified, GAZETTE),
    "spoken_references": (spoken_references, SPOKEN),
    "law_names": (law_names, LAW_NAMES),
    "export_documents": (export_documents, EXPORT_DOCUMENTS),
    "markdown_documents": (markdown_documents, MARKDOWN),
    "preview_lines": (preview_lines, PREVIEW),
    "text_checksums": (text_checksums, CHECKSUMS),
    "content_kinds": (content_kinds, KINDS),
    "page_texts": (page_texts, None),
    "column_gutters": (column_gutters, GUTTERS),
    "text_layers": (text_layers, TEXT_LAYERS),
}
