"""Queries from whole law texts to records, facts and spoken documents; their SQL parses the same texts line by line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexicord.functions import names
from lexicord.operators import records, structure
from lexicord.plans.text_queries import table


def hard_text(text: Column) -> Column:
    """Each line is in an article of one of six forms: a title that goes on, a letter and figures, text alone, a quoted heading, no title, a title that is none."""

    def article(line: Column, i: Column) -> Column:
        k = (i + 1).cast("string")
        forms = {
            0: ("Άρθρο ", k, "\nΤίτλος με συνέχεια,\nπου πάει παρακάτω\n1. ", line),
            1: ("Άρθρον ", k, "β.\nΤίτλος άρθρου\n1.Α ", line, "\n2. 1.500 ευρώ\n1.500 ευρώ ξανά"),
            2: ("ΑΡΘΡΟ ", k, ":\nΜόνο κείμενο ", k),
            3: ("Άρθρο ", k, "\n«Άρθρο 5\nΤίτλος»\nΕισαγωγή\n1. ", line),
            4: ("  Άρθρο ", (i % 4 + 1).cast("string"), "\n1. ", line, "\n2. Τέλος\n1. Πάλι"),
        }
        out = F.concat(*[F.lit(x) if isinstance(x, str) else x for x in ("Άρθρο ", k, "\nΑρχή,\nβ,\nγ,\nδ,\nε,\nζ,\nη,\n1. ", line)])
        for n, parts in forms.items():
            out = F.when(i % 6 == n, F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])).otherwise(out)
        part = F.when(i % 7 == 3, "ΜΕΡΟΣ Β΄\nΓΕΝΙΚΕΣ\nΔΙΑΤΑΞΕΙΣ\n").when(i % 7 == 6, "ΜΕΡΟΣ ΤΡΙΤΟ\n").otherwise("")
        chapter = F.when(i % 5 == 2, "ΚΕΦΑΛΑΙΟ Α\nΟΡΙΣΜΟΙ\n").otherwise("")
        return F.concat(part, chapter, out)

    return F.array_join(F.transform(F.split(text, "\n"), article), "\n")


def hard_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("text is not null")
    return structure.articles(docs.select(F.concat(F.lit("l"), F.col("doc_id").cast("string")).alias("law"), hard_text(F.col("text")).alias("text")))


# Lines of the same texts; a heading is told by its line, a title and a paragraph by what stands around them.
PARSE_SQL = r"""
WITH cut AS (SELECT 'l' || doc_id AS law, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
texts AS (SELECT law, array_to_string(list_transform(l, lambda x, n: CASE (n - 1) % 7 WHEN 3 THEN 'ΜΕΡΟΣ Β΄' || chr(10) || 'ΓΕΝΙΚΕΣ' || chr(10) || 'ΔΙΑΤΑΞΕΙΣ' || chr(10) WHEN 6 THEN 'ΜΕΡΟΣ ΤΡΙΤΟ' || chr(10) ELSE '' END
    || CASE WHEN (n - 1) % 5 = 2 THEN 'ΚΕΦΑΛΑΙΟ Α' || chr(10) || 'ΟΡΙΣΜΟΙ' || chr(10) ELSE '' END
    || replace(CASE (n - 1) % 6
        WHEN 0 THEN 'Άρθρο ' || n || '|Τίτλος με συνέχεια,|που πάει παρακάτω|1. ' WHEN 1 THEN 'Άρθρον ' || n || 'β.|Τίτλος άρθρου|1.Α ' WHEN 2 THEN 'ΑΡΘΡΟ ' || n || ':|Μόνο κείμενο ' || n
        WHEN 3 THEN 'Άρθρο ' || n || '|«Άρθρο 5|Τίτλος»|Εισαγωγή|1. ' WHEN 4 THEN '  Άρθρο ' || ((n - 1) % 4 + 1) || '|1. ' ELSE 'Άρθρο ' || n || '|Αρχή,|β,|γ,|δ,|ε,|ζ,|η,|1. ' END, '|', chr(10))
    || CASE WHEN (n - 1) % 6 = 2 THEN '' ELSE x END
    || replace(CASE (n - 1) % 6 WHEN 1 THEN '|2. 1.500 ευρώ|1.500 ευρώ ξανά' WHEN 4 THEN '|2. Τέλος|1. Πάλι' ELSE '' END, '|', chr(10))), chr(10)) AS t FROM cut),
split AS (SELECT law, string_split(t, chr(10)) AS l FROM texts),
lines AS (SELECT law, i, l[i] AS raw, regexp_replace(l[i], '^\s+|\s+$', '', 'g') AS x FROM split, unnest(generate_series(1, len(l))) AS u(i)),
told AS (SELECT *, regexp_extract(raw, '^\s*ΜΕΡΟΣ\s+(ΤΡΙΤΟ|[Α-Ω]{1,4}[΄'']?)\s*$', 1) AS part, regexp_extract(raw, '^\s*ΚΕΦΑΛΑΙΟ\s+([Α-Ω]{1,4}[΄'']?)\s*$', 1) AS chapter,
    regexp_extract(raw, '^\s*(?:[ΆΑ]ρθρον?|[ΆΑ]ΡΘΡΟΝ?)\s+(\d+)\s*[Α-Ωα-ω]?\s*[.:]?\s*$', 1) AS number, upper(regexp_extract(raw, '^\s*(?:[ΆΑ]ρθρον?|[ΆΑ]ΡΘΡΟΝ?)\s+\d+\s*([Α-Ωα-ω]?)\s*[.:]?\s*$', 1)) AS letter FROM lines),
placed AS (SELECT *, part || chapter || number != '' AS head, CAST(sum(CASE WHEN part || chapter || number != '' THEN 1 ELSE 0 END) OVER (PARTITION BY law ORDER BY i) AS INT) AS pos FROM told),
heads AS (SELECT law, pos, part, chapter, number, letter FROM placed WHERE head),
body AS (SELECT law, pos, raw, x, row_number() OVER (PARTITION BY law, pos ORDER BY i) AS r FROM placed WHERE NOT head AND pos > 0),
sections AS (SELECT law, pos, coalesce(string_agg(x, ' ' ORDER BY r) FILTER (x != '' AND r <= 6), '') AS title FROM body GROUP BY law, pos),
state AS (SELECT h.*, max(CASE WHEN part != '' THEN h.pos END) OVER w AS part_at, max(CASE WHEN part || chapter != '' THEN h.pos END) OVER w AS last_at, max(CASE WHEN chapter != '' THEN h.pos END) OVER w AS chapter_at FROM heads h WINDOW w AS (PARTITION BY law ORDER BY pos)),
arts AS (SELECT s.law, s.pos, s.number || s.letter AS arthro, rtrim(p.part, '΄') AS meros, CASE WHEN p.part IS NOT NULL THEN coalesce(ps.title, '') END AS meros_titlos,
    CASE WHEN c.pos > coalesce(p.pos, 0) THEN c.chapter END AS kefalaio, CASE WHEN c.pos > coalesce(p.pos, 0) THEN coalesce(cs.title, '') END AS kefalaio_titlos
    FROM state s LEFT JOIN heads p ON p.law = s.law AND p.pos = s.part_at LEFT JOIN heads c ON c.law = s.law AND c.pos = s.chapter_at
    LEFT JOIN sections ps ON ps.law = s.law AND ps.pos = s.part_at LEFT JOIN sections cs ON cs.law = s.law AND cs.pos = s.chapter_at WHERE s.number != ''),
marked AS (SELECT b.*, max(r) FILTER (x != '') OVER (PARTITION BY law, pos) AS last, regexp_matches(raw, '^\s*\d{1,3}\.([ \t]|[^0-9])') OR (regexp_matches(x, '^\d{1,3}\.$') AND r < max(r) FILTER (x != '') OVER (PARTITION BY law, pos)) AS par,
    lag(x) OVER (PARTITION BY law, pos ORDER BY r) AS before FROM body b),
ended AS (SELECT law, pos, min(r) FILTER (r > 1 AND (x = '' OR par OR NOT (regexp_matches(x, '^[a-zα-ωάέήίόύώϊϋΐΰßà-ÿ]') OR regexp_matches(before, '[-,—–]$')))) AS stop, max(last) AS last, bool_or(r = 1 AND (x = '' OR par)) AS none FROM marked GROUP BY law, pos),
sized AS (SELECT law, pos, CASE WHEN none OR coalesce(stop - 1, last) > 6 OR coalesce(stop - 1, last) >= last THEN 0 ELSE coalesce(stop - 1, last) END AS n FROM ended),
titled AS (SELECT law, pos, coalesce(string_agg(x, ' ' ORDER BY r) FILTER (r <= n), '') AS titlos FROM marked JOIN sized USING (law, pos) GROUP BY law, pos),
grouped AS (SELECT m.*, sum(CASE WHEN par THEN 1 ELSE 0 END) OVER (PARTITION BY m.law, m.pos ORDER BY r) AS g FROM marked m JOIN sized s ON s.law = m.law AND s.pos = m.pos WHERE r > n),
pieces AS (SELECT law, pos, g, max(CASE WHEN par THEN regexp_extract(x, '^(\d{1,3})\.', 1) ELSE '' END) AS paragrafos,
    string_agg(CASE WHEN par THEN regexp_replace(regexp_replace(x, '^\d{1,3}\.', ''), '^\s+', '') ELSE x END, ' ' ORDER BY r) FILTER (CASE WHEN par THEN regexp_replace(x, '^\d{1,3}\.\s*', '') ELSE x END != '') AS keimeno FROM grouped GROUP BY law, pos, g),
par AS (SELECT a.*, titlos, row_number() OVER (PARTITION BY law, pos ORDER BY g) - 1 AS n, paragrafos, keimeno FROM arts a JOIN titled USING (law, pos) JOIN pieces USING (law, pos) WHERE keimeno IS NOT NULL)
"""


def parsed_laws(spark, sf_dir):
    rows = records.flatten(hard_articles(spark, sf_dir))
    return rows.select("law", F.col("pos").cast("long").alias("pos"), "arthro", "titlos", "meros", "meros_titlos", "kefalaio", "kefalaio_titlos", F.col("seq.par").cast("long").alias("n"), "paragrafos", "keimeno")


PARSED = PARSE_SQL + "SELECT law, CAST(pos AS BIGINT) AS pos, arthro, titlos, meros, meros_titlos, kefalaio, kefalaio_titlos, CAST(n AS BIGINT) AS n, paragrafos, keimeno FROM par"


def law_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Laws with all facts, one for each document, and what a run found of every third."""
    k, key = F.col("doc_id"), F.col("doc_id").cast("string")
    fek = F.when(k % 4 != 0, F.struct(F.when(k % 2 == 0, "A").otherwise("B").alias("teuxos"), (k + 1).cast("int").alias("arithmos"), F.date_add(F.lit("2000-01-01").cast("date"), (k % 5000).cast("int")).alias("imerominia")))
    rows = table(spark, sf_dir, "documents").where("text is not null").select(
        F.concat(F.lit("l"), key).alias("id"),
        F.concat(F.lit("Τίτλος "), key).alias("titlos"),
        F.when(k % 3 == 0, "").when(k % 3 == 1, F.concat(F.lit("Σύντομος "), key)).alias("syntomos_titlos"),
        F.when(k % 5 == 0, "odigia_ee").otherwise("nomos").alias("typos"),
        (k + 1).cast("string").alias("arithmos"),
        (k % 30 + 1990).cast("int").alias("etos"),
        fek.alias("fek"),
        F.when(k % 5 == 0, F.concat(F.lit("3"), key)).alias("celex"),
        F.col("source").alias("thematiki"),
        F.when(k % 7 == 0, "istoriko").otherwise("isxyon").alias("katastasi"),
        F.when(k % 6 != 0, F.date_add(F.lit("2001-02-03").cast("date"), (k % 900).cast("int"))).alias("isxys_apo"),
        (k % 2 == 0).alias("epalithevmeno"),
        F.concat(F.lit("  Περιγραφή "), key, F.lit(" ")).alias("perigrafi"),
        F.when(k % 11 == 0, F.concat(F.lit("Προσοχή στο "), key)).alias("prosochi"),
        F.when(k % 13 == 0, F.lit(" σημείωση ")).alias("simeioseis"),
        F.concat(F.lit("u"), key).alias("pigi_url"),
        F.sha2(F.encode(key, "UTF-8"), 256).alias("checksum_pigis"),
        (k % 100).cast("int").alias("plithos_arthron"),
        (k % 1000).cast("int").alias("plithos_paragrafon"),
        F.lit("2025-01-01").alias("anaktithike"),
    )
    found = rows.where(F.substring("id", 2, 20).cast("long") % 3 == 0).select("id", (~F.col("epalithevmeno")).alias("epalithevmeno"))
    return rows, found


LAWS_SQL = """
m AS (SELECT ['Ιανουαρίου','Φεβρουαρίου','Μαρτίου','Απριλίου','Μαΐου','Ιουνίου','Ιουλίου','Αυγούστου','Σεπτεμβρίου','Οκτωβρίου','Νοεμβρίου','Δεκεμβρίου'] AS month),
k AS (SELECT doc_id AS k, source, DATE '2000-01-01' + CAST(doc_id % 5000 AS INT) AS day, CASE WHEN doc_id % 6 != 0 THEN DATE '2001-02-03' + CAST(doc_id % 900 AS INT) END AS force FROM documents WHERE text IS NOT NULL),
laws AS (SELECT k, 'l' || k AS id, CASE WHEN k % 5 = 0 THEN 'Οδηγία ' || (k + 1) ELSE 'Ν. ' || (k + 1) || '/' || (k % 30 + 1990) END AS onoma, 'Τίτλος ' || k AS titlos, CASE WHEN k % 5 = 0 THEN 'odigia_ee' ELSE 'nomos' END AS typos, source AS thematiki,
    CASE WHEN k % 4 != 0 THEN CASE WHEN k % 2 = 0 THEN 'Α' ELSE 'Β' END || '΄' || (k + 1) || '/' || strftime(day, '%d-%m-%Y') END AS fek,
    CASE WHEN k % 4 != 0 THEN year(day) || CASE WHEN k % 2 = 0 THEN '01' ELSE '02' END || CASE WHEN length(CAST(k + 1 AS VARCHAR)) < 5 THEN lpad(CAST(k + 1 AS VARCHAR), 5, '0') ELSE CAST(k + 1 AS VARCHAR) END END AS fek_pdf_id,
    CASE WHEN k % 5 = 0 THEN '3' || k END AS celex, CASE WHEN k % 7 = 0 THEN 'istoriko' ELSE 'isxyon' END AS katastasi, CAST(force AS VARCHAR) AS isxys_apo, (k % 2 = 0) != (k % 3 = 0) AS epalithevmeno, 'u' || k AS pigi_url,
    CASE WHEN k % 5 = 0 THEN 'Οδηγία της Ευρωπαϊκής Ένωσης ' || (k + 1) ELSE 'Νόμος ' || (k + 1) || ' του ' || (k % 30 + 1990) END || CASE WHEN k % 4 != 0 THEN '. ΦΕΚ τεύχος ' || CASE WHEN k % 2 = 0 THEN 'Άλφα' ELSE 'Βήτα' END || ', αριθμός ' || (k + 1) || ', ' || day(day) || ' ' || month[month(day)] || ' ' || year(day) ELSE '' END
        || CASE WHEN force IS NOT NULL THEN '. Ισχύει από ' || day(force) || ' ' || month[month(force)] || ' ' || year(force) ELSE '' END || '.' AS identity FROM k, m)
"""


def law_facts(spark, sf_dir):
    return records.law_meta(*law_rows(spark, sf_dir))


LAW_FACTS = "WITH " + LAWS_SQL + """
SELECT id, onoma, titlos, typos, thematiki, fek, fek_pdf_id, celex, katastasi, isxys_apo, epalithevmeno, pigi_url, sha256(CAST(k AS VARCHAR)) AS checksum_pigis, k % 100 AS plithos_arthron, k % 1000 AS plithos_paragrafon, '2025-01-01' AS anaktithike FROM laws
"""


def law_labels(spark, sf_dir):
    laws, _ = law_rows(spark, sf_dir)
    fek = F.col("fek")
    onoma = names.display_name(F.col("typos"), F.col("arithmos"), F.col("etos"))
    return laws.select("id", names.label(F.col("syntomos_titlos"), onoma).alias("label"), names.identity(F.col("typos"), F.col("arithmos"), F.col("etos"), fek["teuxos"], fek["arithmos"], fek["imerominia"], F.col("isxys_apo")).alias("identity"))


LAW_LABELS = "WITH " + LAWS_SQL + "SELECT id, CASE WHEN k % 3 = 1 THEN 'Σύντομος ' || k ELSE onoma END AS label, identity FROM laws"


def paragraph_rows(spark, sf_dir):
    rows = records.paragraph_records(hard_articles(spark, sf_dir), *law_rows(spark, sf_dir))
    return rows


PARAGRAPH_ROWS = PARSE_SQL + ", " + LAWS_SQL + """
, base AS (SELECT *, law || ':art-' || arthro || CASE WHEN paragrafos != '' THEN ':par-' || paragrafos ELSE '' END AS base_id FROM par),
nth AS (SELECT *, row_number() OVER (PARTITION BY law, base_id ORDER BY pos, n) AS times FROM base)
SELECT base_id || CASE WHEN times > 1 THEN '-' || times ELSE '' END AS id, law AS nomothetima_id, onoma AS nomothetima, l.titlos AS titlos_nomothetimatos, thematiki, arthro, n.titlos AS titlos_arthrou, paragrafos, meros, meros_titlos, kefalaio, kefalaio_titlos, keimeno,
    fek, celex, isxys_apo, katastasi, epalithevmeno, pigi_url, '2025-01-01' AS anaktithike FROM nth n JOIN laws l ON l.id = n.law
"""


def whole_documents(spark, sf_dir):
    """The whole Markdown text of each law, header, warnings and articles."""
    out = records.full_markdown(hard_articles(spark, sf_dir), *law_rows(spark, sf_dir))
    return out.select("law", F.sha2(F.encode("document", "UTF-8"), 256).alias("document_sha256"), F.char_length("document").cast("long").alias("characters"))


WHOLE = PARSE_SQL + ", " + LAWS_SQL + """
, once AS (SELECT law, pos, any_value(arthro) AS arthro, any_value(titlos) AS titlos, any_value(meros) AS meros, any_value(meros_titlos) AS meros_titlos, any_value(kefalaio) AS kefalaio, any_value(kefalaio_titlos) AS kefalaio_titlos,
    string_agg(CASE WHEN paragrafos != '' THEN paragrafos || '. ' ELSE '' END || keimeno || chr(10), chr(10) ORDER BY n) AS body FROM par GROUP BY law, pos),
changed AS (SELECT *, meros || '|' || meros_titlos IS DISTINCT FROM lag(meros || '|' || meros_titlos) OVER w AS new_part, kefalaio || '|' || kefalaio_titlos IS DISTINCT FROM lag(kefalaio || '|' || kefalaio_titlos) OVER w AS new_chapter FROM once WINDOW w AS (PARTITION BY law ORDER BY pos)),
arts_text AS (SELECT law, string_agg(CASE WHEN new_part AND meros IS NOT NULL THEN '## ΜΕΡΟΣ ' || meros || CASE WHEN meros_titlos != '' THEN '΄ ' || meros_titlos ELSE '' END || chr(10) || chr(10) ELSE '' END
    || CASE WHEN new_chapter AND kefalaio IS NOT NULL THEN '### ΚΕΦΑΛΑΙΟ ' || kefalaio || CASE WHEN kefalaio_titlos != '' THEN '΄ ' || kefalaio_titlos ELSE '' END || chr(10) || chr(10) ELSE '' END
    || '#### Άρθρο ' || arthro || CASE WHEN titlos != '' THEN ' — ' || titlos ELSE '' END || chr(10) || chr(10) || body, chr(10) ORDER BY pos) AS t FROM changed GROUP BY law),
fact AS (SELECT l.*, replace('# ' || onoma || ' — ' || titlos || '@@| Πεδίο | Τιμή |@| --- | --- |@| Αναγνωριστικό | `' || id || '` |@| Τύπος | ' || typos || ' |@' || CASE WHEN fek IS NOT NULL THEN '| ΦΕΚ | ' || fek || ' |@' ELSE '' END
    || CASE WHEN celex IS NOT NULL THEN '| CELEX | ' || celex || ' |@' ELSE '' END || CASE WHEN isxys_apo IS NOT NULL THEN '| Ισχύς από | ' || strftime(CAST(isxys_apo AS DATE), '%d-%m-%Y') || ' |@' ELSE '' END
    || '| Κατάσταση | ' || katastasi || ' |@| Επαληθευμένο ΦΕΚ | ' || CASE WHEN epalithevmeno THEN 'ναι' ELSE 'όχι' END || ' |@@> Περιγραφή ' || k || '@@'
    || CASE WHEN katastasi != 'isxyon' THEN '> [!WARNING]@> **Δεν αποτελεί ισχύον δίκαιο.** Διατηρείται για ιστορικούς ή μεταβατικούς λόγους.@@' ELSE '' END
    || CASE WHEN NOT epalithevmeno THEN '> [!CAUTION]@> Τα στοιχεία ΦΕΚ δεν έχουν ακόμη αντιπαραβληθεί με το επίσημο αρχείο του Εθνικού Τυπογραφείου.@@' ELSE '' END
    || CASE WHEN k % 13 = 0 THEN '**Σημειώσεις:** σημείωση@@' ELSE '' END || '---@@', '@', chr(10)) AS header FROM laws l),
doc AS (SELECT id AS law, regexp_replace(header || coalesce(t, ''), '\\s+$', '') || chr(10) AS d FROM fact LEFT JOIN arts_text ON law = id)
SELECT law, sha256(d) AS document_sha256, length(d) AS characters FROM doc
"""


def spoken_laws(spark, sf_dir):
    """The document of each law in force as it is read aloud."""
    laws, _ = law_rows(spark, sf_dir)
    out = records.spoken_export(records.flatten(hard_articles(spark, sf_dir)), laws)
    return out.select("law", F.sha2(F.encode("document", "UTF-8"), 256).alias("document_sha256"), F.col("articles").cast("long").alias("articles"), "characters")


SPOKEN_LAWS = PARSE_SQL + ", " + LAWS_SQL + r"""
, say AS (SELECT *, regexp_replace(trim(regexp_replace(replace(replace(regexp_replace(keimeno, '\b(\d{1,5})/((?:19|20)\d{2})\b', '\1 του \2', 'g'), '%', ' τοις εκατό'), '€', ' ευρώ'), '[ \t]{2,}', ' ', 'g')), '^\s+|\s+$', '', 'g') AS said FROM par),
once AS (SELECT law, pos, any_value(arthro) AS arthro, any_value(titlos) AS titlos, any_value(meros_titlos) AS mt, any_value(kefalaio_titlos) AS kt, string_agg(CASE WHEN paragrafos != '' THEN 'Παράγραφος ' || paragrafos || '. ' ELSE '' END || said || chr(10), chr(10) ORDER BY n) AS body FROM say GROUP BY law, pos),
blocks AS (SELECT law, pos, '## ' || CASE WHEN k % 3 = 1 THEN 'Σύντομος ' || k ELSE replace(onoma, '/', ' του ') END || ' — Άρθρο ' || arthro || CASE WHEN o.titlos != '' THEN ': ' || o.titlos ELSE '' END || chr(10) || chr(10) || identity || chr(10)
    || CASE WHEN coalesce(mt, '') || coalesce(kt, '') != '' THEN coalesce(mt, '') || CASE WHEN coalesce(mt, '') != '' AND coalesce(kt, '') != '' THEN ' — ' ELSE '' END || coalesce(kt, '') || chr(10) ELSE '' END || chr(10) || body AS block
    FROM once o JOIN laws l ON l.id = o.law WHERE katastasi = 'isxyon'),
docs AS (SELECT law, count(*) AS articles, string_agg(block, chr(10) ORDER BY pos) AS t FROM blocks GROUP BY law),
whole AS (SELECT law, articles, regexp_replace('# ' || titlos || chr(10) || chr(10) || identity || chr(10) || chr(10) || 'Περιγραφή ' || k || chr(10) || chr(10) || CASE WHEN k % 11 = 0 THEN '## Προσοχή' || chr(10) || chr(10) || 'Προσοχή στο ' || k || chr(10) || chr(10) ELSE '' END || t, '\s+$', '') || chr(10) AS d FROM docs JOIN laws ON id = law)
SELECT law, sha256(d) AS document_sha256, articles, length(d) AS characters FROM whole
"""

QUERIES = {
    "spoken_laws": (spoken_laws, SPOKEN_LAWS),
    "parsed_laws": (parsed_laws, PARSED),
    "law_facts": (law_facts, LAW_FACTS),
    "law_labels": (law_labels, LAW_LABELS),
    "paragraph_rows": (paragraph_rows, PARAGRAPH_ROWS),
    "whole_documents": (whole_documents, WHOLE),
}
