"""Queries of whole runs: laws made from documents go through fallback, parsing, supplements and manifest, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexicord.operators import changes
from lexicord.plans import pipelines
from lexicord.plans.text_queries import table
from lexicord.sources.cache import ResponseCache
from lexicord.sources.lawfiles import folder_of, json_text, read_files, write_files
from lexicord.sources.tables import new_folder
from lexicord.streaming.incremental import manifest_table

FEK = "struct<teuxos:string,arithmos:int,imerominia:date>"


def page(text: Column, first: int, top: Column, more: Column) -> Column:
    """A web page whose articles are the text's lines, numbered from `first` + 1."""
    safe = F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    article = lambda x, i: F.concat(F.lit("<h2>Άρθρο "), (i + first + 1).cast("string"), F.lit("</h2><p>Τίτλος</p><p>1. "), x, F.lit(" .</p>"))
    return F.concat(F.lit("<html><body><nav>Άρθρο 7</nav><main>"), top, F.array_join(F.transform(F.split(safe, "\n"), article), ""), more, F.lit("</main></body></html>"))


def sourced_laws(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(laws, files): each law's sources fail in ways that its number sets."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    k, key = F.col("doc_id"), F.col("doc_id").cast("string")
    source = lambda kind, name: F.struct(F.lit(kind).alias("typos"), F.concat(F.lit(name), key).alias("url"))
    usual = F.array(source("kodikopoiimeno_html", "h"), source("topiko_fek", "t"), source("fek_pdf", "f"))
    more = F.array(source("sympliroma", "s1-"), source("sympliroma", "s2-"), source("sympliroma", "s3-"))
    piges = F.when(k % 50 == 7, more).when(k % 50 == 8, F.array(source("fek_pdf", "f"))).when(k % 9 == 2, F.concat(F.slice(more, 1, 1), usual, F.slice(more, 2, 2))).otherwise(usual)
    fek = F.when((k % 4).isin(0, 1), F.from_json(F.lit('{"teuxos":"A","arithmos":7654321,"imerominia":"1911-06-13"}'), FEK))
    wanted = F.when(k % 6 == 3, F.array(F.lit(1), F.lit(2), F.lit(3))).otherwise(F.array().cast("array<int>"))
    laws = docs.select(k.alias("id"), F.lit("nomos").alias("typos"), fek.alias("fek"), wanted.alias("relevanta_arthra"), piges.alias("piges"))

    top = F.when(k % 4 == 1, "<p>Τεύχος Α΄7654321/13.06.1911</p>").otherwise("")
    again = F.when(k % 8 == 4, "<h2>Άρθρο 1</h2><p>Ξανά</p>").otherwise("")
    good, other = page(F.col("text"), 0, top, again), page(F.col("text"), 500, F.lit(""), F.lit(""))
    blank, plain = F.lit("<html><body> <script>x</script> </body></html>"), F.concat(F.lit("<html><body><p>Κείμενο "), F.replace(F.col("text"), F.lit("<"), F.lit("&lt;")), F.lit("</p></body></html>"))
    broken = F.lit(bytearray(b"\xd0\xcf\x11\xe0xx"))
    as_bytes = lambda c: F.encode(c, "UTF-8")
    f = F.when(k % 6 == 1, as_bytes(blank)).when(k % 6 == 2, as_bytes(plain)).when(k % 6 == 3, as_bytes(other)).when(k % 6 == 4, as_bytes(good)).when(k % 6 == 5, broken)
    t = F.when(k % 5 == 0, as_bytes(good)).when(k % 5 == 2, as_bytes(blank)).when(k % 5 == 3, as_bytes(plain)).when(k % 5 == 4, broken)
    h = F.when(k % 7 == 0, as_bytes(plain)).otherwise(as_bytes(good))
    one = F.lit("Άρθρο 2\nΤίτλος\n1. Ένα.\nΆρθρο 900\nΤίτλος\n1. Δύο.\nΆρθρο 900\nΤίτλος\n1. Τρία.")
    two = F.lit("Άρθρο 900\nΤίτλος\n1. Όχι.\nΆρθρο 901\nΤίτλος\n1. Ναι.")
    file = lambda name, body, kind: F.struct(F.concat(F.lit(name), key).alias("url"), body.alias("content"), F.lit(kind).alias("content_type"))
    all_files = F.array(file("f", f, "text/html"), file("t", t, ""), file("h", h, "text/html"), file("s1-", as_bytes(one), ""), file("s2-", as_bytes(two), ""))
    return laws, docs.select(F.explode(all_files).alias("x")).select("x.*").where("content is not null")


def built_laws(spark, sf_dir):
    laws, files = sourced_laws(spark, sf_dir)
    run = pipelines.built(laws, files)
    rows = run.told.join(run.manifest, "id", "left")
    return rows.select("id", "pigi_url", "plithos_arthron", "plithos_paragrafon", "epalithevmeno_fek", "checksum_pigis", F.array_join("proeidopoiiseis", " | ").alias("notices"), "error")


BUILT = r"""
WITH d AS (SELECT doc_id AS k, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
s AS (SELECT k, text, len(l) AS n, k % 50 = 7 AS no_source, k % 50 = 8 AS one_source, k % 9 = 2 AND k % 50 NOT IN (7, 8) AS more,
    replace(text, '<', '&lt;') AS safe, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS safer,
    CASE k % 6 WHEN 0 THEN 'absent' WHEN 1 THEN 'blank' WHEN 2 THEN 'plain' WHEN 3 THEN 'plain' WHEN 4 THEN 'good' ELSE 'broken' END AS f,
    CASE k % 5 WHEN 0 THEN 'good' WHEN 1 THEN 'absent' WHEN 2 THEN 'blank' WHEN 3 THEN 'plain' ELSE 'broken' END AS t,
    CASE k % 7 WHEN 0 THEN 'plain' ELSE 'good' END AS h FROM d),
w AS (SELECT *, CASE WHEN no_source THEN NULL WHEN f = 'good' THEN 'f' WHEN one_source THEN NULL WHEN t = 'good' THEN 't' WHEN h = 'good' THEN 'h' END AS won FROM s),
page AS (SELECT k, '<html><body><nav>Άρθρο 7</nav><main>' || CASE WHEN k % 4 = 1 THEN '<p>Τεύχος Α΄7654321/13.06.1911</p>' ELSE '' END
    || (SELECT string_agg('<h2>Άρθρο ' || i || '</h2><p>Τίτλος</p><p>1. ' || x || ' .</p>', '' ORDER BY i) FROM (SELECT unnest(string_split(safer, chr(10))) AS x, unnest(generate_series(1, n)) AS i))
    || CASE WHEN k % 8 = 4 THEN '<h2>Άρθρο 1</h2><p>Ξανά</p>' ELSE '' END || '</main></body></html>' AS html FROM w WHERE won IS NOT NULL),
m AS (SELECT *, CASE WHEN k % 6 = 3 THEN least(n, 3) ELSE n END AS base, CASE WHEN more AND won IS NOT NULL THEN CASE WHEN n < 2 THEN ['2', '900', '900', '901'] ELSE ['900', '900', '901'] END ELSE [] END AS added FROM w),
said AS (SELECT *,
    CASE f WHEN 'absent' THEN 'το αρχείο f' || k || ' δεν υπάρχει' WHEN 'blank' THEN 'δεν εξήχθη καθόλου κείμενο από f' || k || ' (46 bytes, text/html)' WHEN 'broken' THEN 'BadFile: no compound file'
        ELSE 'δεν εντοπίστηκε κανένα άρθρο. Πιθανή αιτία: αλλαγή διάταξης στην πηγή ή λάθος URL.' END AS fm,
    CASE t WHEN 'absent' THEN 'το αρχείο t' || k || ' δεν υπάρχει' WHEN 'blank' THEN 'δεν εξήχθη καθόλου κείμενο από t' || k || ' (46 bytes, άγνωστος τύπος)' WHEN 'broken' THEN 'BadFile: no compound file'
        ELSE 'δεν εντοπίστηκε κανένα άρθρο. Πιθανή αιτία: αλλαγή διάταξης στην πηγή ή λάθος URL.' END AS tm FROM m)
SELECT k AS id, won || k AS pigi_url, CASE WHEN won IS NOT NULL THEN base + len(added) END AS plithos_arthron, CASE WHEN won IS NOT NULL THEN base + len(added) END AS plithos_paragrafon,
    CASE WHEN won IS NOT NULL THEN k % 4 = 1 END AS epalithevmeno_fek, sha256(html) AS checksum_pigis,
    CASE WHEN won IS NULL THEN '' ELSE array_to_string(list_filter([
        CASE won WHEN 't' THEN 'το et.gr δεν απάντησε — το κείμενο προέρχεται από το αντίγραφο ΦΕΚ του repository (t' || k || '), που είναι το ίδιο έγγραφο'
            WHEN 'h' THEN 'η προτιμώμενη πηγή απέτυχε — το κείμενο προέρχεται από kodikopoiimeno_html (h' || k || ')' END,
        CASE WHEN k % 4 = 0 THEN 'τα στοιχεία ΦΕΚ δεν εντοπίστηκαν στην αρχή του κειμένου — ελέγξτε το pdf_id στο registry.yaml' END,
        CASE WHEN k % 8 = 4 THEN 'η πηγή γράφει δύο φορές τα άρθρα 1 — κρατήθηκε η πρώτη γραφή' END,
        CASE WHEN more THEN 'το συμπλήρωμα s3-' || k || ' δεν διαβάστηκε: το αρχείο s3-' || k || ' δεν υπάρχει' END,
        CASE WHEN more THEN 'άρθρα από συμπλήρωμα, όχι από την κύρια πηγή: ' || array_to_string(added, ', ') END], lambda x: x IS NOT NULL), ' | ') END AS notices,
    CASE WHEN won IS NOT NULL THEN NULL WHEN no_source THEN k || ': καμία διαθέσιμη πηγή' WHEN one_source THEN k || ': ' || fm
        ELSE k || ': καμία από τις 3 πηγές δεν απέδωσε κείμενο — fek_pdf: ' || fm || '; topiko_fek: ' || tm || '; kodikopoiimeno_html: δεν εντοπίστηκε κανένα άρθρο. Πιθανή αιτία: αλλαγή διάταξης στην πηγή ή λάθος URL.' END AS error
FROM said LEFT JOIN page USING (k)
"""


def cache_states(spark, sf_dir):
    """The response cache after each of two runs whose answers change."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("http://h/"), F.col("page_id").cast("string")).alias("url"), F.encode("html", "UTF-8").alias("html"))
    k, none = F.col("page_id"), F.lit(None).cast("string")
    tag = F.concat(F.lit("e"), F.octet_length("html").cast("string"))
    first = pages.select("url", F.lit(0).alias("attempt"), F.when(k % 4 == 3, 503).otherwise(200).alias("status"), tag.alias("etag"), F.lit("Mon").alias("last_modified"), F.lit("text/html").alias("content_type"), F.col("html").alias("content"), none.alias("error"))
    asked = pages.select("url", F.lit(0).alias("attempt"), F.lit(429).alias("status"), none.alias("etag"), none.alias("last_modified"), none.alias("content_type"), F.lit(None).cast("binary").alias("content"), F.when(k % 5 == 0, "timeout").alias("error"))
    status = F.when(k % 3 == 0, 304).when(k % 3 == 1, 200).otherwise(404)
    body = F.when(k % 3 == 1, F.concat("html", F.encode(F.lit("2"), "UTF-8")))
    again = asked.unionByName(pages.select("url", F.lit(1).alias("attempt"), status.alias("status"), none.alias("etag"), F.lit("Tue").alias("last_modified"), F.lit("text/plain").alias("content_type"), body.alias("content"), none.alias("error")))
    store = ResponseCache(spark, new_folder(spark), buckets=8)
    store.store(first, 1)
    store.store(again, 2)
    store.store(first, 2)  # a version that exists is not written again
    states = [store.read(v).withColumn("run", F.lit(v).cast("long")) for v in (1, 2)]
    return states[0].unionByName(states[1]).select("run", "key", "url", "etag", "last_modified", "content_type", F.sha2("content", 256).alias("content_sha256"))


CACHE = """
WITH p AS (SELECT page_id AS k, 'http://h/' || page_id AS url, html FROM pages),
one AS (SELECT k, url, 'e' || strlen(html) AS etag, 'Mon' AS last_modified, 'text/html' AS content_type, sha256(html) AS content_sha256 FROM p WHERE k % 4 != 3),
two AS (SELECT k, url, '' AS etag, 'Tue' AS last_modified, 'text/plain' AS content_type, sha256(html || '2') AS content_sha256 FROM p WHERE k % 3 = 1),
s AS (SELECT 1 AS run, * FROM one UNION ALL SELECT 2, * FROM one WHERE k % 3 != 1 UNION ALL SELECT 2, * FROM two)
SELECT CAST(run AS BIGINT) AS run, left(sha256(url), 24) AS key, url, etag, last_modified, content_type, content_sha256 FROM s
"""


def merged_manifest(spark, sf_dir):
    """A manifest of all documents, and a small batch merged into the buckets that it hits."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    entry = lambda rows: rows.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), F.sha2(F.encode("text", "UTF-8"), 256).alias("checksum_keimenou"))
    state = manifest_table(spark, new_folder(spark), buckets=32)
    state.merge(entry(docs), 0, changes.upsert)
    batch = docs.where("doc_id % 97 = 0").withColumn("text", F.concat("text", F.lit("!"))).unionByName(docs.where("doc_id % 101 = 0").withColumn("doc_id", -F.col("doc_id") - 1))
    state.merge(entry(batch), 1, changes.upsert)
    state.merge(entry(docs), 1, changes.upsert)  # the batch's number again: nothing changes
    state.clean(keep=1)
    return state.read()


MERGED = """
SELECT 'd' || doc_id AS id, sha256(coalesce(text, '') || CASE WHEN doc_id % 97 = 0 THEN '!' ELSE '' END) AS checksum_keimenou FROM documents
UNION ALL SELECT 'd' || (-doc_id - 1), sha256(coalesce(text, '')) FROM documents WHERE doc_id % 101 = 0
"""


def law_file_texts(spark, sf_dir):
    """Files under their own names, written and read again with some addresses that name none."""
    root = new_folder(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.split(F.coalesce("text", F.lit("")), "\n").alias("lines"))
    place = folder_of(F.col("source"), F.col("doc_id"))
    lines = docs.select(F.concat(place, F.lit("/full.md")).alias("path"), F.posexplode("lines").alias("seq", "line")).select("path", "seq", F.concat("line", F.lit("\n")).alias("text"))
    facts = docs.select("doc_id", "source", F.size("lines").alias("plithos_paragrafon"), F.lit(None).cast("string").alias("celex"))
    meta = facts.select(F.concat(folder_of(F.col("source"), F.col("doc_id")), F.lit("/meta.json")).alias("path"), F.lit(0).alias("seq"), F.concat(json_text(["doc_id", "source", "plithos_paragrafon", "celex"], ",\n  ", "\n  ", "\n"), F.lit("\n")).alias("text"))
    names = docs.select(F.concat(F.lit("file:"), place, F.lit("/full.md\nfile:/"), place, F.lit("/meta.json\n"), F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("file:"), place, F.lit("/none.pdf\n"))).otherwise("")).alias("text"))
    write_files(lines.unionByName(meta), root)
    names.write.text(f"{root}/addresses")
    read = read_files(spark, root, listed="addresses")
    return read.select("url", "content_type", F.sha2("content", 256).alias("content_sha256"), F.col("error").isNotNull().alias("failed"))


LAW_FILES = """
WITH d AS (SELECT doc_id, source || '/' || doc_id AS place, source, coalesce(text, '') AS t FROM documents)
SELECT 'file:' || place || '/full.md' AS url, 'text/html' AS content_type, sha256(t || chr(10)) AS content_sha256, false AS failed FROM d
UNION ALL SELECT 'file:/' || place || '/meta.json', 'text/html', sha256(format('{{\n  "doc_id": {},\n  "source": "{}",\n  "plithos_paragrafon": {},\n  "celex": null\n}}\n', doc_id, source, len(string_split(t, chr(10))))), false FROM d
UNION ALL SELECT 'file:' || place || '/none.pdf', 'application/pdf', NULL, true FROM d WHERE doc_id % 10 = 0
""".replace("\\n", "\n")

QUERIES = {
    "built_laws": (built_laws, BUILT),
    "cache_states": (cache_states, CACHE),
    "merged_manifest": (merged_manifest, MERGED),
    "law_file_texts": (law_file_texts, LAW_FILES),
}
