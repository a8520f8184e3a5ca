"""Queries of the relational operators, each with the DuckDB SQL that computes the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexicord.operators import changes, fallback, links, records, registry
from lexicord.plans.pipelines import discovered
from lexicord.plans.text_queries import table


def runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two manifests: documents but every seventh, and documents from the tenth on, every fourth text edited."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "n_chars")
    old = docs.where("id % 7 != 0").select("id", F.sha2(F.encode("text", "UTF-8"), 256).alias("checksum_keimenou"), "n_chars")
    edited = F.concat("text", F.when(F.col("id") % 4 == 0, "!").otherwise(""))
    new = docs.where("id >= 10").select("id", F.when(F.col("id") % 11 != 0, F.sha2(F.encode(edited, "UTF-8"), 256)).alias("checksum_keimenou"), (F.col("n_chars") + F.col("id") % 4).alias("n_chars"))
    return old, new


RUNS_SQL = """
WITH old AS (SELECT doc_id AS id, sha256(text) AS c, n_chars FROM documents WHERE doc_id % 7 != 0),
new AS (SELECT doc_id AS id, CASE WHEN doc_id % 11 != 0 THEN sha256(text || CASE WHEN doc_id % 4 = 0 THEN '!' ELSE '' END) END AS c, n_chars + doc_id % 4 AS n_chars FROM documents WHERE doc_id >= 10),
diff AS (SELECT id, CASE WHEN o.id IS NULL THEN 'νέο' WHEN n.id IS NULL THEN 'απόν' WHEN o.c IS NOT DISTINCT FROM n.c THEN 'αμετάβλητο' ELSE 'τροποποιημένο' END AS kind, o.c AS old, n.c AS new FROM old o FULL JOIN new n USING (id))
"""


def manifest_diff(spark, sf_dir):
    return changes.diff(*runs(spark, sf_dir))


def material_changes(spark, sf_dir):
    return changes.material(changes.diff(*runs(spark, sf_dir))).groupBy("kind").agg(F.count("*").alias("laws"))


def manifest_upsert(spark, sf_dir):
    return changes.upsert(*runs(spark, sf_dir))


UPSERT = RUNS_SQL + "SELECT id, c AS checksum_keimenou, n_chars FROM new UNION ALL SELECT id, c, n_chars FROM old WHERE id NOT IN (SELECT id FROM new)"


def coverage(spark, sf_dir):
    old, new = runs(spark, sf_dir)
    return changes.missing(new, old).select("id", F.lit("missing").alias("side")).unionByName(changes.missing(old, new).select("id", F.lit("orphan").alias("side")))


COVERAGE = RUNS_SQL + "SELECT id, 'missing' AS side FROM new WHERE id NOT IN (SELECT id FROM old) UNION ALL SELECT id, 'orphan' FROM old WHERE id NOT IN (SELECT id FROM new)"


def status_report(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    entries = labels.select(F.col("doc_id").alias("id"), F.when(F.col("toxic") == 0, F.col("quality") + 3).alias("plithos_arthron"))
    return changes.status(docs.select(F.col("doc_id").alias("id")), entries, docs.where("doc_id % 5 != 0").select(F.col("doc_id").alias("id")))


STATUS = """
SELECT d.doc_id AS id, d.doc_id % 5 != 0 AS present, CASE WHEN l.doc_id IS NOT NULL AND d.doc_id % 5 != 0 THEN coalesce(CAST(CASE WHEN toxic = 0 THEN quality + 3 END AS VARCHAR), '?') ELSE '' END AS articles
FROM documents d LEFT JOIN labels l USING (doc_id)
"""


def adjacent_groups(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("at", F.struct("ts", "event_id"))
    rows = records.adjacent_groups(events, "user_id", "event_type", "at")
    return rows.groupBy("user_id", "run").agg(F.first("event_type").alias("event_type"), F.count("*").alias("n"), F.min("event_id").alias("first_event"))


ADJACENT = """
WITH a AS (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w OR lag(1) OVER w IS NULL THEN 1 ELSE 0 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
b AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM a)
SELECT user_id, CAST(run AS BIGINT) AS run, min(event_type) AS event_type, count(*) AS n, min(event_id) AS first_event FROM b GROUP BY user_id, run
"""


def heading_changes(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("at", F.struct("ts", "event_id"))
    rows = records.changed(events, "user_id", "at", F.when(F.col("event_type") != "error", F.col("event_type")), "changed")
    return rows.groupBy("user_id").agg(F.count_if("changed").alias("changes"), F.count("*").alias("events"))


HEADINGS = """
WITH a AS (SELECT user_id, nullif(event_type, 'error') IS DISTINCT FROM lag(nullif(event_type, 'error')) OVER w OR lag(1) OVER w IS NULL AS changed FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, count(*) FILTER (changed) AS changes, count(*) AS events FROM a GROUP BY user_id
"""


def first_success_source(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    told = fallback.first_success(rows, "l_orderkey", "l_linenumber", F.col("l_returnflag") == "N")
    return told.select("l_orderkey", F.col("winner").cast("long").alias("winner"), F.array_join("failures", ",").alias("failures"))


FIRST_SUCCESS = """
WITH w AS (SELECT l_orderkey, min(l_linenumber) FILTER (l_returnflag = 'N') AS winner FROM lineitem GROUP BY ALL)
SELECT l_orderkey, CAST(winner AS BIGINT) AS winner, coalesce(string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) FILTER (l_returnflag != 'N' AND (winner IS NULL OR l_linenumber < winner)), '') AS failures
FROM lineitem JOIN w USING (l_orderkey) GROUP BY l_orderkey, winner
"""


def source_ranks(spark, sf_dir):
    kinds = F.array(*map(F.lit, ("fek_pdf", "topiko_fek", "kodikopoiimeno_html", "eurlex_html", "doc_alli_pigi", "sympliroma")))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.element_at(kinds, (F.col("l_partkey") % 6 + 1).cast("int")).alias("typos"))
    law = rows.groupBy(F.col("l_orderkey").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "typos"))), lambda x: F.struct(x["typos"].alias("typos"), x["l_linenumber"].cast("string").alias("url"))).alias("piges"))
    law = law.withColumn("typos", F.when(F.col("id") % 3 == 0, "odigia_ee").otherwise("nomos"))
    return fallback.ranked_sources(law).select("id", F.col("nth").cast("long").alias("nth"), "source_type", "url")


SOURCE_RANKS = """
WITH a AS (SELECT l_orderkey AS id, l_linenumber, (['fek_pdf', 'topiko_fek', 'kodikopoiimeno_html', 'eurlex_html', 'doc_alli_pigi', 'sympliroma'])[l_partkey % 6 + 1] AS t FROM lineitem),
b AS (SELECT *, CASE WHEN id % 3 = 0 THEN CASE WHEN t = 'eurlex_html' THEN 0 ELSE 999 END ELSE CASE t WHEN 'fek_pdf' THEN 0 WHEN 'topiko_fek' THEN 1 WHEN 'kodikopoiimeno_html' THEN 2 WHEN 'doc_alli_pigi' THEN 4 ELSE 999 END END AS r FROM a WHERE t != 'sympliroma')
SELECT id, row_number() OVER (PARTITION BY id ORDER BY r, l_linenumber, t) AS nth, t AS source_type, CAST(l_linenumber AS VARCHAR) AS url FROM b
"""


def retry_outcomes(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select((F.floor(F.col("event_id") / 5)).alias("url"), (F.col("event_id") % 5).alias("attempt"), "event_type", "value")
    status = F.when(F.col("event_type") == "view", 200).when(F.col("event_type") == "click", 503).when(F.col("event_type") == "error", 404).when(F.col("event_type") == "signup", 304)
    size = F.when(F.col("value") > 20, F.col("value")).otherwise(0)
    outcome = fallback.http_outcome(status, size, F.col("value") > 50, F.when(F.col("event_type") == "purchase", "timeout"))
    return fallback.final_outcome(rows.withColumn("outcome", outcome), "url", "attempt")


RETRIES = """
WITH a AS (SELECT event_id // 5 AS url, event_id % 5 AS attempt, CASE WHEN event_type = 'purchase' THEN 'retry_transport' WHEN event_type = 'signup' AND value > 50 THEN 'cached' WHEN event_type = 'click' THEN 'retry_busy'
    WHEN event_type = 'error' THEN 'failed' WHEN value <= 20 THEN 'retry_busy' ELSE 'done' END AS o FROM events WHERE event_id % 5 < 4),
e AS (SELECT url, min(attempt) FILTER (o NOT LIKE 'retry%') AS last FROM a GROUP BY url)
SELECT url, coalesce(max(CASE WHEN attempt = last THEN o END), 'failed') AS outcome, count(*) AS attempts,
    CAST(sum(CASE o WHEN 'retry_transport' THEN pow(2, attempt) WHEN 'retry_busy' THEN least(5 * pow(2, attempt), 60) ELSE 0 END) AS BIGINT) AS waited
FROM a JOIN e USING (url) WHERE last IS NULL OR attempt <= last GROUP BY url
"""


def laws_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as laws, some of them unsound."""
    key = F.col("c_custkey")
    fek = F.when(key % 4 != 0, F.struct(F.when(key % 50 == 1, "X").otherwise("A").alias("teuxos"), key.cast("int").alias("arithmos"), F.lit("2025-06-13").cast("date").alias("imerominia")))
    empty = F.array().cast("array<string>")
    edges = {r: empty for r in ("antikatastathike_apo", "tropopoieitai_apo", "kodikopoiei", "kodikopoiithike_apo", "ensomatothike_me")}
    edges |= {"antikathista": F.array(F.concat(F.lit("c"), (key + 7).cast("string"))), "tropopoiei": F.when(key % 9 == 0, F.array(F.lit("c1"), F.lit("none"))).otherwise(empty)}
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), key.cast("string")).alias("id"),
        F.when(key % 3 == 0, "odigia_ee").otherwise("nomos").alias("typos"),
        F.col("c_nationkey").cast("string").alias("arithmos"),
        fek.alias("fek"),
        F.when(key % 6 == 0, "3").alias("celex"),
        F.col("c_mktsegment").alias("thematiki"),
        (key % 4 + 1).cast("int").alias("proteraiotita"),
        F.when(key % 10 == 0, "istoriko").when(key % 77 == 0, "old").otherwise("isxyon").alias("katastasi"),
        (key % 2 == 0).alias("epalithevmeno"),
        F.struct(*[v.alias(k) for k, v in edges.items()]).alias("scheseis"),
        F.when(key % 20 == 0, F.array().cast("array<struct<typos:string,url:string>>")).otherwise(F.array(F.struct(F.when(key % 31 == 0, "fax").otherwise("fek_pdf").alias("typos"), F.lit("u").alias("url")))).alias("piges"),
    )


def registry_violations(spark, sf_dir):
    return registry.violations(laws_of_customers(spark, sf_dir))


VIOLATIONS = """
WITH k AS (SELECT c_custkey AS k, 'c' || c_custkey AS id FROM customer)
SELECT 'series' AS rule, id, 'X' AS detail FROM k WHERE k % 4 != 0 AND k % 50 = 1
UNION ALL SELECT 'eu_act_needs_celex', id, 'odigia_ee' FROM k WHERE k % 3 = 0 AND k % 6 != 0
UNION ALL SELECT 'act_needs_gazette', id, 'nomos' FROM k WHERE k % 3 != 0 AND k % 4 = 0
UNION ALL SELECT 'needs_source', id, '' FROM k WHERE k % 20 = 0
UNION ALL SELECT 'priority', id, '4' FROM k WHERE k % 4 = 3
UNION ALL SELECT 'status', id, 'old' FROM k WHERE k % 77 = 0 AND k % 10 != 0
UNION ALL SELECT 'source_type', id, '' FROM k WHERE k % 31 = 0 AND k % 20 != 0
UNION ALL SELECT 'relation_target', id, 'antikathista → c' || (k + 7) FROM k WHERE k + 7 NOT IN (SELECT k FROM k)
UNION ALL SELECT 'relation_target', id, 'tropopoiei → none' FROM k WHERE k % 9 = 0
"""


def relation_edges(spark, sf_dir):
    return registry.relations(laws_of_customers(spark, sf_dir)).groupBy("rel").agg(F.count("*").alias("edges"), F.count_distinct("dst").alias("targets"))


EDGES = """
SELECT 'antikathista' AS rel, count(*) AS edges, count(DISTINCT c_custkey) AS targets FROM customer
UNION ALL SELECT 'tropopoiei', 2 * count(*), CASE WHEN count(*) > 0 THEN 2 ELSE 0 END FROM customer WHERE c_custkey % 9 = 0
"""


def themes(spark, sf_dir):
    return registry.themes(laws_of_customers(spark, sf_dir))


def registry_report(spark, sf_dir):
    return registry.report(laws_of_customers(spark, sf_dir))


REPORT = "SELECT count(*) AS laws, count(*) FILTER (c_custkey % 2 != 0) AS unverified, count(*) FILTER (c_custkey % 10 = 0 OR c_custkey % 77 = 0) AS not_in_force, count(DISTINCT c_mktsegment) AS themes FROM customer"


def laws_by_priority(spark, sf_dir):
    rows = registry.by_priority(laws_of_customers(spark, sf_dir).where("katastasi = 'isxyon'"), most=2)
    return rows.select("id", "proteraiotita")


BY_PRIORITY = "SELECT 'c' || c_custkey AS id, CAST(c_custkey % 4 + 1 AS INTEGER) AS proteraiotita FROM customer WHERE c_custkey % 10 != 0 AND c_custkey % 77 != 0 AND c_custkey % 4 < 2"

LINKS_SQL = r"""
WITH a AS (SELECT page_id, url AS base, regexp_extract_all(html, '(?is)<a\s(?:[^>]*?\s)?href\s*=\s*"[^"]*"[^>]*>.*?</a>') AS m FROM pages),
b AS (SELECT page_id, base, i - 1 AS pos, m[i] AS t FROM a, unnest(generate_series(1, len(m))) AS u(i)),
c AS (SELECT page_id, base, pos, trim(replace(regexp_extract(t, 'href\s*=\s*"([^"]*)"', 1), '&amp;', '&')) AS href,
    trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_extract(t, '(?is)^<a\s[^>]*>(.*)</a>$', 1), '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM b),
d AS (SELECT page_id, pos, text, CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href WHEN href LIKE '//%' THEN regexp_extract(base, '^([a-z]+:)', 1) || href WHEN href LIKE '/%' THEN regexp_extract(base, '^[a-z]+://[^/?#]*') || href
    ELSE regexp_extract(base, '^[a-z]+://[^/?#]*') || regexp_replace(regexp_extract(base, '^[a-z]+://[^/?#]*([^?#]*)', 1), '[^/]*$', '') || href END AS url FROM c WHERE NOT regexp_matches(href, '^$|^#|^javascript:|^mailto:')),
links AS (SELECT page_id, min(pos) AS pos, arg_min(text, pos) AS text, url FROM d GROUP BY page_id, url)
"""


def page_links(spark, sf_dir):
    rows = links.links(table(spark, sf_dir, "pages"))
    return rows.select("page_id", F.col("pos").cast("long").alias("pos"), "text", "url")


def hard_page_links(spark, sf_dir):
    """Pages with comments, raw elements, nested anchors, odd entities and addresses put around their own text."""
    pages = table(spark, sf_dir, "pages")
    k = F.col("page_id").cast("string")
    html = F.concat(
        F.lit("<!-- <a href='c"), k, F.lit("'>no</a> --><script>\"<a href=s>no</a>\"</script><A CLASS='x>y' HREF='//h/a//b/../c"), k, F.lit("#'>&#1114112;&#38;lt;&copy;</A>"),
        F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("<a href=n"), k, F.lit(">out <i>er<a href='?p=1&amp;q=&#x41;&copy=2'>in&#128;ner</i></a>"))).otherwise(""),
        F.lit("<a name=z>none</a><title><a href=t>no</a></title>"), "html",
    )
    rows = links.links(pages.withColumn("html", html))
    return rows.select("page_id", F.col("pos").cast("long").alias("pos"), "text", "url")


def keyword_links(spark, sf_dir):
    return links.with_keywords(links.links(table(spark, sf_dir, "pages")), "THE, que,").groupBy("url").agg(F.count("*").alias("pages"))


# The put-in anchors stand before the page's own, whose places move; an address keeps its first place.
HARD = LINKS_SQL + """
, own AS (SELECT page_id, pos + CASE WHEN page_id % 2 = 0 THEN 4 ELSE 2 END AS pos, text, url FROM links),
put AS (
    SELECT page_id, 0 AS pos, chr(65533) || '&lt;©' AS text, regexp_extract(url, '^[a-z]+:') || '//h/a//b/../c' || page_id AS url FROM pages
    UNION ALL SELECT page_id, 1, 'out er', regexp_extract(url, '^[a-z]+://[^/?#]*') || regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '[^/]*$', '') || 'n' || page_id FROM pages WHERE page_id % 2 = 0
    UNION ALL SELECT page_id, 2, 'in€ner', regexp_extract(url, '^[^?#]*') || '?p=1&q=A&copy=2' FROM pages WHERE page_id % 2 = 0),
every AS (SELECT * FROM own UNION ALL SELECT * FROM put)
SELECT page_id, min(pos) AS pos, arg_min(text, pos) AS text, url FROM every GROUP BY page_id, url
"""

KEYWORDS = LINKS_SQL + "SELECT url, count(*) AS pages FROM links WHERE contains(lower(url), 'the') OR contains(lower(text), 'the') OR contains(lower(url), 'que') OR contains(lower(text), 'que') GROUP BY url"


def top_links(spark, sf_dir):
    rows = links.links(table(spark, sf_dir, "pages")).groupBy("text").agg(F.count("*").alias("n"))
    first, _ = links.top(rows.withColumn("minus", -F.col("n")), 20, "minus", "text")
    return first.select("text", "n")


TOP = LINKS_SQL + "SELECT text, count(*) AS n FROM links GROUP BY text ORDER BY n DESC, text LIMIT 20"


def titled_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of orders to laws: text names number and year, some repealed, some without a number."""
    key = F.col("o_orderkey")
    text = F.when(key % 13 == 0, "Χωρίς αριθμό").when(key % 17 == 0, F.concat(F.lit("Καταργημένος νόμος "), (key % 500).cast("string"), F.lit("/1995"))).otherwise(F.concat(F.lit("Νόμος "), (key % 500).cast("string"), F.lit(" / "), F.year("o_orderdate").cast("string")))
    return table(spark, sf_dir, "orders").select(key.alias("key"), text.alias("text"), F.concat(F.lit("u"), key.cast("string")).alias("url"))


def unknown_links(spark, sf_dir):
    laws = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 3 % 500).cast("string").alias("arithmos"), (F.lit(1992) + F.col("s_suppkey") % 7).alias("etos"))
    return links.unknown_laws(links.not_repealed(titled_links(spark, sf_dir)), laws, ["key"])


UNKNOWN = """
WITH known AS (SELECT s_suppkey * 3 % 500 AS a, 1992 + s_suppkey % 7 AS e FROM supplier)
SELECT o_orderkey AS key, CASE WHEN o_orderkey % 13 = 0 THEN 'Χωρίς αριθμό' ELSE 'Νόμος ' || (o_orderkey % 500) || ' / ' || year(o_orderdate) END AS text, 'u' || o_orderkey AS url
FROM orders WHERE o_orderkey % 13 = 0 OR (o_orderkey % 17 != 0 AND NOT EXISTS (FROM known WHERE a = o_orderkey % 500 AND e = year(o_orderdate)))
"""


def discovered_links(spark, sf_dir):
    laws = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("arithmos"), F.lit(2000).alias("etos"))
    return discovered(table(spark, sf_dir, "pages"), laws, "tion")


DISCOVERED = LINKS_SQL + "SELECT arg_min(text, (page_id, pos)) AS text, url FROM links WHERE contains(lower(url), 'tion') OR contains(lower(text), 'tion') GROUP BY url"


def paged_urls(spark, sf_dir):
    return links.paged_urls(table(spark, sf_dir, "pages").select("page_id", "url"), "url", 3).select("page_id", F.col("page").cast("long").alias("page"), "url")


PAGED = "SELECT page_id, p AS page, CASE WHEN p = 1 THEN url ELSE rtrim(url, '/') || '/?page=' || p END AS url FROM pages, generate_series(1, 3) AS t(p)"


def conditional_requests(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    cache = pages.where("page_id % 2 = 0").select(F.substring(F.sha2(F.encode("url", "UTF-8"), 256), 1, 24).alias("key"), F.concat(F.lit("e"), F.length("html").cast("string")).alias("etag"), F.lit("Mon").alias("last_modified"))
    return fallback.conditional_headers(pages.select("url").distinct(), cache.groupBy("key").agg(F.max("etag").alias("etag"), F.max("last_modified").alias("last_modified")))


CONDITIONAL = """
WITH c AS (SELECT url, max('e' || length(html)) AS etag FROM pages WHERE page_id % 2 = 0 GROUP BY url)
SELECT DISTINCT p.url, etag, CASE WHEN etag IS NOT NULL THEN 'Mon' END AS last_modified FROM pages p LEFT JOIN c USING (url)
"""

def run_totals(spark, sf_dir):
    entries = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.when(F.coalesce("text", F.lit("")).rlike("[0-9]"), "digits").alias("error"))
    return changes.run_totals(entries)


RUN_TOTALS = "SELECT count(*) FILTER (NOT regexp_matches(coalesce(text, ''), '[0-9]')) AS successes, count(*) FILTER (regexp_matches(coalesce(text, ''), '[0-9]')) AS failures FROM documents"


def presence_totals(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("plithos_arthron"))
    files = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id")).distinct()
    return changes.presence_totals(changes.status(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), orders, files))


PRESENCE = """
WITH s AS (SELECT EXISTS (FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS present FROM customer)
SELECT count(*) FILTER (present) AS present, count(*) FILTER (NOT present) AS missing, count(*) AS laws FROM s
"""


def export_totals(spark, sf_dir):
    return records.export_totals(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("law"), (F.col("doc_id") % 7).alias("articles"), F.col("n_chars").alias("characters")))


EXPORT_TOTALS = """
WITH r AS (SELECT doc_id, n_chars, n_chars // 1000 AS k, n_chars % 1000 AS rest FROM documents)
SELECT doc_id AS law, doc_id % 7 AS articles, CAST(k + CASE WHEN rest > 500 OR (rest = 500 AND k % 2 = 1) THEN 1 ELSE 0 END AS VARCHAR) || 'k' AS size FROM r
UNION ALL SELECT NULL, CAST(sum(doc_id % 7) AS BIGINT), CAST(count(*) AS VARCHAR) || ' files' FROM documents
"""


def article_texts(spark, sf_dir):
    paragraph = F.struct(F.col("l_linenumber").alias("n"), F.concat("l_returnflag", F.lit(" "), "l_linestatus").alias("keimeno"), F.when(F.col("l_returnflag") == "R", "").otherwise(F.col("l_linenumber").cast("string")).alias("arithmos"))
    articles = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(paragraph)).alias("paragrafoi"))
    return articles.select(F.col("l_orderkey").alias("law"), records.article_text(F.col("paragrafoi")).alias("keimeno"))


ARTICLE_TEXTS = """
SELECT l_orderkey AS law, string_agg(CASE WHEN l_returnflag = 'R' THEN '' ELSE l_linenumber || '. ' END || l_returnflag || ' ' || l_linestatus, chr(10) || chr(10) ORDER BY l_linenumber, l_returnflag, l_linestatus) AS keimeno
FROM lineitem GROUP BY l_orderkey
"""


def pages_until_failure(spark, sf_dir):
    tries = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag").distinct()
    return links.until_failure(tries, "l_orderkey", "l_linenumber", F.col("l_returnflag") == "R").select("l_orderkey", "l_linenumber")


UNTIL_FAILURE = """
WITH f AS (SELECT l_orderkey, min(l_linenumber) AS first FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
t AS (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem)
SELECT l_orderkey, l_linenumber FROM t LEFT JOIN f USING (l_orderkey) WHERE first IS NULL OR l_linenumber < first
"""

QUERIES = {
    "run_totals": (run_totals, RUN_TOTALS),
    "presence_totals": (presence_totals, PRESENCE),
    "export_totals": (export_totals, EXPORT_TOTALS),
    "article_texts": (article_texts, ARTICLE_TEXTS),
    "pages_until_failure": (pages_until_failure, UNTIL_FAILURE),
    "manifest_diff": (manifest_diff, RUNS_SQL + "SELECT * FROM diff"),
    "material_changes": (material_changes, RUNS_SQL + "SELECT kind, count(*) AS laws FROM diff WHERE kind != 'αμετάβλητο' GROUP BY kind"),
    "manifest_upsert": (manifest_upsert, UPSERT),
    "missing_orphans": (coverage, COVERAGE),
    "status_report": (status_report, STATUS),
    "adjacent_groups": (adjacent_groups, ADJACENT),
    "heading_changes": (heading_changes, HEADINGS),
    "first_success_source": (first_success_source, FIRST_SUCCESS),
    "source_ranks": (source_ranks, SOURCE_RANKS),
    "retry_outcomes": (retry_outcomes, RETRIES),
    "registry_violations": (registry_violations, VIOLATIONS),
    "relation_edges": (relation_edges, EDGES),
    "themes": (themes, "SELECT c_mktsegment AS thematiki, count(*) AS laws FROM customer GROUP BY ALL"),
    "registry_report": (registry_report, REPORT),
    "laws_by_priority": (laws_by_priority, BY_PRIORITY),
    "page_links": (page_links, LINKS_SQL + "SELECT page_id, pos, text, url FROM links"),
    "hard_page_links": (hard_page_links, HARD),
    "keyword_links": (keyword_links, KEYWORDS),
    "top_links": (top_links, TOP),
    "unknown_links": (unknown_links, UNKNOWN),
    "discovered_links": (discovered_links, DISCOVERED),
    "paged_urls": (paged_urls, PAGED),
    "conditional_requests": (conditional_requests, CONDITIONAL),
}
