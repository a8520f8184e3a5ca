import json
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexicord.functions import names, rules
from lexicord.operators import changes, fallback, links, pages, records, registry, scan, structure
from lexicord.plans import pipelines
from lexicord.sources import cache, extract, lawfiles, tables
from lexicord.streaming import incremental

TEXT = """Εισαγωγή
ΜΕΡΟΣ Α΄
ΓΕΝΙΚΕΣ
ΔΙΑΤΑΞΕΙΣ
ΚΕΦΑΛΑΙΟ ΠΡΩΤΟ
ΟΡΙΣΜΟΙ
Άρθρο 1
Οδήγηση υπό την επίδραση οινοπνεύματος,
φαρμάκων
Εισαγωγική φράση:
1.Πρώτη παράγραφος
συνέχεια.
2. Δεύτερη, με 1.500 ευρώ
1.500 ευρώ στην αρχή.
Άρθρον 2α.
σύμφωνα με το
άρθρο 57.
ΜΕΡΟΣ Β
ΤΕΛΟΣ
ΑΡΘΡΟ 17
Συνιστάται νομικό πρόσωπο.
Άρθρο 1
Ξανά
1. Τέλος."""


def parse(spark, text):
    return structure.articles(spark.createDataFrame([("l", text)], "law string, text string")).orderBy("pos").collect()


def test_structure(spark):
    rows = parse(spark, TEXT)
    assert [r.arthro for r in rows] == ["1", "2Α", "17", "1"]
    assert [(r.meros, r.kefalaio) for r in rows] == [("Α", "ΠΡΩΤΟ"), ("Α", "ΠΡΩΤΟ"), ("Β", None), ("Β", None)]
    assert rows[0].meros_titlos == "ΓΕΝΙΚΕΣ ΔΙΑΤΑΞΕΙΣ" and rows[0].kefalaio_titlos == "ΟΡΙΣΜΟΙ"
    assert rows[0].titlos == "Οδήγηση υπό την επίδραση οινοπνεύματος, φαρμάκων"
    assert [tuple(p) for p in rows[0].paragrafoi] == [("", "Εισαγωγική φράση:"), ("1", "Πρώτη παράγραφος συνέχεια."), ("2", "Δεύτερη, με 1.500 ευρώ 1.500 ευρώ στην αρχή.")]
    assert rows[2].titlos == "" and rows[2].paragrafoi[0].keimeno == "Συνιστάται νομικό πρόσωπο."
    assert parse(spark, "χωρίς άρθρα") == []


def test_endless_title_is_no_title(spark):
    row = parse(spark, "Άρθρο 1\nΑρχή\n" + "\n".join(f"γραμμή {k}" for k in range(8)))[0]
    assert row.titlos == "" and row.paragrafoi[0].keimeno.startswith("Αρχή γραμμή 0")


def test_duplicates_supplements_relevance(spark):
    rows = structure.articles(spark.createDataFrame([("l", TEXT)], "law string, text string"))
    assert structure.repeated_articles(rows).collect()[0].repeated == ["1"]
    first = structure.first_articles(rows)
    assert sorted(r.arthro for r in first.collect()) == ["1", "17", "2Α"]
    extra = structure.articles(spark.createDataFrame([("l", "Άρθρο 1\nκάτι\nΆρθρο 99\nάλλο"), ("other", "Άρθρο 5\nεδώ")], "law string, text string"))
    assert [r.arthro for r in structure.with_supplements(first, extra.withColumn("file", F.lit(0))).orderBy("pos").collect()] == ["1", "2Α", "17", "99"]
    kept = structure.relevant_articles(first, F.array(F.lit(2)))
    assert [r.arthro for r in kept.collect()] == ["2Α"]
    assert structure.relevant_articles(first, F.lit(None).cast("array<int>")).count() == 3


@pytest.fixture(scope="module")
def laws(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("registry") / "registry.yaml"
    path.write_text(
        """
meta: {ekdosi: 1}
nomothetimata:
  - {id: a, titlos: Κώδικας, syntomos_titlos: ΚΟΚ, typos: nomos, arithmos: "5209", etos: 2025, fek: {teuxos: A, arithmos: 100, imerominia: 2025-06-13}, thematiki: kok, proteraiotita: 1,
     katastasi: isxyon, isxys_apo: 2025-09-13, perigrafi: Ο κώδικας., scheseis: {antikathista: [b]}, piges: [{typos: eurlex_html, url: u3}, {typos: topiko_fek, url: u2}, {typos: fek_pdf, url: u1}, {typos: sympliroma, url: s}]}
  - {id: b, titlos: Οδηγία, typos: odigia_ee, arithmos: 2006/126/ΕΚ, etos: 2006, thematiki: adeies, proteraiotita: 2, katastasi: istoriko, perigrafi: x, scheseis: {tropopoiei: [zzz]}, piges: []}
""",
        encoding="utf-8",
    )
    return tables.registry(spark, str(path))


def test_registry(spark, laws):
    assert {(r.rule, r.id) for r in registry.violations(laws).collect()} == {("eu_act_needs_celex", "b"), ("needs_source", "b"), ("relation_target", "b")}
    assert [r.thematiki for r in registry.themes(laws).collect()] == ["adeies", "kok"]
    with pytest.raises(KeyError):
        registry.selected(laws, id="none")
    assert [r.url for r in fallback.ranked_sources(laws).orderBy("nth").collect()] == ["u1", "u2", "u3"]


def test_fallback_waves_ask_no_more_than_needed(spark, laws):
    asked = []

    def get(turn):
        asked.extend(r.url for r in turn.collect())
        return turn.withColumn("text", F.lit("t")).withColumn("error", F.when(F.col("url") == "u1", "dead"))

    tried = fallback.waves(fallback.ranked_sources(laws), get, 8)
    assert asked == ["u1", "u2"]
    assert fallback.warnings(tried).collect()[0].proeidopoiiseis == [rules.SAYS_LOCAL_COPY % "u2", "fek_pdf: dead"]


def test_build_and_export(spark, laws):
    raw = spark.createDataFrame([("a", "Τεύχος Α΄100/13.06.2025\n" + TEXT), ("b", "  ")], "id string, raw string")
    articles, manifest = pipelines.corpus(raw, laws)
    told = {r.id: r for r in manifest.collect()}
    assert told["a"].plithos_arthron == 3 and told["a"].epalithevmeno_fek and told["a"].error is None
    assert told["b"].error == "blank text" and not told["b"].epalithevmeno_fek
    full = laws.withColumn("pigi_url", F.lit("u")).withColumn("anaktithike", F.lit("2025-01-01"))
    rows = records.paragraph_records(articles, full).collect()
    assert "a:art-1:par-1" in {r.id for r in rows} and rows[0].nomothetima == "Ν. 5209/2025"
    (out,) = pipelines.export(articles, laws).collect()
    assert out.law == "a" and out.articles == 3 and out.characters == len(out.document)
    assert out.document.startswith("# Κώδικας\n\nΝόμος 5209 του 2025. ΦΕΚ τεύχος Άλφα, αριθμός 100, 13 Ιουνίου 2025. Ισχύει από 13 Σεπτεμβρίου 2025.\n\nΟ κώδικας.\n\n## ΚΟΚ — Άρθρο 1: Οδήγηση")
    assert "\nΓΕΝΙΚΕΣ ΔΙΑΤΑΞΕΙΣ — ΟΡΙΣΜΟΙ\n" in out.document and "Παράγραφος 1. Πρώτη παράγραφος συνέχεια." in out.document
    head = {r.law: r.header for r in records.law_header(laws).collect()}
    assert "> [!WARNING]" in head["b"] and "| ΦΕΚ | Α΄100/13-06-2025 |" in head["a"]


def test_whole_documents_facts_and_verification(spark, laws, tmp_path):
    raw = spark.createDataFrame([("a", "Άρθρο 1\nΤίτλος\n1. Ένα.\n2. Δύο.\n")], "law string, text string")
    articles = structure.articles(raw, "law", "text")
    full = laws.withColumns({"pigi_url": F.lit("u"), "anaktithike": F.lit("2025-01-01"), "checksum_pigis": F.lit("c"), "plithos_arthron": F.lit(1), "plithos_paragrafon": F.lit(2)})
    before = {r.id: r.epalithevmeno for r in laws.collect()}
    found = spark.createDataFrame([("a", not before["a"])], "id string, epalithevmeno boolean")
    assert {r.epalithevmeno for r in records.paragraph_records(articles, full, found).collect()} == {not before["a"]}
    assert {r.epalithevmeno for r in records.paragraph_records(articles, full).collect()} == {before["a"]}
    meta = records.law_meta(full, found)
    rows = {r.id: r for r in meta.collect()}
    assert len(meta.columns) == 16 and rows["a"].epalithevmeno != before["a"] and all(rows[i].epalithevmeno == v for i, v in before.items() if i != "a")
    tables.write_meta(meta, f"{tmp_path}/meta")
    assert spark.read.json(f"{tmp_path}/meta").count() == len(before)
    text = {r.law: r.document for r in records.full_markdown(articles, laws).collect()}
    assert set(text) == set(before) and "\n---\n" in text["a"] and text["a"].endswith("2. Δύο.\n") and text["a"].index("---\n") < text["a"].index("#### Άρθρο 1")
    assert [r.t for r in articles.select(records.article_text(F.col("paragrafoi")).alias("t")).collect()] == ["1. Ένα.\n\n2. Δύο."]


def test_odd_files_are_errors_not_failures():
    assert extract.html_text("<p>a</p><p>b</p>") == "a\nb" and extract.html_text("") == "" and extract.html_text("plain") == "plain"
    head = bytearray(bytes.fromhex("d0cf11e0a1b11ae1") + bytes(600))
    head[30:32] = b"\xff\xff"
    text, error = extract.file_text(bytes(head))
    assert text is None and error


def test_all_sources_are_tried(spark):
    ranked = spark.createDataFrame([("a", n, "fek_pdf", f"u{n}") for n in range(1, 11)], "id string, nth int, source_type string, url string")
    got = fallback.waves(ranked, lambda turn: turn.withColumns({"text": F.when(F.col("nth") == 10, "t"), "error": F.when(F.col("nth") < 10, "dead")}))
    assert got.count() == 10 and got.where("error is null").first().nth == 10


def test_addresses_and_entities(spark):
    base = "http://h/a/d/p.html"
    html = """<a href=plain.html>one</a> <a class="a>b" href="../b/c.html?x=../y">two</a> <a href='./e/'>&eacute;t&#233; &#x3B1;&amp;lt;</a> <a href="/x/../../z/.">four</a>"""
    rows = links.links(spark.createDataFrame([(1, base, html)], "page_id long, url string, html string")).orderBy("pos").collect()
    assert [r.url for r in rows] == ["http://h/a/d/plain.html", "http://h/a/b/c.html?x=../y", "http://h/a/d/e/", "http://h/z/"]
    assert [r.text for r in rows] == ["one", "two", "été α&lt;", "four"]


def test_collision_numbering(spark):
    rows = spark.createDataFrame([("l", k, "x") for k in range(3)] + [("l", 5, "y")], "law string, seq int, b string")
    assert [r.id for r in records.numbered_ids(rows, F.col("b")).orderBy("seq").collect()] == ["x", "x-2", "x-3", "y"]


def test_changes(spark):
    old = spark.createDataFrame([("a", "1", 5), ("b", "2", 5), ("c", None, 5), ("gone", "9", 5)], "id string, checksum_keimenou string, n int")
    new = spark.createDataFrame([("a", "1", 6), ("b", "3", 6), ("c", None, 6), ("d", "4", 6)], "id string, checksum_keimenou string, n int")
    kinds = {r.id: r.kind for r in changes.diff(old, new).collect()}
    assert kinds == {"a": changes.SAME, "b": changes.MODIFIED, "c": changes.SAME, "d": changes.NEW, "gone": changes.GONE}
    assert {r.id: r.n for r in changes.upsert(old, new).collect()} == {"a": 6, "b": 6, "c": 6, "d": 6, "gone": 5}
    import json

    told = json.loads(changes.manifest_json(new, F.lit("2025-01-01")).first()[0])
    assert told["plithos"] == 4 and list(told["nomothetimata"]) == ["a", "b", "c", "d"]


def test_manifest_and_records_round_trip(spark, tmp_path):
    assert tables.manifest(spark, f"file://{tmp_path}/none.json").count() == 0
    (tmp_path / "m.json").write_text('{"enimerosi": "x", "plithos": 1,\n "nomothetimata": {"a": {"checksum_pigis": "c", "plithos_arthron": 3}}}')
    assert tables.manifest(spark, f"file://{tmp_path}/m.json").collect()[0].plithos_arthron == 3
    (tmp_path / "r.jsonl").write_text('{"id": "i", "arthro": "1", "keimeno": "k", "thematiki": "t", "nomothetima_id": "l"}\n\n')
    rows = tables.records(spark, f"file://{tmp_path}/r.jsonl")
    assert rows.first().titlos_arthrou == ""
    tables.write_records(rows, f"file://{tmp_path}/out")
    assert tables.records(spark, f"file://{tmp_path}/out").count() == 1


def test_links(spark):
    html = "<a href='/x'>Νόμος <b>5</b>/1999</a> <A class=k HREF=\"y?a=1&amp;b=2\"> z </a><a href=#top>t</a><a href='mailto:a'>m</a><a href=\"/x\">again</a><a href='//h/p'>q</a>"
    rows = links.links(spark.createDataFrame([(1, "http://e.org/d/p?q", html)], "page_id int, url string, html string")).orderBy("pos").collect()
    assert [(r.text, r.url) for r in rows] == [("Νόμος 5/1999", "http://e.org/x"), ("z", "http://e.org/d/y?a=1&b=2"), ("q", "http://h/p")]


def test_gutter(spark):
    def page(n, crossing):
        return [(n, 50.0 if k % 2 else 330.0, 280.0 if k % 2 else 550.0, 600.0) for k in range(100)] + [(n, 100.0, 500.0, 600.0)] * crossing

    rows = spark.createDataFrame(page(1, 1) + page(2, 9) + page(3, 0)[:10], "page int, x0 double, x1 double, width double")
    got = {r.page: r.gutter for r in pages.gutters(rows).collect()}
    assert got[1] == pytest.approx(306) and got[2] is None and got[3] is None
    assert extract.gutter([(a, b) for _, a, b, _ in page(1, 1)], 600.0) == pytest.approx(306)


def word_streams(parts, lid=0x0408, main=None):
    """(document, table) with the given (text, compressed) pieces."""
    longs, pairs = 0x22 + 2 * 14 + 2, 0x22 + 2 * 14 + 2 + 4 * 22 + 2
    size = pairs + 34 * 8
    body, places, pcds = b"", [0], b""
    for text, small in parts:
        raw = text.encode("cp1253" if lid == 0x0408 else "cp1252") if small else text.encode("utf-16-le")
        at = size + len(body)
        pcds += b"\0\0" + struct.pack("<I", at * 2 | 0x40000000 if small else at) + b"\0\0"
        places.append(places[-1] + len(text))
        body += raw
    plc = struct.pack(f"<{len(places)}I", *places) + pcds
    clx = b"\x01\x03\x00abc" + b"\x02" + struct.pack("<I", len(plc)) + plc
    head = bytearray(size)
    struct.pack_into("<H", head, 0, 0xA5EC)
    struct.pack_into("<H", head, 6, lid)
    struct.pack_into("<H", head, 10, 0x0200)
    struct.pack_into("<H", head, 0x20, 14)
    struct.pack_into("<H", head, 0x22 + 28, 22)
    struct.pack_into("<I", head, longs + 12, places[-1] if main is None else main)
    struct.pack_into("<II", head, pairs + 33 * 8, 4, len(clx))
    return bytes(head) + body, b"zzzz" + clx


def test_word_text():
    document, table = word_streams([("Άρθρο 1\r", True), ("κείμενο\x13 PAGE \x14 5\x15!\x1e", False), ("υποσημείωση", True)], main=28)
    assert extract.word_text(document, {"1Table": table}) == "Άρθρο 1\nκείμενο 5!-"
    with pytest.raises(extract.BadFile):
        extract.word_text(document, {})
    with pytest.raises(extract.BadFile):
        extract.word_text(b"\0\0\0\0", {})


def test_html_and_files(spark):
    html = "<html><body><nav>x</nav><p>έξω</p><main><p>Α <b>Β</b></p><script>1</script><br>Γ</main></body></html>"
    assert extract.html_text(html) == "Α\nΒ\nΓ"
    assert extract.html_text("<body><div>a<p>b</div></body>") == "a\nb"
    rows = spark.createDataFrame([(bytearray(html.encode()),), (bytearray(b"\xd0\xcf\x11\xe0broken"),), (None,)], "c binary").select(extract.extracted("c").alias("e")).collect()
    assert rows[0].e.text == "Α\nΒ\nΓ" and rows[1].e.error.startswith("BadFile") and rows[2].e.error == "no content"


def test_streaming_merge(spark, tmp_path):
    source, state = f"file://{tmp_path}/in", f"file://{tmp_path}/state"
    seen = []

    def go(rows):
        spark.createDataFrame(rows, "id string, text string, seen int").coalesce(1).write.mode("append").parquet(source)
        incremental.merge_available(spark, source, "id string, text string, seen int", state, f"file://{tmp_path}/ck", lambda df, n: seen.append({(r.id, r.kind) for r in df.collect()})).awaitTermination()

    go([("a", "1", 1), ("b", "2", 1)])
    go([("a", "9", 2), ("a", "1", 1), ("c", "3", 2)])
    assert seen == [{("a", changes.NEW), ("b", changes.NEW)}, {("a", changes.MODIFIED), ("c", changes.NEW)}]


def page(*articles, top=""):
    return f"<html><body><main><p>{top}</p>" + "".join(f"<h2>Άρθρο {a}</h2><p>Τίτλος {a}</p><p>1. Κείμενο {a}.</p>" for a in articles) + "</main></body></html>"


def built_of(spark, sources, files, wanted=(), fek=False):
    """A run for one law with these (type, url) sources and {url: content} files."""
    fek_type = "struct<teuxos:string,arithmos:int,imerominia:date>"
    law = spark.createDataFrame([("l", "nomos", list(wanted), sources)], "id string, typos string, relevanta_arthra array<int>, piges array<struct<typos:string,url:string>>")
    law = law.withColumn("fek", F.from_json(F.lit('{"teuxos":"A","arithmos":7654321,"imerominia":"1911-06-13"}'), fek_type) if fek else F.lit(None).cast(fek_type))
    rows = spark.createDataFrame([(u, c.encode() if isinstance(c, str) else c, "text/html") for u, c in files.items()], "url string, content binary, content_type string")
    out = pipelines.built(law, rows)
    told = out.told.collect()
    assert len(told) == 1
    return [(r.arthro, r.pos) for r in out.articles.orderBy("pos").collect()], [r.asDict() for r in out.manifest.collect()], told[0], out


@pytest.mark.parametrize(
    ("first", "message"),
    [
        ("<html><body> </body></html>", "fek"),
        (None, "fek"),
        ("<html><body><p>Κείμενο χωρίς δομή</p></body></html>", "fek"),
        (page(5, 6), "fek"),
        (b"\xd0\xcf\x11\xe0xx", "fek"),
        (b"%PDF-1.4 broken", "fek"),
    ],
)
def test_a_source_without_wanted_articles_falls_through(spark, first, message):
    files = {"u2": page(1, 2)} | ({"u1": first} if first is not None else {})
    articles, manifest, told, _ = built_of(spark, [("kodikopoiimeno_html", "u2"), ("fek_pdf", "u1")], files, wanted=(1, 2))
    assert articles == [("1", 0), ("2", 1)] and manifest[0]["pigi_url"] == "u2" and told.error is None
    assert told.proeidopoiiseis == [rules.SAYS_OTHER_SOURCE % ("kodikopoiimeno_html", "u2")]
    assert manifest[0]["checksum_pigis"] and manifest[0]["plithos_paragrafon"] == 2


def test_local_copy_and_gazette_notices(spark):
    _, manifest, told, _ = built_of(spark, [("fek_pdf", "u1"), ("topiko_fek", "u2")], {"u2": page(1, 1)}, fek=True)
    assert told.proeidopoiiseis == [rules.SAYS_LOCAL_COPY % "u2", rules.SAYS_UNVERIFIED, rules.SAYS_REPEATED % "1"] and not manifest[0]["epalithevmeno_fek"]
    _, manifest, told, _ = built_of(spark, [("fek_pdf", "u1")], {"u1": page(1, top="Τεύχος Α΄7654321/13.06.1911")}, fek=True)
    assert told.proeidopoiiseis == [] and manifest[0]["epalithevmeno_fek"]


def test_all_sources_failed(spark):
    blank = "<html><body></body></html>"
    articles, manifest, told, _ = built_of(spark, [("fek_pdf", "u1"), ("topiko_fek", "u2")], {"u1": blank}, wanted=(1,))
    size = rules.SAYS_BLANK % ("u1", len(blank), "text/html")
    assert not articles and not manifest and told.error == rules.SAYS_ALL_FAILED % ("l", 2, f"fek_pdf: {size}; topiko_fek: {rules.SAYS_NO_FILE % 'u2'}")
    assert built_of(spark, [("fek_pdf", "u1")], {"u1": blank})[2].error == f"l: {size}"
    assert built_of(spark, [("sympliroma", "s")], {"s": "Άρθρο 1\nα"})[2].error == rules.SAYS_NO_SOURCE % "l"


def test_supplements_fill_in_order(spark):
    sources = [("sympliroma", "s1"), ("fek_pdf", "u1"), ("sympliroma", "s2"), ("sympliroma", "s3")]
    files = {"u1": page(1, 5, 6), "s1": "ΜΕΡΟΣ Α\nΤίτλος\nΆρθρο 2\nένα\nΆρθρο 99\nδύο\nΆρθρο 99\nτρία\nΆρθρο 5\nάλλο", "s2": "Άρθρο 99\nόχι\nΆρθρο 17Α\nναι\nΆρθρο 17\nναι".encode() + b"\n\xff"}
    articles, manifest, told, out = built_of(spark, sources, files)
    assert [a for a, _ in articles] == ["1", "2", "5", "6", "17", "17Α", "99", "99"] and [p for _, p in articles] == list(range(8))
    assert told.proeidopoiiseis == [rules.SAYS_NO_SUPPLEMENT % ("s3", rules.SAYS_NO_FILE % "s3"), rules.SAYS_SUPPLEMENTED % "2, 99, 99, 17Α, 17"]
    assert manifest[0]["plithos_arthron"] == 8
    parts = {(r.arthro, r.file): r.meros for r in out.articles.collect()}
    assert parts["2", 0] == "Α" and parts["17", 2] is None  # a Part ends with its file
    document = records.markdown(out.articles).collect()[0].document
    assert [line.split()[2] for line in document.split("\n") if line.startswith("####")] == ["1", "2", "5", "6", "17", "17Α", "99", "99"]


def test_a_law_without_additions_keeps_its_order(spark):
    articles, *_ = built_of(spark, [("fek_pdf", "u1"), ("sympliroma", "s1")], {"u1": page(9, 3, 12), "s1": "Άρθρο 3\nάλλο"})
    assert articles == [("9", 0), ("3", 1), ("12", 2)]


def test_refreshed_keeps_whole_entries(spark):
    _, _, _, out = built_of(spark, [("fek_pdf", "u1")], {"u1": page(1)})
    old = spark.createDataFrame([("l", "old", "text", 3, 4, "u0", True), ("m", "c", "d", 1, 1, "um", False)], f"id string, {tables.ENTRY}")
    merged, changed = pipelines.refreshed(old, out.manifest)
    rows = {r.id: r for r in merged.collect()}
    assert rows["l"].pigi_url == "u1" and len(rows["l"].checksum_pigis) == 64 and rows["m"].pigi_url == "um" and rows["m"].checksum_pigis == "c"
    assert [(r.id, r.kind) for r in changed.collect()] == [("l", changes.MODIFIED)]
    # entries without these columns do not cost others theirs
    merged, _ = pipelines.refreshed(old, out.manifest.drop("pigi_url", "checksum_pigis"))
    assert {r.id: r.pigi_url for r in merged.collect()} == {"l": None, "m": "um"}


def test_article_order_of_long_numbers(spark):
    rows = spark.createDataFrame([("17Α",), ("9",), ("12345678901234",), ("Α",), ("17",)], "a string")
    assert [r.a for r in rows.orderBy(*names.article_order(F.col("a"))).collect()] == ["Α", "9", "17", "17Α", "12345678901234"]


def anchors(spark, html, base="http://h/d/p.html"):
    return [(r.text, r.url) for r in links.links(spark.createDataFrame([(1, base, html)], "page_id long, url string, html string")).orderBy("pos").collect()]


def test_anchors_of_hard_pages(spark):
    assert anchors(spark, "<!-- <a href=c>no</a> --><script>'<a href=s>no</a>'</script><style><a href=t></style><A HREF=one>One</A>") == [("One", "http://h/d/one")]
    assert anchors(spark, "<a href='1'>one <b>bold<a href=\"2\">two</b></a> after") == [("one bold", "http://h/d/1"), ("two", "http://h/d/2")]
    assert anchors(spark, "<a name=x>none</a><a>none</a><a href>none</a><a href=''>none</a><a data-href=3 title='a href=4 > b' href=5>five") == [("five", "http://h/d/5")]
    assert anchors(spark, "<a href=1>x<!-- <a href=2> -->y</a><abbr href=3>z</abbr><a/href=4>four</a><script>open <a href=5>") == [("xy", "http://h/d/1"), ("four", "http://h/d/4")]
    assert anchors(spark, "<a href='?a=1&copy=2&amp;b=&lt;'>q</a>") == [("q", "http://h/d/p.html?a=1&copy=2&b=<")]
    assert anchors(spark, "<a href=1>a < b &#1114112;&#xFFFFFF;&#38;lt;&#128;&Eacute;</a><a href=1>again</a>") == [("a < b ��&lt;€É", "http://h/d/1")]
    assert anchors(spark, "<a href=x") == [] and anchors(spark, "") == [] and anchors(spark, "<a href=1>\u0001t\u0003u</a>") == [("tu", "http://h/d/1")]


def test_no_page_ends_the_job(spark):
    long_tag = "<a " + "x='y' " * 20_000 + "href=1>one</a><a href=2>two</a>"
    assert ("two", "http://h/d/2") in anchors(spark, long_tag)
    assert anchors(spark, "<a href='" + "q" * 300_000 + "'>" + "&amp;" * 50_000 + "</a>")[0][0] == "&" * 50_000
    assert anchors(spark, "<" * 100_000 + "<!--" * 1000 + "'\"" * 50_000) == []


def test_addresses_and_entities_equal_the_standard_library(spark):
    import html
    import random
    from urllib.parse import urljoin

    rng = random.Random(1)
    bases = ["http://h/a/d/p.html", "http://h", "http://h/", "https://h:8/a//b/?q=1#f", "http://h/x/..", "http://h?x", "HTTP://H/a/b"]
    bits = ["/", "..", ".", "a", "b?", "?", "#", "//", "x=1", "http:", "https://k/", "c/", "&", "%20", "h"]
    rows = [(rng.choice(bases), "".join(rng.choice(bits) for _ in range(rng.randint(1, 6)))) for _ in range(600)]
    df = spark.createDataFrame(rows, "base string, href string")
    assert [r.u for r in df.select(links.absolute(F.col("href"), F.col("base")).alias("u")).collect()] == [urljoin(b, h) for b, h in rows]
    bits = ["&#1114112;", "&#38;lt;", "&#128;", "&#129;", "&Eacute;", "&copy", "&copy=1", "&amp;lt;", "&#0;", "&#xD800;", "&nosuch;", "&", "&#;", "&#x;", "a", "é", "&notit;", "&#00065", "&NotEqualTilde;", "&#99999999999999999999;", " "]
    texts = [("".join(rng.choice(bits) for _ in range(rng.randint(1, 5))),) for _ in range(600)]
    got = spark.createDataFrame(texts, "t string").select("t", links.unescaped(F.col("t")).alias("u")).collect()
    assert [r.u for r in got] == [html.unescape(t) for t, in texts]


def test_pages_of_a_list(spark):
    rows = links.paged_urls(spark.createDataFrame([("http://h/list",), ("http://h/l//",)], "url string"), "url", 2)
    assert sorted(r.url for r in rows.collect()) == ["http://h/l//", "http://h/l/?page=2", "http://h/list", "http://h/list/?page=2"]
    assert links.paged_urls(rows.select("url").limit(1), "url", 0).count() == 1


def test_a_compound_file_that_points_to_itself_ends():
    body = bytearray(bytes.fromhex("d0cf11e0a1b11ae1") + bytes(504) + bytes(1024))
    body[30:34] = struct.pack("<HH", 9, 6)
    body[68:72] = struct.pack("<I", 0)  # the list of further sectors is sector 0,
    body[512 + 508 : 512 + 512] = struct.pack("<I", 0)  # which names itself as its next
    assert extract.file_text(bytes(body))[1]


def manifest_rows(spark, first, last, mark):
    return spark.range(first, last).selectExpr("concat('d', id) AS id", f"concat('{mark}', id) AS checksum_keimenou")


def test_a_merge_rewrites_only_what_it_hits(spark, tmp_path):
    table = incremental.manifest_table(spark, f"{tmp_path}/state", buckets=64)
    assert table.read().count() == 0 and table.versions() == []
    assert table.merge(manifest_rows(spark, 0, 6400, "a"), 0, changes.upsert)
    batch = manifest_rows(spark, 10, 12, "b").unionByName(manifest_rows(spark, 9000, 9001, "b"))
    assert table.merge(batch, 1, changes.upsert)
    assert spark.read.parquet(f"{tmp_path}/state/data/v1").count() < 400  # three buckets of some hundred rows
    assert not table.merge(manifest_rows(spark, 0, 50, "c"), 1, changes.upsert)  # replayed: as it was
    rows = {r.id: r.checksum_keimenou for r in table.read().collect()}
    assert len(rows) == 6401 and rows["d10"] == "b10" and rows["d12"] == "a12" and rows["d9000"] == "b9000"
    assert table.read(0).count() == 6400 and {r.checksum_keimenou[0] for r in table.read(0).collect()} == {"a"}
    with pytest.raises(ValueError):
        incremental.manifest_table(spark, f"{tmp_path}/state", buckets=8).read()
    table.clean(keep=1)
    assert table.versions() == [1] and {r.id: r.checksum_keimenou for r in table.read().collect()} == rows


def test_a_merge_that_failed_before_its_log_is_run_again(spark, tmp_path):
    table = incremental.manifest_table(spark, f"{tmp_path}/state", buckets=4)
    table.merge(manifest_rows(spark, 0, 10, "a"), 0, changes.upsert)
    manifest_rows(spark, 0, 3, "half").withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{tmp_path}/state/data/v1")
    assert {r.checksum_keimenou[0] for r in table.read().collect()} == {"a"}
    table.clean(keep=2)  # leaves what may be going on
    table.merge(manifest_rows(spark, 0, 3, "b"), 1, changes.upsert)
    assert sorted(r.checksum_keimenou for r in table.read().collect())[-3:] == ["b0", "b1", "b2"] and table.read().count() == 10


def test_cache_asks_and_keeps(spark, tmp_path):
    store = cache.ResponseCache(spark, f"{tmp_path}/cache", buckets=4)
    schema = "url string, attempt int, status int, etag string, last_modified string, content_type string, content binary, error string"
    urls = spark.createDataFrame([("a",), ("b",), ("a",)], "url string")
    assert {(r.url, r.etag) for r in store.requests(urls).collect()} == {("a", None), ("b", None)}
    store.store(spark.createDataFrame([("a", 0, 200, "e1", None, "t", b"old", None), ("b", 0, 503, None, None, None, None, None), ("b", 1, 200, None, "Mon", None, b"b", None)], schema), 1)
    assert {(r.url, r.etag, r.last_modified) for r in store.requests(urls).collect()} == {("a", "e1", ""), ("b", "", "Mon")}
    assert {r.etag for r in store.requests(urls, fresh=True).collect()} == {None}
    answers = spark.createDataFrame([("a", 0, 304, None, None, None, None, None), ("b", 0, 200, None, None, None, b"", None), ("c", 0, 304, None, None, None, None, None)], schema)
    assert {(r.url, bytes(r.content), r.from_cache) for r in store.answered(answers).collect()} == {("a", b"old", True)}
    store.store(answers, 2)
    assert {(r.url, bytes(r.content)) for r in store.read().collect()} == {("a", b"old"), ("b", b"b")}


def test_files_missing_unreadable_and_good_in_one_read(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "good.pdf").write_bytes(b"%PDF-1")
    (tmp_path / "odd").symlink_to(tmp_path / "odd")  # a name that leads nowhere
    rows = {r.url: r for r in lawfiles.read_files(spark, str(tmp_path), ["file:d/good.pdf", "file:/d/none.html", "d", "odd"]).collect()}
    assert bytes(rows["file:d/good.pdf"].content) == b"%PDF-1" and rows["file:d/good.pdf"].content_type == "application/pdf" and rows["file:d/good.pdf"].error is None
    assert rows["file:/d/none.html"].error == rules.SAYS_NO_FILE % f"{tmp_path}/d/none.html" and rows["file:/d/none.html"].content_type == "text/html"
    assert rows["d"].error and rows["odd"].error and len(rows) == 4
    assert lawfiles.read_files(spark, str(tmp_path), []).count() == 0
    assert lawfiles.LawFileReader("r", list("x" * 130)).partitions()[2].urls == ["x", "x"]


def test_a_run_from_files_to_files(spark, laws, tmp_path):
    (tmp_path / "u2").write_text(page(1, 2), encoding="utf-8")
    files = lawfiles.read_files(spark, str(tmp_path), ["u1", "u2", "s"])
    run = pipelines.built(laws, files)
    told = {r.id: r for r in run.told.collect()}
    assert told["a"].proeidopoiiseis == [rules.SAYS_LOCAL_COPY % "u2", rules.SAYS_UNVERIFIED, rules.SAYS_NO_SUPPLEMENT % ("s", rules.SAYS_NO_FILE % f"{tmp_path}/s")]
    full = laws.join(run.manifest, "id").withColumn("anaktithike", F.lit("2025-01-01"))
    found = run.manifest.select("id", F.col("epalithevmeno_fek").alias("epalithevmeno"))
    documents = records.full_markdown(run.articles, full, found)
    lines = records.paragraph_records(run.articles, full, found, placed=True)
    for _ in range(2):  # a second run replaces the files
        lawfiles.write_law_files(f"{tmp_path}/corpus", documents, lines, records.law_meta(full, found))
    lawfiles.write_export_files(pipelines.export(run.articles, laws), laws, f"{tmp_path}/export")
    assert sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*.*") if p.is_file() and not p.name.startswith(".")) == ["corpus/kok/a/articles.jsonl", "corpus/kok/a/full.md", "corpus/kok/a/meta.json", "export/kok/a.md"]
    own = [json.loads(x) for x in (tmp_path / "corpus/kok/a/articles.jsonl").read_text(encoding="utf-8").splitlines()]
    assert [(x["id"], x["keimeno"], x["celex"]) for x in own] == [("a:art-1:par-1", "Κείμενο 1.", None), ("a:art-2:par-1", "Κείμενο 2.", None)] and len(own[0]) == 20
    meta = (tmp_path / "corpus/kok/a/meta.json").read_text(encoding="utf-8")
    assert meta == json.dumps(json.loads(meta), ensure_ascii=False, indent=2) + "\n" and len(json.loads(meta)) == 16 and json.loads(meta)["epalithevmeno"] is False
    line = (tmp_path / "corpus/kok/a/articles.jsonl").read_text(encoding="utf-8").splitlines()[0]
    assert line == json.dumps(json.loads(line), ensure_ascii=False)
    assert (tmp_path / "corpus/kok/a/full.md").read_text(encoding="utf-8").count("#### Άρθρο") == 2


def test_lost_attempts_leave_no_file(tmp_path):
    from pyspark.sql import Row

    writer = lawfiles.LawFileWriter(str(tmp_path))
    lost = writer.write(iter([Row(path="t/a.md", text="half")]))
    kept = writer.write(iter([Row(path="t/a.md", text="one\n"), Row(path="t/a.md", text="two\n"), Row(path="t/b.md", text=None)]))
    assert lost.files and not (tmp_path / "t").exists()
    writer.commit([kept])
    assert (tmp_path / "t/a.md").read_text() == "one\ntwo\n" and (tmp_path / "t/b.md").read_text() == "" and not list((tmp_path / "_staging").iterdir())
    other = lawfiles.LawFileWriter(str(tmp_path))
    other.write(iter([Row(path="t/a.md", text="never")]))
    other.abort([])
    assert (tmp_path / "t/a.md").read_text() == "one\ntwo\n" and not list((tmp_path / "_staging").iterdir())


def test_listed_addresses_may_lie_in_a_folder(spark, tmp_path):
    texts = spark.range(300).select(F.concat(F.lit("d/"), F.col("id").cast("string")).alias("path"), F.lit(0).alias("seq"), F.col("id").cast("string").alias("text"))
    lawfiles.write_files(texts, str(tmp_path))
    lawfiles.write_files(texts.where("path = 'd/7'").withColumn("text", F.lit("again")), str(tmp_path))
    spark.range(301).repartition(3).select(F.concat(F.lit("file:d/"), F.col("id").cast("string"), F.lit("\n"))).write.text(f"{tmp_path}/list")
    rows = {r.url: r for r in lawfiles.read_files(spark, str(tmp_path), listed="list").collect()}
    assert len(rows) == 301 and rows["file:d/300"].error and bytes(rows["file:d/7"].content) == b"again"
    assert all(bytes(rows[f"file:d/{k}"].content) == str(k).encode() for k in range(300) if k != 7) and not list((tmp_path / "_staging").iterdir())


def test_a_second_attempt_finds_files_in_place(tmp_path):
    files = list(lawfiles.set_aside(str(tmp_path), "j", [("t/a.md", "one")]))
    assert lawfiles.put_in_place(str(tmp_path), files) == lawfiles.put_in_place(str(tmp_path), files) == 1
    assert (tmp_path / "t/a.md").read_text() == "one"
    with pytest.raises(OSError):
        lawfiles.put_in_place(str(tmp_path), [(f"{tmp_path}/none", f"{tmp_path}/t/b.md")])


def test_segmented_scans_equal_windows(spark):
    import random

    rng = random.Random(4)
    rows = [(rng.choice(("a", "b", None)), k, rng.choice(("x", "y", None)), rng.choice((None, None, None, k))) for k in range(600)]
    df = spark.createDataFrame(rows, "law string, pos int, key string, v int").withColumn("segment", F.floor(F.col("pos") / 7))
    w = Window.partitionBy("law").orderBy("pos")
    want = records.adjacent_groups(df, "law", "key", "pos").withColumn("last", F.last("v", True).over(w))
    got = scan.carried(scan.adjacent_groups(df, "law", "key", "pos"), "law", "pos", {"last": F.col("v")})
    columns = ["law", "pos", "key", "v", "run", "last"]
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(map(tuple, want.select(*columns).collect()), key=repr)


def test_a_long_law_in_segments_equals_one_window(spark):
    kinds = ["ΜΕΡΟΣ {a}\nΤίτλος {k}\n", "ΚΕΦΑΛΑΙΟ {a}\nΤίτλος {k}\n", "Άρθρο {k}\nΤίτλος\n1. Κείμενο {k}.\n", "Άρθρο {k}\nκείμενο\n", "Άρθρο {k}\nΛέξη\n"]
    import random

    rng = random.Random(3)
    texts = [(f"l{n}", "".join(rng.choice(kinds if rng.random() < 0.1 else kinds[2:]).format(a="ΑΒΓΔ"[k % 4], k=k) for k in range(size))) for n, size in enumerate((3000, 40, 1))]
    df = spark.createDataFrame(texts, "law string, text string")
    assert sorted(map(str, structure.articles(df, segment=100).collect())) == sorted(map(str, structure.articles(df).collect()))


def planned(df, pattern):
    return df._jdf.queryExecution().optimizedPlan().toString().count(pattern)


def test_paragraphs_are_made_once_for_all_their_rows(spark):
    articles = structure.articles(spark.createDataFrame([("l", TEXT)], "law string, text string").repartition(2))
    assert planned(records.flatten(articles), r"(\d{1,3})\.") == planned(articles, r"(\d{1,3})\.")
    rows = spark.createDataFrame([("l", [("1", "a"), ("", "b")]), ("m", []), ("n", None)], "law string, paragrafoi array<struct<arithmos:string,keimeno:string>>").withColumn("pos", F.lit(1))
    assert sorted((r.law, r.seq.par, r.paragrafos, r.keimeno) for r in records.flatten(rows).collect()) == [("l", 0, "1", "a"), ("l", 1, "", "b")]


def test_a_place_is_pronounced_once(spark):
    columns = "law string, seq int, arthro string, titlos string, meros_titlos string, kefalaio_titlos string, paragrafos string, keimeno string"
    rows = spark.createDataFrame([("l", 0, "1", "", "χ", "", "1", "ν. 5")], columns).repartition(2)
    meta = "id string, titlos string, syntomos_titlos string, typos string, arithmos string, etos int, fek struct<teuxos:string,arithmos:int,imerominia:date>, katastasi string, isxys_apo date, perigrafi string, prosochi string"
    laws = spark.createDataFrame([("l", "t", None, "nomos", "5", 2000, None, "isxyon", None, None, None)], meta).repartition(2)
    assert planned(records.spoken_export(rows, laws), "νομοθετικού διατάγματος") <= 10  # a use of pronounce() each
    assert "χ\n\nΠαράγραφος 1. νόμου 5\n" in records.spoken_export(rows, laws).first().document
