import random
import re

import pytest
from pyspark.sql import functions as F

from lexicord.functions import names, text


def one(spark, fn, value):
    return spark.createDataFrame([(value,)], "t string").select(fn(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    "written, spoken",
    [
        ("ο ν. 5209/2025", "ο νόμου 5209 του 2025"),
        ("του π.δ. 237/1986", "του προεδρικού διατάγματος 237 του 1986"),
        ("παρ. 3 περ. β΄", "παράγραφος 3 περίπτωση βήτα"),
        ("Μέρος Α΄", "Μέρος Άλφα"),
        ("περ.ε΄αντικαταστάθηκε", "περίπτωση έψιλον αντικαταστάθηκε"),
        ("στ΄ και ΣΤ΄", "στίγμα και ΣΤ΄"),
        ("50 χλμ/ώρα, 0,5 mg/l", "50 χιλιόμετρα την ώρα, 0,5 χιλιοστά του γραμμαρίου ανά λίτρο"),
        ("12% και 5€", "12 τοις εκατό και 5 ευρώ"),
        ("η αναλογία 1/2", "η αναλογία 1/2"),
        ("απόφαση χωρίς αριθμό ν. και τέλος", "απόφαση χωρίς αριθμό ν. και τέλος"),
    ],
)
def test_pronounce(spark, written, spoken):
    assert one(spark, text.pronounce, written) == spoken


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("κυκλοφο-\nρίας", "κυκλοφορίας"),
        ("∆ήμος  και   TΗΣ", "Δήμος και ΤΗΣ"),
        ("STOP και ADR", "STOP και ADR"),
        ("ΕΦΗΜΕΡΙ∆Α TΗΣ ΚΥΒΕΡΝΗΣΕΩΣ\n12\n- 42 -\nκείμενο \n\n1.", "κείμενο\n1."),
        ("α Αρθρο :8 β", "α\nΆρθρο 8\n β"),
        ("α Αρθρο :8 β\nΆρθρο 8\nγ", "α\n β\nΆρθρο 8\nγ"),
        ("προοίμιο Αρθρο :0 κείμενο", "προοίμιο\n κείμενο"),
        ("", ""),
    ],
)
def test_normalise(spark, raw, clean):
    assert one(spark, text.normalise, raw) == clean


def test_normal_forms_and_search_keys(spark):
    assert one(spark, text.nfc, "ά") == "ά"
    for fn in (text.search_key, text.search_key_any):
        assert one(spark, fn, "ΚΥΚΛΟΦΟΡΊΑΣ") == one(spark, fn, "κυκλοφορίας") == "κυκλοφοριασ"
    assert one(spark, text.search_key_any, None) is None


def test_content_kind(spark):
    rows = [(bytearray(b),) for b in (b"%PDF-1", b"\xd0\xcf\x11\xe0x", b"PK\x03\x04", b"{\\rtf1", b"  <!DOCTYPE html>", b"", b"abc")]
    got = [r[0] for r in spark.createDataFrame(rows, "c binary").select(text.content_kind(F.col("c"))).collect()]
    assert got == ["pdf", "doc", "zip", "rtf", "html", "unknown", "unknown"]


def test_names(spark):
    row = spark.sql("SELECT 2013 y, 'B' s, 3056 n, date'2013-12-02' d, 123456 big").select(
        names.pdf_id(F.col("y"), F.col("s"), F.col("n")), names.pdf_id(F.col("y"), F.col("s"), F.col("big")), names.citation(F.col("s"), F.col("n"), F.col("d")), names.spoken_date(F.col("d")), names.spoken_series(F.lit("Ζ"))
    ).first()
    assert list(row) == ["20130203056", "201302123456", "Β΄3056/02-12-2013", "2 Δεκεμβρίου 2013", "Ζ"]


def test_gazette(spark):
    rows = spark.createDataFrame([("Τεύχος Α΄100/13.06.2025", 100, 2025), ("Τεύχος Α΄100/13.06.2025", 101, 2025), ("x", None, None)], "t string, n int, y int")
    assert [r[0] for r in rows.select(text.gazette_verified(F.col("t"), F.col("n"), F.col("y"))).collect()] == [True, False, False]


def test_markers_equal_a_plain_version(spark):
    rng = random.Random(2)
    bits = ["Άρθρο :1", "Αρθρο: 2", "Άρθρο : 0", "Άρθρο 1", "\n", "\nΆρθρο 1.\n", "\n Άρθρον 2 :\n", "\nΆρθρο 12\n", " ", "λέξη ", "x" * 90, "x" * 280, "😀" * 140, "\nΆρθρο 1", "\t"]
    rows = [("".join(rng.choice(bits) for _ in range(rng.randint(1, 12))),) for _ in range(800)]

    def plain(t):
        def turned(m):
            number, below = m.group(1), t[m.end() : m.end() + 300]
            own = number == "0" or re.search(rf"(?m)^[ \t]*[ΆΑ]ρθρο[νΝ]?[ \t]+{number}[ \t]*[.:]?[ \t]*$", below)
            return "\n" if own else f"\nΆρθρο {number}\n"

        return re.sub(r"[ΆΑ]ρθρο\s*:\s*(\d+)", turned, t)

    got = spark.createDataFrame(rows, "t string").select(text.article_markers(F.col("t")).alias("u"))
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    assert [r.u for r in got.collect()] == [plain(t) for t, in rows]


def test_every_character_is_composed_as_python_does(spark):
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    rows = spark.range(1, 0x110000).where("id < 55296 or id > 57343").select(F.concat(F.lit("e"), char).alias("t"))
    assert rows.where(text.composed(F.col("t")) != text.nfc(F.col("t"))).count() == 0
    turned = rows.select(text.search_key_of(F.col("t")).alias("a"), text.search_key_any(F.col("t")).alias("b"))
    assert turned.where("a != b").count() == 0


def test_only_texts_that_need_it_go_to_python(spark):
    rows = spark.createDataFrame([("απλό κείμενο",), ("e\u0301",), (None,)], "t string")
    assert [r[0] for r in rows.select(text.composed(F.col("t"))).collect()] == ["απλό κείμενο", "é", None]
    plan = rows.select(text.composed(F.col("t")))._jdf.queryExecution().executedPlan().toString()
    assert "CASE WHEN RLIKE" in plan and "ArrowEvalPython" in plan


def test_strip_takes_all_white_space(spark):
    assert one(spark, text.strip, "\u3000\x85\n\t a\u2003b \u00a0\u2029") == "a\u2003b"


def test_normalising_reads_a_text_once(spark):
    rows = spark.createDataFrame([("Άρθρο 1\nΚΑTΑ plain oxo",)], "t string").repartition(2)
    out = rows.select(text.normalise(F.col("t")).alias("u"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Προισχύσασες") == 1
    assert out.first().u == "Άρθρο 1\nΚΑΤΑ plain oxo"
