"""Text functions of the legal corpus, as column expressions.

Java's regular expressions need (?U) for word classes beyond ASCII, (?iu) for
case-blind Greek and (?d) so that `$` knows no line end but the newline.
Only Unicode normal forms are Arrow-batched functions, for texts that need them;
everything else stays in the JVM.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache, reduce
from itertools import chain

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexicord.functions import rules


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Composed form."""
    return text.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


@F.pandas_udf(T.StringType())
def search_key_any(text: pd.Series) -> pd.Series:
    """search_key for any script."""

    def key(t: str) -> str:
        bare = "".join(c for c in unicodedata.normalize("NFD", t.lower()) if not unicodedata.combining(c))
        return unicodedata.normalize("NFC", bare).replace("ς", "σ")

    return text.map(key, na_action="ignore")


#: All white space, as strip() takes it off.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


@lru_cache(maxsize=1)
def not_composed() -> str:
    """A pattern of the characters that composing may change: marks, second parts of pairs, and those that have another form alone.

    Plain letters are left out first, so that usual texts are read once.
    """
    found = set(range(0x1160, 0x1200))  # medial and final Hangul letters
    for k in range(0xC0, 0x30000):
        c = chr(k)
        if not 0xAC00 <= k < 0xE000:
            parts = unicodedata.decomposition(c)
            if unicodedata.combining(c) or (parts and parts[0] != "<" and unicodedata.normalize("NFC", c) != c):
                found.add(k)
            if parts and parts[0] != "<" and " " in parts:
                found.add(int(parts.split(" ")[1], 16))
    ranges: list[list[int]] = []
    for k in sorted(found):
        if ranges and ranges[-1][1] == k - 1:
            ranges[-1][1] = k
        else:
            ranges.append([k, k])
    return "[[^\\x{0}-\\x{2FF}\\x{388}-\\x{3CE}\\x{2010}-\\x{2027}]&&[\\p{M}" + "".join(f"\\x{{{a:X}}}-\\x{{{z:X}}}" for a, z in ranges) + "]]"


def composed(c: Column) -> Column:
    """Composed form.  Only texts that hold a character which composing may change go to a Python worker, others pass as null."""
    # a text of usual characters alone is one greedy run, which is read faster than a search
    usual = c.rlike(r"^[\x{0}-\x{2FF}\x{386}\x{388}-\x{3CE}\x{2010}-\x{2027}]*+\z")
    return F.coalesce(nfc(F.when(usual, F.lit(None).cast("string")).when(c.rlike(not_composed()), c)), c)


def article_markers(c: Column) -> Column:
    """Database markers of articles become headings, unless the article's own heading follows within reach; number 0 none.

    A look-ahead takes what is in reach of each marker, where its cut counts as the
    line's end; the text is put together from what stands between markers.
    """
    seen = f"(?Us){rules.ARTICLE_MARKER}(?=(.{{0,{rules.HEADING_REACH}}}))"
    marker = f"(?U){rules.ARTICLE_MARKER}"
    before, after = rules.OWN_HEADING

    def turned(number: Column, below: Column) -> Column:
        own = (number == "0") | F.rlike(below, F.concat(F.lit(f"(?md){before}"), number, F.lit(after)))
        return F.when(own, "\n").otherwise(F.concat(F.lit("\nΆρθρο "), number, F.lit("\n")))

    heads = F.zip_with(F.regexp_extract_all(c, F.lit(seen), F.lit(1)), F.regexp_extract_all(c, F.lit(seen), F.lit(2)), turned)
    whole = F.zip_with(between(c, marker), F.concat(heads, F.array(F.lit(""))), lambda part, head: F.concat(part, head))
    return F.when(c.rlike(marker), F.array_join(whole, "")).otherwise(c)


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(c, F.lit(BLANKS))


def replace_characters(c: Column) -> Column:
    """Characters that extraction gets wrong, one for one, and ligatures."""
    out = F.translate(c, rules.REPLACED, rules.REPLACEMENTS)
    return reduce(lambda t, x: F.replace(t, F.lit(x[0]), F.lit(x[1])), rules.LIGATURES.items(), out)


def join_hyphens(c: Column) -> Column:
    """A word cut by a hyphen at a line's end is one word."""
    return F.regexp_replace(c, "(?U)(\\w)[-­]\\n(\\w)", "$1$2")


#: All kinds of page noise as one alternation, each with its own flags, tried at a line's start only.
NOISE = "^(?:" + "|".join(re.sub(r"^\(\?(\w+)\)(.*)$", r"(?\1:\2)", p) for p in rules.PAGE_NOISE) + ")"


def is_noise(line: Column) -> Column:
    """Page headers, page numbers and blank lines."""
    return line.rlike(NOISE)


def drop_noise(c: Column) -> Column:
    return F.array_join(F.filter(F.split(c, "\n"), lambda line: ~is_noise(line)), "\n")


def drop_database_traces(c: Column) -> Column:
    return bound(reduce(lambda t, p: F.regexp_replace(t, p, "\n"), rules.DATABASE_TRACES, c), article_markers)


def repair_lookalikes(c: Column) -> Column:
    """Latin letters inside words that hold a Greek letter become the Greek ones they look like."""
    words = F.regexp_extract_all(c, F.lit(r"(?U)([^\W\d_]+|[\W\d_]+)"), F.lit(1))
    repaired = F.array_join(F.transform(words, lambda w: F.when(w.rlike("[Ͱ-Ͽἀ-῿]"), F.translate(w, rules.LOOKALIKES_LATIN, rules.LOOKALIKES_GREEK)).otherwise(w)), "")
    # only a text with both scripts in one word is taken apart; each word is looked at from its start
    letter = r"[^\W\d_]"
    mixed = rf"(?U)(?<!{letter})(?={letter}*?[Ͱ-Ͽἀ-῿]){letter}*?[{rules.LOOKALIKES_LATIN}]"
    return F.when(c.rlike(mixed), repaired).otherwise(c)


def collapse_blanks(c: Column) -> Column:
    return F.regexp_replace(c, "[ \t]{2,}", " ")


def tidy(c: Column) -> Column:
    """Runs of blanks and of newlines shortened, lines without trailing and the whole without outer white space."""
    out = F.regexp_replace(collapse_blanks(c), "\n{3,}", "\n\n")
    return strip(F.regexp_replace(out, r"(?Umd)[^\S\n]+$", ""))


def normalise(c: Column, noise: bool = True, unicode_forms: bool = True) -> Column:
    """The whole normalisation; the order matters.  Without unicode_forms it assumes composed text without database traces."""
    out = replace_characters(composed(c) if unicode_forms else c)
    out = join_hyphens(out)
    if noise:
        out = drop_noise(drop_database_traces(out) if unicode_forms else out)
    return tidy(bound(out, repair_lookalikes))


def search_key(c: Column) -> Column:
    """Lower case, without accents or final sigma, for monotonic Greek and Latin-1 letters; search_key_any does any script."""
    accented = "άέήίόύώϊϋΐΰςàáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
    return F.translate(F.lower(c), accented, "αεηιουωιυιυσaaaaaaceeeeiiiinooooouuuuyy")


#: Texts that search_key() turns as search_key_any() does: monotonic Greek, Latin-1, usual marks.
PLAIN = r"^[\x{0}-\x{7F}\x{A0}-\x{FF}\x{386}\x{388}-\x{3CE}\x{2010}-\x{2027}]*$"


def search_key_of(c: Column) -> Column:
    """The search key of any text; only those with other characters than PLAIN go to a Python worker."""
    return F.coalesce(search_key_any(F.when(~c.rlike(PLAIN), c)), search_key(c))


def gazette_verified(raw: Column, number: Column, year: Column) -> Column:
    """Number and year both occur in the first 8000 characters; false without a gazette."""
    key = search_key(normalise(F.left(raw, F.lit(8000)), noise=False, unicode_forms=False))
    return F.coalesce(bound(key, lambda k: F.contains(k, number.cast("string")) & F.contains(k, year.cast("string"))), F.lit(False))


def one_line(c: Column) -> Column:
    """Lines joined by single blanks, blank ones dropped."""
    return F.array_join(F.filter(F.transform(F.split(c, "\n"), strip), lambda x: x != ""), " ")


def bound(value: Column, body) -> Column:
    """body(value), with the value computed once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def between(c: Column, pattern: str) -> Column:
    """What stands between the matches of a pattern.

    split() makes its pattern anew for each text, so matches become one control
    character first, unless the text holds that itself.
    """
    cut = F.split(F.regexp_replace(c, pattern, "\u0001"), "\u0001")
    return F.when(F.contains(c, F.lit("\u0001")), F.split(c, pattern)).otherwise(cut)


def speak_letters(c: Column) -> Column:
    """A letter with a tonos mark becomes its name, with a blank if a letter follows.

    The text is cut into marked letters and what stands between them, and each
    marked letter is looked up, so that the table costs no code of its own.
    """
    marked = "\\b(?:στ|[Α-Ωα-ρσ-ω])[΄'`]"
    spoken = dict(rules.LETTER_NAMES) | {k.upper(): v.capitalize() for k, v in rules.LETTER_NAMES.items() if len(k) == 1}
    names = F.create_map(*[F.lit(x) for x in chain(*spoken.items())])
    apart = F.regexp_replace(c, f"(?U)({marked})(?=[^\\W\\d_])", "$1 ")

    def said(t: Column) -> Column:
        found = F.regexp_extract_all(t, F.lit(f"(?U){marked}"), F.lit(0))
        spoken_ = F.transform(found, lambda x: F.coalesce(F.try_element_at(names, F.regexp_replace(x, "[΄'`]$", "")), x))
        return F.array_join(F.zip_with(between(t, f"(?U){marked}"), F.concat(spoken_, F.array(F.lit(""))), lambda part, letter: F.concat(part, letter)), "")

    # word boundaries of all scripts are slow, so the mark after a letter is looked for first
    return F.when(c.rlike("[Α-Ωα-ω][΄'`]") & c.rlike(f"(?U){marked}"), bound(apart, said)).otherwise(c)


def speak_numbers(c: Column) -> Column:
    """237/1986 becomes 237 του 1986."""
    return F.when(F.contains(c, F.lit("/")), F.regexp_replace(c, r"(?U)\b(\d{1,5})/((?:19|20)\d{2})\b", "$1 του $2")).otherwise(c)


def pronounce(c: Column) -> Column:
    """Text as it is read aloud: one chain of replacements, in the order of the rule tables."""
    start = "(?U)(?<![Α-Ωα-ωA-Za-z])"
    steps = [(rf"{start}{p}\s*(?=\d)", f"{said} ") for p, said in rules.ACTS]
    steps += [(rf"{start}{p}\s*(?=[\dΑ-Ωα-ω])", f"{said} ") for p, said in rules.NUMBERED]
    steps += [(f"{start}{p}", said) for p, said in rules.ALONE]
    # a step's pattern is searched only in texts that hold its plain letters
    plain = [re.sub(r"\\b$|\\\.\?$", "", p).replace("\\", "") for p, _ in (*rules.ACTS, *rules.NUMBERED, *rules.ALONE)]
    turned = lambda letters, step: lambda t: F.when(F.contains(t, F.lit(letters)), F.regexp_replace(t, *step)).otherwise(t)
    # nor any of them in a text without a Greek letter before a point or stroke, or the plain letters of the others
    likely = "|".join(["[α-ω][./]", *(re.escape(p) for p in plain if not re.search("[α-ω][./]", p))])
    out = bound(c, lambda whole: F.when(whole.rlike(likely), reduce(lambda t, s: bound(t, turned(*s)), zip(plain, steps), whole)).otherwise(whole))
    out = bound(bound(out, speak_letters), speak_numbers)
    out = F.replace(F.replace(out, F.lit("%"), F.lit(" τοις εκατό")), F.lit("€"), F.lit(" ευρώ"))
    return strip(collapse_blanks(out))


def content_kind(content: Column) -> Column:
    """What a file is, by its first bytes."""

    def starts(magic: bytes) -> Column:
        return F.substring(content, 1, len(magic)) == F.lit(bytearray(magic))

    head = F.lower(F.regexp_replace(F.decode(F.substring(content, 1, 400), "ISO-8859-1"), r"^\s+", ""))
    return (
        F.when(starts(b"%PDF-"), "pdf")
        .when(starts(b"\xd0\xcf\x11\xe0"), "doc")
        .when(starts(b"PK\x03\x04"), "zip")
        .when(starts(b"{\\rtf"), "rtf")
        .when(head.startswith("<!doctype") | head.startswith("<html") | head.startswith("<?xml"), "html")
        .otherwise("unknown")
    )
