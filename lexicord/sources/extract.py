"""Text out of files: HTML pages, legacy Word documents, PDF where a reader is installed.

The work of a file stays in one task; files are spread by Spark.  A file that
cannot be read gives an error, never a failed job.
"""

from __future__ import annotations

import io
import re
import struct
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexicord.functions import rules

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Texts(HTMLParser):
    """Text nodes under each container, outside dropped elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, set[str]]] = []
        self.texts: dict[str, list[str]] = {}
        self.closed: set[str] = set()

    def handle_starttag(self, tag, attrs):
        told = dict(attrs)
        names = {tag, f"#{told.get('id') or ''}", *(f".{c}" for c in (told.get("class") or "").split())}
        found = {c for c in (*rules.CONTAINERS, "body") if c in names and c not in self.texts}
        for c in found:
            self.texts[c] = []
        if tag not in VOID:
            self.open.append((tag, found))

    def handle_endtag(self, tag):
        if tag in (t for t, _ in self.open):
            while self.open:
                t, found = self.open.pop()
                self.closed |= found
                if t == tag:
                    break

    def handle_data(self, data):
        if data.strip() and not any(t in rules.DROPPED_TAGS for t, _ in self.open):
            for _, found in self.open:
                for c in found - self.closed:
                    self.texts[c].append(data.strip())


def html_text(html: str) -> str:
    """Text of the first container that the page has, else of its body; pieces on lines of their own."""
    p = _Texts()
    p.feed(html)
    p.close()
    for c in (*rules.CONTAINERS, "body"):
        if c in p.texts:
            return "\n".join(p.texts[c])
    return html_text(f"<body>{html}</body>") if "<body>" not in html else ""  # a fragment is a body


class BadFile(ValueError):
    """A file that is not what it should be."""


def ole_streams(data: bytes) -> dict[str, bytes]:
    """Streams of a compound file by name."""
    if data[:8] != bytes.fromhex("d0cf11e0a1b11ae1"):
        raise BadFile("no compound file")
    if struct.unpack_from("<H", data, 30)[0] not in (9, 12) or struct.unpack_from("<H", data, 32)[0] != 6:
        raise BadFile("odd sector sizes")
    sector, small = 1 << struct.unpack_from("<H", data, 30)[0], 1 << struct.unpack_from("<H", data, 32)[0]
    n_fat, first_dir, cutoff, first_mini = struct.unpack_from("<I4xI", data, 44)[0], struct.unpack_from("<I", data, 48)[0], struct.unpack_from("<I", data, 56)[0], struct.unpack_from("<I", data, 60)[0]
    next_difat = struct.unpack_from("<I", data, 68)[0]
    fat_sectors = list(struct.unpack_from("<109I", data, 76))

    def at(k: int) -> bytes:
        return data[sector * (k + 1) : sector * (k + 2)]

    seen_difat = set()
    while next_difat < 0xFFFFFFFA and next_difat not in seen_difat:
        seen_difat.add(next_difat)
        more = struct.unpack(f"<{sector // 4}I", at(next_difat))
        fat_sectors += more[:-1]
        next_difat = more[-1]
    fat = [x for k in fat_sectors[:n_fat] for x in struct.unpack(f"<{sector // 4}I", at(k))]

    def chain(k: int, table: list[int], part) -> bytes:
        out, seen = [], set()
        while k < 0xFFFFFFFA and k not in seen and k < len(table):
            seen.add(k)
            out.append(part(k))
            k = table[k]
        return b"".join(out)

    folder = chain(first_dir, fat, at)
    entries = []
    for i in range(0, len(folder) - 127, 128):
        size = struct.unpack_from("<H", folder, i + 64)[0]
        name = folder[i : i + max(0, size - 2)].decode("utf-16-le", "replace")
        entries.append((name, folder[i + 66], *struct.unpack_from("<IQ", folder, i + 116)))
    root = next((e for e in entries if e[1] == 5), None)
    mini = chain(root[2], fat, at) if root else b""
    mini_raw = chain(first_mini, fat, at)
    mini_fat = list(struct.unpack(f"<{len(mini_raw) // 4}I", mini_raw))
    streams = {}
    for name, kind, first, size in entries:
        if kind == 2:
            body = chain(first, fat, at) if size >= cutoff else chain(first, mini_fat, lambda k: mini[small * k : small * (k + 1)])
            streams[name] = body[:size]
    return streams


def word_text(document: bytes, tables: dict[str, bytes]) -> str:
    """Main text of a Word document from its main stream and its table streams, put together from the piece table."""

    def u16(b: bytes, at: int) -> int:
        return struct.unpack_from("<H", b, at)[0]

    def u32(b: bytes, at: int) -> int:
        return struct.unpack_from("<I", b, at)[0]

    try:
        if u16(document, 0) != 0xA5EC:
            raise BadFile("no Word document")
        words = 0x22 + 2 * u16(document, 0x20)
        longs = words + 2
        pairs = longs + 4 * u16(document, words) + 2
        main, at, size = u32(document, longs + 12), u32(document, pairs + 33 * 8), u32(document, pairs + 33 * 8 + 4)
        table = tables.get("1Table" if u16(document, 10) & 0x0200 else "0Table")
        if table is None or not size or at + size > len(table):
            raise BadFile("no piece table")
        clx, k = table[at : at + size], 0
        while k < len(clx) and clx[k] == 1:
            k += 3 + struct.unpack_from("<h", clx, k + 1)[0]
        if k >= len(clx) or clx[k] != 2:
            raise BadFile("no piece table")
        plc = clx[k + 5 : k + 5 + u32(clx, k + 1)]
        n = (len(plc) - 4) // 12
        if n <= 0:
            raise BadFile("no pieces")
        places = [u32(plc, 4 * i) for i in range(n + 1)]
        page = "cp1253" if u16(document, 6) == 0x0408 else "cp1252"
        out = []
        for i in range(n):
            length = min(places[i + 1], main) - places[i]
            if places[i] >= main or length <= 0:
                continue
            where = u32(plc, 4 * (n + 1) + 8 * i + 2)
            if where & 0x40000000:
                start = (where & 0x3FFFFFFF) // 2
                out.append(document[start : start + length].decode(page, "replace"))
            else:
                start = where & 0x3FFFFFFF
                out.append(document[start : start + 2 * length].decode("utf-16-le", "replace"))
    except struct.error as e:
        raise BadFile("cut short") from e
    return plain_word_text("".join(out))


def plain_word_text(text: str) -> str:
    """Without field instructions and control characters; ends of paragraphs, lines, pages and cells are newlines."""
    text = re.sub("\x13[^\x14\x15]*[\x14\x15]?|[\x14\x15]", "", text)
    return text.translate({**dict.fromkeys(map(ord, "\x01\x02\x03\x04\x05\x06\x08\x1f")), **dict.fromkeys(map(ord, "\r\x0b\x0c\x07"), "\n"), 0x1E: "-", 0xA0: " ", 9: " "})


def file_text(content: bytes) -> tuple[str | None, str | None]:
    """Text and error of one file, by its first bytes."""
    try:
        if content.startswith(b"%PDF-"):
            return pdf_text(content), None
        if content.startswith(b"\xd0\xcf\x11\xe0"):
            streams = ole_streams(content)
            if "WordDocument" not in streams:
                raise BadFile("no WordDocument stream")
            return word_text(streams["WordDocument"], streams), None
        return html_text(content.decode("utf-8", "replace")), None
    except Exception as e:  # whatever a reader raises on a broken file is that file's error, not the job's
        return None, f"{type(e).__name__}: {e}"


def pdf_text(content: bytes) -> str:
    """Text of a PDF, two columns read one after the other; needs the optional package pdfplumber."""
    import pdfplumber

    out = []
    with pdfplumber.open(io.BytesIO(content)) as pdf:
        for p in pdf.pages:
            try:
                words = p.extract_words(x_tolerance=2) or []
                cut = gutter([(float(w["x0"]), float(w["x1"])) for w in words], float(p.width))
                parts = [p] if cut is None else [p.crop((0, 0, cut, p.height)), p.crop((cut, 0, p.width, p.height))]
                out += [part.extract_text(x_tolerance=2) or "" for part in parts]
            except Exception:  # a broken page does not cost the others
                continue
    return "\n".join(out)


def gutter(words: list[tuple[float, float]], width: float) -> float | None:
    """Gutter of one page; operators.pages.gutters finds them for a table of words."""
    if len(words) < rules.LEAST_WORDS:
        return None
    low, high = rules.GUTTER_PERCENTS
    places = [width * k / 100 for k in range(low, high + 1)]
    crossed = [sum(a < x < b for a, b in words) for x in places]
    if min(crossed) / len(words) >= rules.CROSSING_SHARE:
        return None
    ties = [x for x, c in zip(places, crossed) if c == min(crossed)]
    return ties[len(ties) // 2]


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("error", T.StringType())]))
def extracted(content: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([file_text(bytes(c)) if c is not None else (None, "no content") for c in content], columns=["text", "error"])


@F.pandas_udf(T.StringType())
def page_text(html: pd.Series) -> pd.Series:
    return html.map(html_text, na_action="ignore")
