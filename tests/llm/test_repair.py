import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from lexicord.llm import queries, repair

BLANK = re.compile(r"[^\x20\x09-\x0D]")


def all_edits(codes):
    """(cost, audit) of the best of all edits of a short conversation, by trying each."""
    best = None
    gaps = ["", "I", "II"]
    for edits in product(*[["D"] if c == "x" else ["K", "R", "D"] for c in codes]):
        for inserts in product(gaps, repeat=len(codes) + 1):
            audit = inserts[0] + "".join(e + g for e, g in zip(edits, inserts[1:]))
            cost = 3 * audit.count("I") + 3 * audit.count("R") + 4 * audit.count("D") + 3 * sum(c.isupper() for c, e in zip(codes, edits) if e != "D")
            if best is not None and (cost, audit) >= best:
                continue
            # the role that an R or I must take is set by its place; a first s shifts the others by one
            row, roles = 0, ""
            for x in audit:
                if x in "KRD":
                    own, row = codes[row].lower(), row + 1
                if x == "D":
                    continue
                need = "a" if roles[-1:] == "u" else "u"
                roles += own if x == "K" else need
            if re.fullmatch("(s?(ua)+)?", roles):
                best = (cost, audit)
    return best


def test_cheapest_equals_all_edits():
    rng = random.Random(3)
    cases = ["".join(p) for n in range(4) for p in product("xsuaoU", repeat=n)] + ["".join(rng.choice("xsuaoSUAO") for _ in range(4)) for _ in range(25)]
    for codes in cases:
        assert repair.cheapest(codes) == all_edits(codes), codes


def plain(codes):
    """The same by dynamic programming over rows, for any length."""
    best = {0: (0, "")}

    def inserted(at):
        for _ in range(3):
            for q, (c, a) in list(at.items()):
                t = repair.NEXT[q][1]
                at[t] = min(at.get(t, (c + 3, a + "I")), (c + 3, a + "I"))
        return at

    best = inserted(best)
    for x in codes:
        new = {}
        for q, (c, a) in best.items():
            for w, e, t in repair.step_edges(x, q):
                new[t] = min(new.get(t, (c + w, a + e)), (c + w, a + e))
        best = inserted(new)
    return min(best[q] for q in repair.ENDS if q in best)


def test_cheapest_equals_plain_search_on_long_ones():
    rng = random.Random(8)
    for _ in range(300):
        codes = "".join(rng.choice(rng.choice(("ua", "uuax", "xsuaoSUAO"))) for _ in range(rng.randint(5, 60)))
        assert repair.cheapest(codes) == plain(codes), codes


def brute(rows):
    """All columns for (conv_id, turn, role, text) rows."""
    told, by_conv = [], {}
    for conv, turn, role, text in rows:
        own = by_conv.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv, own in by_conv.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        counts, codes = [0, 0, 0], ""
        for k, (_, role, text) in enumerate(own):
            end = "".join(BLANK.findall(text))[-1:]
            code = role[:1] if role[:1] and role[:1] in "sua" else "o"
            if not end:
                counts[0] += 1
                code = "x"
            elif any(r[1:] == (role, text) for r in own[:k]):
                counts[1] += 1
                code = "x"
            elif end not in ".!?":
                counts[2] += 1
                code = code.upper()
            codes += code
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        bad = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit = plain(codes)
        out, state, row = [], "", 0
        for x in audit:
            role, text = ("", "") if x == "I" else own[row][1:]
            row += x != "I"
            if x != "D":
                role = role if x == "K" else "assistant" if state == "u" else "user"
                state = role[:1]
                out.append(f"{role}:{text}")
        told.append((conv, gaps, *counts, bad, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()))
    return sorted(told, key=repr)


@pytest.fixture(scope="module")
def rows():
    """Conversations of any shape; a large one; null ids, turns, roles and texts; repeated rows; blank and very long texts."""
    rng = random.Random(6)
    out = []
    for conv in range(120):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(("user", "assistant", "user", "assistant", "system", "tool", "usr", "", None)) if conv % 3 else ("user", "assistant")[turn % 2]
            text = rng.choice((f"Text {turn}.", "Again!", "Again!", "cut", " \n", "", None, f"q{conv}?  ", "é. ", "a.b"))
            out.append((conv, turn * rng.choice((1, 1, 1, 3)) if turn else rng.choice((0, None)), role, text))
    out = list({(c, t): (c, t, r, x) for c, t, r, x in out}.values())  # one row a turn
    out += [(500, t, ("user", "assistant", "system")[t % 3 if t % 7 == 0 else t % 2], f"Part {t % 90}." if t % 5 else "No end") for t in range(400)]
    out += [(None, t, "user", "x.") for t in range(5)] + [(501, None, "user", "same.")] * 30 + [(502, 1, "assistant", "y" * 300_000)]
    return out + [(503, t, "user", "") for t in range(3)]


@pytest.fixture(params=[256, 3])
def small(request, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT", request.param)


def test_equals_brute_force(spark, rows, small):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn int, role string, text string, seg int, kind string").repartition(5)
    got = repair.structure_repair(df)
    assert got.columns == ["conv_id", *repair.COUNTS, "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_text_ids_and_pieces(spark):
    rows = [("b", 2, "assistant", "B."), ("b", 1, "user", "A"), ("a", 5, "system", "S.")]
    counts, texts = repair.repair(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string"))
    got = {r.conv_id: r.audit for r in counts.collect()}
    assert got == {"a": "D", "b": "KK"} and {r.conv_id: r.repaired for r in texts.where("repaired != ''").collect()} == {"b": "user:A\nassistant:B."}


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.structure_repair(none).count() == 0


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, queries.op13_structure_repair(spark, sf_dir).collect()), key=repr) == brute(rows)
