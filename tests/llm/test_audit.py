import random
from itertools import permutations

import duckdb
import pytest

from lexicord.llm import filteraudit, queries


@pytest.fixture(scope="module")
def rows():
    """(doc_id, text, source): texts on both sides of every limit, copies, ties, null and empty values, repeated rows, a very long text."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(900)]
    out = []
    for i in range(150):
        n = rng.choice((0, 1, 50, 199, 200, 201, 400))
        own = [rng.choice(words[: rng.choice((90, 101, 900))]) for _ in range(n)]
        for _ in range(rng.choice((0, 0, 3, 60)) if own else 0):
            k = rng.randrange(n)
            own[k] = own[k].upper()
        if own and rng.random() < 0.3:
            own[rng.randrange(n)] += rng.choice("#$%&*|")
        out.append((i, rng.choice((" ", "\n", "\x0b\t", " \x0c")).join(own), rng.choice(("a", "b", "b", "b", None, ""))))
    out += [(200 + i, out[rng.randrange(150)][1], rng.choice(("a", "b"))) for i in range(60)]
    out += [(300, None, "b"), (301, "", None), (302, "é" * 50 + "A", "b"), (303, "é" * 49 + "A", "b"), (304, "x " * 300_000, "long"), (305, "nb sp " * 250, "c")]
    return out + [out[3], out[3], (7, "another text of one id", "a"), (None, out[5][1], "a"), (None, None, None)]


def labels_of(spark, rows):
    rng = random.Random(9)
    told = [(i, rng.choice((0, 1, None)), rng.choice((0, 1, None))) for i in range(0, 300, 2)] + [(4, 1, 0), (None, 1, 1), (9999, 1, 1)]
    return told, spark.createDataFrame(told, "doc_id long, quality int, toxic int")


def brute(rows, labels):
    import re

    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs = []
    for i, text, part in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = "".join(
            f for f, bad in (
                ("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)), ("C", 100 * len(re.findall("[A-Z]", t)) > 2 * len(t)), ("D", bool(re.search("[#$%&*|]", t))),
                ("E", i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows)),
            ) if bad
        )
        docs.append((part or "", fails, i in good, i in toxic))
    out = []
    for part in {d[0] for d in docs}:
        own, removed_by, lines = [d for d in docs if d[0] == part], dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order):
                removed = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                removed_by[f] += len(removed)
                lines.append((f, [part, "".join(order), step + 1, len(left), len(removed), sum(f in d[1] for d in own) - len(removed), sum(d[1] == f for d in own), sum(d[2] for d in removed), sum(d[3] for d in removed)]))
        out += [tuple(line + [removed_by[f]]) for f, line in lines]
    return sorted(out)


@pytest.fixture(params=[True, False])
def small(request, monkeypatch):
    """Once with shards and dictionaries of a few words."""
    if request.param:
        monkeypatch.setattr(filteraudit, "SHARD_BYTES", 900)
        monkeypatch.setattr(filteraudit, "DICTIONARY_WORDS", 150)


def test_equals_brute_force(spark, rows, small):
    told, labels = labels_of(spark, rows)
    docs = spark.createDataFrame([(i, t, s, 1, 2) for i, t, s in rows], "doc_id long, text string, source string, part int, fails int").repartition(3)
    got = sorted(map(tuple, filteraudit.filter_audit(docs, labels).collect()))
    assert got == brute(rows, told)


def test_matrix_holds_every_word(spark, rows, small):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(2)
    lines, words = filteraudit.document_terms(docs)
    name = {r.column: r.word for r in words.collect()}
    assert len(name) == words.count() and sorted(name) == list(range(len(name)))
    got = sorted((sorted((name[c], n) for c, n in zip(r["columns"], r["counts"])) for r in lines.collect()))
    import re
    from collections import Counter

    assert got == sorted(sorted(Counter(re.findall(r"[^\x20\x09-\x0D]+", t or "")).items()) for _, t, _ in rows)


def test_empty_table(spark, rows):
    _, labels = labels_of(spark, rows)
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert filteraudit.filter_audit(none, labels).count() == 0
    one = spark.createDataFrame([(1, "w", None)], "doc_id long, text string, source string")
    assert filteraudit.filter_audit(one, labels.limit(0)).count() == 600


def test_query_equals_its_sql(spark, sf_dir):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    told = con.sql(queries.oracle_sql()["op12_filter_audit"])
    got = queries.op12_filter_audit(spark, sf_dir)
    assert sorted(map(tuple, got.select(*told.columns).collect())) == sorted(told.fetchall())
    assert dict(got.dtypes) == {c: {"VARCHAR": "string", "INTEGER": "int", "BIGINT": "bigint"}[str(t)] for c, t in zip(told.columns, told.types)}
