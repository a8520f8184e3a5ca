import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexicord.llm import components, linededup, neardup, ngramjoin, suffixdedup


def shingle_sets(rows, k):
    out = []
    for i, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower())
        out.append((i, {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())))
    return out


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80), (2, 60)])
def test_document_components(spark, docs, texts, k, percent):
    sets = shingle_sets(texts, k)
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in sets:
        for j, b in sets:
            if None not in (i, j) and a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    got = ngramjoin.document_components(docs, k, percent).collect()
    assert len(got) == len(texts)
    assert sorted((r.doc_id, r.n_shingles) for r in got if r.doc_id is not None) == sorted((i, len(s)) for i, s in sets if i is not None)
    assert all(r.component_id == find(r.doc_id) for r in got if r.doc_id is not None)
    assert [r.component_id for r in got if r.doc_id is None] == [None]


def test_components_of_empty_tables(spark, none):
    assert ngramjoin.document_components(none).count() == 0
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 90), (5, 5)], "a long, b long")
    got = {r.id: r.component_id for r in components.components(edges).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 90, 90: 90}
    assert components.components(edges.limit(0)).count() == 0


def brute_removed(rows, length):
    seen, out = {}, []
    keyed = [(i if i is not None else 1 << 63, (t or "").encode()) for i, t in rows]
    for i, b in keyed:
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            seen[w] = min(seen.get(w, i), i)
    for i, b in keyed:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] < i:
                gone[k : k + length] = True
        runs = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out.append((None if i == 1 << 63 else i, len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block, most", [(40_000, 20_000), (20, 3)])
def test_repeated_strings(spark, docs, texts, block, most):
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in suffixdedup.repeated_strings(docs, 50, block, most).collect()]
    assert sorted(got, key=repr) == brute_removed(texts, 50)


def test_suffix_order():
    body = np.frombuffer(b"bananaanabananas", np.uint8)
    starts = np.array([0, 6, 9, 16])
    docs, place = suffixdedup.suffix_order(body, starts)
    raw = body.tobytes()
    suffixes = [raw[p : starts[d + 1]] for d, p in zip(docs, place)]
    assert suffixes == sorted(suffixes) and len(suffixes) == len(body) + 3


def test_repeated_strings_of_empty_table(none):
    assert suffixdedup.repeated_strings(none).count() == 0


@pytest.mark.parametrize("few", [1_000, 2])
def test_near_duplicates(spark, monkeypatch, few):
    monkeypatch.setattr(neardup, "FEW", few)
    rng = np.random.default_rng(1)
    base = rng.standard_normal((40, 16))
    rows = [(k, base[k % 40] + rng.standard_normal(16) * 0.06 * (k >= 40), k % 3) for k in range(160)]
    rows = [(i, v.astype(np.float32).tolist(), label) for i, v, label in rows]
    rows += [(200, rows[0][1], 0), (201, rows[0][1], 0), (202, rows[0][1], None), (203, [0.0] * 16, 0), (204, None, 0), (205, [float("nan")] * 16, 0), (206, [None] * 16, 0), (207, [], 0), (208, [1.0, 2.0], 0), (209, [2 * x for x in rows[0][1]], 0)]
    df = spark.createDataFrame([(*r, "x", 1) for r in [*rows, rows[3]]], "vec_id long, embedding array<float>, label int, id string, at int")
    got = {r.vec_id: r for r in neardup.near_duplicates(df).collect()}
    ids = [i for i, v, label in rows if label is not None and v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    vec = {i: np.array(v, float) / np.linalg.norm(np.array(v, float)) for i, v, _ in rows if i in ids}
    label = {i: x for i, _, x in rows}
    links = {i: {j for j in ids if j != i and label[i] == label[j] and vec[i] @ vec[j] >= 0.98} for i in ids}
    found, true = sum(got[i].n_links for i in ids), sum(map(len, links.values()))
    assert true > 60 and 0.99 * true <= found <= true and all(got[i].n_links <= len(links[i]) for i in ids)
    for i in set(got) - set(ids):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[200].component_id == got[201].component_id == got[209].component_id == 0 and not got[200].kept
    assert len(got) == len(rows)
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def units(vectors):
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


@pytest.mark.parametrize("cut", [1, 2, 4, 8])
def test_pairs_that_pass_the_count(spark, cut):
    """Where rows meet changes nothing: pairs are those whose collisions reach the count, in whatever cells."""
    groups, size, step = 4, 8, 1_000
    rng = np.random.default_rng(11)
    at = np.rint(rng.standard_normal((400, 1)) * 3_000 + rng.standard_normal((400, 32)) * 400).astype(int)
    at[390:] = at[:10]
    base = np.arange(400) % 2
    df = spark.createDataFrame([(k, int(base[k]), at[k].tolist()) for k in range(400)], "id long, base long, at array<smallint>")
    met = neardup.meetings(df, step, groups, size, cut).distinct()
    at1, at2 = (df.select(F.col("id").alias(n), F.col("at").alias(f"at{k}")) for k, n in ((1, "a"), (2, "b")))
    got = [tuple(sorted(r)) for r in met.join(at1, "a").join(at2, "b").where(neardup.collisions(step) > 28).select("a", "b").collect()]
    hits = (np.abs(at[:, None] - at[None]) <= step + 1).sum(2)
    want = {(i, j) for i in range(400) for j in range(i + 1, 400) if base[i] == base[j] and hits[i, j] > 28}
    assert len(want) > 1_000 and len(got) == len(set(got)) and set(got) == want


def test_recall_at_the_threshold(spark):
    """Pairs planted at a cosine of 0.98 to 0.985 in one label, half of them far apart on the first projection."""
    rng = np.random.default_rng(3)
    turn = units(neardup.directions(32, 32)[:, :1].T)[0]
    base = units(rng.standard_normal((8000, 32)))
    cosine = rng.uniform(0.9801, 0.985, len(base))[:, None]
    off = turn - (base @ turn)[:, None] * base  # the step that moves the first projection most
    off[::2] = rng.standard_normal((len(base[::2]), 32))
    off -= (off * base).sum(1, keepdims=True) * base
    other = cosine * base + np.sqrt(1 - cosine**2) * units(off)
    rows = [(k, v.tolist(), 0) for k, v in enumerate(np.concatenate([base, other]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = np.zeros(len(rows), int)
    for r in neardup.near_duplicates(df).collect():
        got[r.vec_id] = r.n_links
    every = units(np.concatenate([base, other]))
    true = np.concatenate([(every[k : k + 2000] @ every.T >= 0.98).sum(1) - 1 for k in range(0, len(every), 2000)])
    even = np.arange(len(rows)) % 2 == 0
    print(f"recall at random {got[even].sum() / true[even].sum():.4f}, all {got.sum() / true.sum():.4f}")
    assert (got <= true).all() and got[even].sum() >= 0.995 * true[even].sum() and got.sum() >= 0.99 * true.sum()


def test_odd_magnitudes(spark):
    rows = [(1, [1e200, 2e200]), (2, [1.0, 2.0]), (3, [5e-324, 1e-323]), (4, [-1e200, -2e200]), (5, [1.0, 2.1])]
    df = spark.createDataFrame([(i, v, "a") for i, v in rows], "vec_id long, embedding array<double>, label string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in neardup.near_duplicates(df).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (0, 4), 5: (3, 1)}


def test_small_sets_share_a_rare_key(spark):
    rng = np.random.default_rng(6)
    rows = []  # (id, tokens, group)
    for k in range(10_000):
        n = 4 + k % 4
        tokens = np.sort(rng.integers(0, 1 << 63, n + 1).astype(np.int64))
        rows += [(2 * k, tokens.tolist(), 2 * k), (2 * k + 1, np.delete(tokens, rng.integers(n + 1)).tolist(), 2 * k + 1)]
    df = spark.createDataFrame(rows, "id long, tokens array<long>, group long")
    got = ngramjoin.rare_keys(df, 80).select("id", F.explode("mine").alias("key")).groupBy("key").agg({"id": "min", "*": "count"}).where("`count(1)` = 2").select("min(id)").distinct()
    assert {r[0] for r in got.collect()} == {2 * k for k in range(10_000)}


def test_chains_of_short_documents(spark):
    """Ends of a chain differ too much to link; the middle has the largest id and links both."""
    rng = np.random.default_rng(8)
    rows = []
    for k in range(10_000):
        n = 4 + k % 4
        w = [f"w{k}x{j}x{rng.integers(1 << 30)}" for j in range(n + 2)]
        rows += [(k, " ".join(w[:n] + w[n : n + 1])), (10_000 + k, " ".join(w[:n] + w[n + 1 :])), (20_000 + k, " ".join(w[:n]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngramjoin.document_components(df, 1, 80).collect()}
    assert got == {i: i % 10_000 for i, _ in rows}


@pytest.fixture
def rows_of_one_id():
    """Several null ids and an id with different texts; one of each equals an earlier document, others share a passage or a line with it."""
    word = iter(f"w{k}q{k * 7919 % 1000}" for k in range(10_000))
    line = lambda: " ".join(next(word) for _ in range(14))
    a, b, c = line(), line(), line()
    first = f"{a}\n{b}"
    return [(1, first), (2, c), (5, first), (5, f"{line()}\n{b}\n{line()}"), (5, f"{line()}\n{line()}"), (None, first), (None, f"{line()} {a}\n{c}"), (None, f"{line()}\n{line()}\n{b}"), (None, f"{c}\n{line()}"), (None, line())]


@pytest.mark.parametrize("block, most", [(40_000, 20_000), (3, 1)])
def test_repeated_strings_of_rows_with_one_id(spark, rows_of_one_id, block, most):
    df = spark.createDataFrame(rows_of_one_id, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in suffixdedup.repeated_strings(df, 50, block, most).collect()]
    assert sorted(got, key=repr) == brute_removed(rows_of_one_id, 50)


def test_lines_of_rows_with_one_id(spark, rows_of_one_id):
    df = spark.createDataFrame(rows_of_one_id, "doc_id long, text string")
    got = sorted((r.doc_id or 1 << 63, r.text) for r in linededup.line_dedup(df).collect())
    seen, want = {}, []
    for i, t in rows_of_one_id:
        for p, x in enumerate(t.split("\n")):
            seen[x] = min(seen.get(x, (1 << 64, 0)), (i or 1 << 63, p))
    for i, t in rows_of_one_id:
        want.append((i or 1 << 63, "\n".join(x for p, x in enumerate(t.split("\n")) if seen[x] >= (i or 1 << 63, p))))
    assert got == sorted(want)


def test_texts_of_one_id_are_one_document(spark):
    """What links with either text of an id is in its component; an empty text of it changes nothing."""
    word = iter(f"w{k}" for k in range(10_000))
    a, b, c = ([next(word) for _ in range(60)] for _ in range(3))
    rows = [(5, a), (5, b), (6, [*a, "x"]), (7, [*b, "y"]), (5, []), (3, c), (8, c), (8, [*a, "z"]), (-4, ["u"]), (-4, ["v"])]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = ngramjoin.document_components(df).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == sorted((i, -4 if i == -4 else 3 if w else i) for i, w in rows)


def test_the_bound_shuts_groups_out(spark):
    rows = [([1, 2, 3, 4], [1, 2, 3, 4, 9], 4), ([1, 2, 3, 4], [1, 2, 3, 4, 9], 5), ([1, 2, 3, 4], [1, 2, 3, 8, 9], 3), ([1], [], 1)]
    df = spark.createDataFrame(rows, "tokens array<long>, union array<long>, low int")
    assert [r[0] for r in df.select(ngramjoin.bound(F.col("tokens"), F.col("union"), F.col("low"), 90)).collect()] == [True, False, False, False]


@pytest.mark.parametrize("k, percent, most", [(3, 90, 9), (5, 80, 10)])
def test_copies_around_the_threshold(spark, k, percent, most):
    """Copies of one text with more and fewer edits, many just below and above the threshold of each other."""
    rng = np.random.default_rng(9)
    base, rows = [f"b{j}" for j in range(200)], []
    for i in range(700):
        w = list(base)
        for _ in range(int(rng.integers(1, most))):
            p, kind = int(rng.integers(len(w))), rng.integers(4)
            w[p : p + 1] = [w[p], f"n{rng.integers(60)}"] if kind == 0 else [] if kind == 1 else [f"n{rng.integers(60)}"]
        rows.append((i, " ".join(w)))
    sets = dict(shingle_sets(rows, k))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    assert 50 < len({find(i) for i in sets}) < 650
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngramjoin.document_components(df, k, percent).collect()}
    assert got == {i: find(i) for i in sets}
