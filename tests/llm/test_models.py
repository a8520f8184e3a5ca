import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexicord.llm import decontam, quality, queries, toxicity

LARGER = "/root/testdata/sf0.01"


def auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    pos = label == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())


@pytest.mark.parametrize("query, label, folds, held, least", [(queries.op6_toxicity, "toxic", 3, 1, 0.85), (queries.op9_quality, "quality", 5, 0, 0.97)])
def test_held_out_accuracy(spark, query, label, folds, held, least):
    rows = query(spark, LARGER).join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id").toPandas()
    assert (rows["held_out"] == rows["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % folds == held)).all()
    out = rows[rows["held_out"]]
    assert rows["score"].between(0, 1).all()
    assert auc(out["score"].to_numpy(), out[label].to_numpy()) >= least


@pytest.mark.parametrize("run", [toxicity.toxicity, quality.quality])
def test_edges(spark, run, docs, none):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(60)] + [(3, None, None), (3, 1, 1)], "doc_id long, quality int, toxic int")
    rows = run(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    assert run(none, labels).count() == 0
    assert len(run(docs, labels.limit(0)).collect()) == docs.count()


def test_chain_probabilities_equal_enumeration():
    rng = np.random.default_rng(0)
    e, pairs = rng.standard_normal(5), rng.standard_normal((2, 2))
    firsts = np.array([0, 3, 3, 5])
    forward, backward = quality.chain_sums(e, firsts, pairs)
    for a, b in ((0, 3), (3, 5)):
        weight = np.zeros((b - a, 2))
        for code in range(2 ** (b - a)):
            y = [code >> k & 1 for k in range(b - a)]
            w = np.exp(sum(e[a + k] * y[k] for k in range(b - a)) + sum(pairs[y[k], y[k + 1]] for k in range(b - a - 1)))
            for k in range(b - a):
                weight[k, y[k]] += w
        assert np.allclose(forward[a:b] + backward[a:b], np.log(weight[:, 1] / weight[:, 0]))


def test_decontamination_finds_paraphrases(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = {r.item_id: r.text for r in bench.collect()}
    rng, hosts, planted = random.Random(2), [r.text.split() for r in docs.limit(50).collect()], []
    for n, (i, text) in enumerate(items.items()):
        w = text.split()
        for _ in range(len(w) // 8):
            k = rng.randrange(len(w))
            w[k : k + 1] = rng.choice([[], ["qq" + w[k]], [w[k], "zz"]])
        host = rng.choice(hosts)
        k = rng.randrange(len(host) + 1)
        planted.append((10_000 + n, " ".join(host[:k] + w + host[k:]), i))
    more = docs.unionByName(spark.createDataFrame([p[:2] for p in planted] + [(20_000, None), (20_001, "")], "doc_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(more, bench).collect()}
    assert sum((d, i) in got for d, _, i in planted) >= 0.95 * len(planted)
    clean = {d for d, _ in got if d < 10_000}
    exact = {r.doc_id for r in docs.join(bench.select(F.col("text").alias("b")), F.contains("text", "b")).select("doc_id").collect()}
    assert exact <= clean and len(clean - exact) <= 2


def test_common_subsequence():
    a, b = np.array([1, 2, 3, 4, 5]), np.array([9, 1, 3, 9, 5, 4])
    assert decontam.longest_common(a, b) == 3
    assert decontam.longest_common(a, np.array([], int)) == 0


def test_decontamination_edges(spark, docs, none):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "...")], "item_id long, text string")
    assert decontam.contaminated(docs, bench).count() == 0
    real = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta")], "item_id long, text string")
    assert decontam.contaminated(none, real).count() == 0
    assert decontam.drop_contaminated(docs, real).count() == docs.count()


def test_decontamination_finds_long_items(spark, sf_dir):
    """Exact and edited copies of items far longer than a window; half an item is no copy."""
    rng = random.Random(4)
    words = ["".join(rng.choice("aeioubcdfgklmn") for _ in range(rng.randint(3, 8))) for _ in range(3000)]
    items = {n: [rng.choice(words) for _ in range(n)] for n in (30, 150, 300, 1000)}
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    rows = [(k, " ".join(rng.choice(words) for _ in range(400))) for k in range(300)]
    want = set()
    for n, w in items.items():
        for k in range(6):
            copy = list(w)
            if k:
                for _ in range(n // 8):
                    i = rng.randrange(len(copy))
                    copy[i : i + 1] = rng.choice([[], ["qq" + copy[i]], [copy[i], "zz"]])
            host = rng.choice(rows)[1].split()
            at = rng.randrange(len(host) + 1)
            rows.append((10 * n + k + 1000, " ".join(host[:at] + copy + host[at:])))
            want.add((10 * n + k + 1000, n))
        rows.append((10 * n + 1009, " ".join(w[: n // 2])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect()} == want


def test_kneser_ney_equals_a_dictionary_version(spark):
    """Shared probabilities equal the recursion over all contexts, and those of any context sum to 1."""
    rng = random.Random(3)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 12))) for _ in range(60)]
    df = spark.createDataFrame([(k % 2, k % 3 % 2, w) for k, w in enumerate(words)], "half long, label long, text string")
    counts = toxicity.counted(df)
    tops, want = set(), {}
    for k, w in enumerate(words):
        symbols = [1, *w.encode(), 2]
        for p in range(1, len(symbols)):
            event = tuple(symbols[max(0, p - 7) : p + 1])
            tops.add(event)
            want.setdefault(event, [0] * 4)[k % 2 * 2 + k % 3 % 2] += 1
    number = lambda g: int.from_bytes(bytes(g), "big", signed=False)
    assert {r.event: [r.o0, r.t0, r.o1, r.t1] for r in counts.collect()} == {number(e): n for e, n in want.items()}
    grams = {e[-m:] for e in tops for m in range(2, len(e) + 1)}
    kinds = {}
    for g in grams:
        kinds[g[1:]] = kinds.get(g[1:], 0) + 1

    def p(before, following):
        lower = p(before[1:], following) if before else 1 / 257
        own = [kinds[g] for g in kinds if g[:-1] == before]
        if not own:
            return lower
        return (max(kinds.get((*before, following), 0) - 0.75, 0) + 0.75 * len(own) * lower) / sum(own)

    got = {r.event: r.shared for r in toxicity.shared(counts).collect()}
    assert len(got) == len(tops) and all(abs(got[number(e)] - p(e[1:-1], e[-1])) < 1e-12 for e in tops)
    for before in {e[1:-1] for e in tops}:
        seen = sum(p(before, x) for x in (97, 98, 1, 2))
        assert abs(seen + 253 * p(before, 99) - 1) < 1e-9


def test_joined_evidence_equals_that_sent_out(spark, docs):
    labels = spark.createDataFrame([(i, i % 4 // 3) for i in range(60)], "doc_id long, toxic int")
    more = docs.unionByName(docs.select(docs.doc_id + 1000, F.concat("text", F.lit("z" * 3000)), *docs.columns[2:]).toDF(*docs.columns))
    one, two = (sorted(toxicity.toxicity(more, labels, most_sent=n).collect(), key=repr) for n in (10**6, 0))
    key = lambda r: (repr(r.doc_id), round(r.score, 9), r.held_out, r.predicted)
    assert len(one) == more.count() and sorted(map(key, one)) == sorted(map(key, two))


def test_joined_evidence_keeps_no_row_for_each_word_of_a_text(spark, monkeypatch):
    common = " ".join(f"common{chr(97 + k)}word" for k in range(20))
    rows = [(i, i % 2, i // 2 % 2, f"{common} rare{i}thing {'ÉÜ' * (i % 3)} {common if i % 5 else ''}") for i in range(120)]
    texts = spark.createDataFrame([*rows, (120, 0, 0, None), (121, 1, 1, "")], "doc_id long, half int, label int, text string")
    model = toxicity.estimated(toxicity.counted(texts.where("doc_id % 3 != 0"))).cache()
    sizes, write = [], toxicity.written

    def seen(df):
        out = write(df)
        sizes.append(out.count() + (out.agg(F.sum(F.size("rest"))).first()[0] if "rest" in out.columns else 0))
        return out

    monkeypatch.setattr(toxicity, "written", seen)
    sent, joined, none = ({r.doc_id: r for r in toxicity.evidence(texts, model, n).collect()} for n in (10**6, 60, 0))
    assert len(sent) == 122 and sent.keys() == joined.keys() == none.keys()
    for k, r in sent.items():
        for other in (joined[k], none[k]):
            assert r.n_words == other.n_words and all(abs(a - b) < 1e-9 for a, b in zip(r.evidence, other.evidence, strict=True))
    assert 0 < max(sizes[:2]) < 500  # the words, and the rows with their rare words; 120 rows hold 21 words or more each


def test_contaminated_rows_without_id_and_of_one_id(spark, sf_dir):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    item = max(bench.collect(), key=lambda r: len(r.text.split()))
    clean = " ".join(f"clean{k} word{k * 7} thing{k * 13}" for k in range(60))
    rows = [(None, item.text), (None, clean), (1, f"{clean} {item.text}"), (1, clean), (2, clean), (3, item.text), (3, item.text), (4, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, tie string")
    kept = sorted(((r.doc_id, r.text) for r in decontam.drop_contaminated(docs, bench).collect()), key=repr)
    assert kept == sorted([(None, clean), (1, clean), (2, clean), (4, None), (None, None)], key=repr)
