"""Benchmark decontamination by latent semantic retrieval.

Terms are word hashes in 2**18 buckets, weighted by inverse document frequency
over all documents.  A distributed randomised SVD of the TF-IDF passages of the
benchmark gives `rank` latent directions.  An item of more than four steps is
cut into passages of about a window's length, others are one passage.  All
passages of all documents (windows of three steps of `step` words, one step
apart) are projected, and those whose cosine to an item's passage reaches
`cosine`, and whose part along it `share` of the passage's length, are
candidates.  Terms in more than `common` of all documents weigh nothing, except
those of passages with few others.  A candidate is checked on the words
themselves: the longest common subsequence of the whole item and the window with
an item's length (64 words at least) on both sides, as a share of the item, and
the same for the item's answer (its last sentence).  Candidates of a long item
within half its length of each other are checked as one.  A document is contaminated by an
item if the subsequence reaches `sure`, or `likely` with the answer at `answer`
or more; so dropped, added or replaced words do not hide a passage.

Broadcast sizes: directions are 2**18 x rank floats at most (134 MB; rows exist
for terms of the benchmark only), passage vectors go out about `block` at a time.

Edge cases: null and empty texts and items without words match nothing; a
repeated document row gives its pairs once; items with equal text each match;
null ids are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicord.llm.shared import written
from lexicord.llm.textarrays import LOWER, pieces, range_hashes, spans

BITS = 18
SEED = 7

WORD = np.zeros(256, bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True
SENTENCE_END = np.zeros(256, bool)
SENTENCE_END[[10, 33, 46, 63]] = True


def term_words(body: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, where rows' words begin, and where each word begins."""
    begins, ends, firsts = spans(WORD[body], starts)
    return range_hashes(LOWER[body], begins, ends), firsts, begins


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def items(benchmark: DataFrame) -> DataFrame:
    """(item_id, words array<long>, answer_from): word hashes, and the place of the answer's first word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, body, starts in pieces(batches):
            hashes, firsts, begins = term_words(body, starts)
            stops = np.flatnonzero(SENTENCE_END[body])
            rows, answers = [], []
            for a, b in zip(firsts[:-1], firsts[1:]):
                rows.append(hashes[a:b].view(np.int64))
                inner = np.searchsorted(begins[a:b], stops)  # words before each sentence end
                inner = inner[(inner > 0) & (inner <= b - a - 3)]
                answers.append(int(inner[-1]) if len(inner) else max(0, b - a - 5))
            yield pa.record_batch([batch.column("item_id"), pa.array(list(rows), pa.list_(pa.int64())), pa.array(answers, pa.int32())], ["item_id", "words", "answer_from"])

    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null").mapInArrow(run, "item_id long, words array<long>, answer_from int").where(F.size("words") > 0)


def item_passages(asked: DataFrame, step: int) -> DataFrame:
    """(item_id, n, words): the passages of each item of n words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, rows = [], [], []
            for i, row in zip(batch.column("item_id").to_pylist(), batch.column("words")):
                words = row.values.to_numpy()
                for part in np.array_split(words, -(-len(words) // (3 * step)) if len(words) > 4 * step else 1):
                    ids.append(i)
                    sizes.append(len(words))
                    rows.append(part)
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(rows, pa.list_(pa.int64()))], ["item_id", "n", "words"])

    return asked.select("item_id", "words").mapInArrow(run, "item_id long, n long, words array<long>")


def document_frequencies(docs: DataFrame, wanted: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many documents each wanted bucket occurs, over all documents; and the number of documents."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)  # 2**18 flags

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, seen = np.zeros(1 << BITS, np.int64), 0
        for batch, body, starts in pieces(batches):
            hashes, firsts, _ = term_words(body, starts)
            b = buckets(hashes)
            row = np.repeat(np.arange(batch.num_rows), np.diff(firsts))
            own = sent.value[b]
            sums += np.bincount(np.unique(row[own] << BITS | b[own]) & (1 << BITS) - 1, minlength=1 << BITS)
            seen += batch.num_rows
        at = np.flatnonzero(sums)
        yield pa.record_batch([pa.array(np.append(at, -1)), pa.array(np.append(sums[at], seen))], ["bucket", "n"])

    told = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(1 << BITS, np.int64)
    real = told["bucket"] >= 0
    n[told["bucket"][real]] = told["n"][real]
    return n, int(told["n"][~real].sum())


def randomised_svd(passages: DataFrame, wanted: np.ndarray, weights: np.ndarray, rank: int, rounds: int = 2) -> np.ndarray:
    """The leading right singular vectors of the TF-IDF rows of (words): an array of len(terms) x rank.

    Every round multiplies by the matrix and its transpose in the tasks that
    hold the rows; the products are summed by term in a shuffle.  The driver
    orthonormalises one terms x (rank + 10) array.
    """
    spark = passages.sparkSession
    terms = np.flatnonzero(wanted)
    place = np.full(1 << BITS, -1, np.int64)
    place[terms] = np.arange(len(terms))
    width = min(rank + 10, len(terms))
    q = np.random.default_rng(SEED).standard_normal((len(terms), width)).astype(np.float32)
    for turn in range(rounds + 1):
        q = np.linalg.qr(q)[0].astype(np.float32)
        last = turn == rounds
        sent = spark.sparkContext.broadcast((place, weights, q))

        def run(batches: Iterator[pa.RecordBatch], last: bool = last, sent=sent) -> Iterator[pa.RecordBatch]:
            place, weights, q = sent.value
            out = np.zeros((q.shape[1] if last else len(q), q.shape[1]), np.float64)
            for batch in batches:
                for row in batch.column("words").to_pylist():
                    b = buckets(np.array(row, np.int64).view(np.uint64))
                    b = b[place[b] >= 0]
                    at, w = place[b], weights[b]
                    y = w @ q[at]
                    size = np.sqrt((np.bincount(at, w) ** 2).sum()) if len(at) else 0  # rows count with unit length
                    y = y / max(size, 1e-9)
                    if last:
                        out += np.outer(y, y)
                    else:
                        np.add.at(out, at, np.outer(w / max(size, 1e-9), y))
            rows = np.flatnonzero(np.abs(out).sum(1))
            yield pa.record_batch([pa.array(rows), pa.array(list(out[rows]), pa.list_(pa.float64()))], ["row", "v"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for r, v in zip(batch.column("row").to_pylist(), batch.column("v").to_pylist()):
                    sums[r] = sums.get(r, 0) + np.array(v)
            yield pa.record_batch([pa.array(list(sums), pa.int64()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["row", "v"])

        told = passages.select("words").mapInArrow(run, "row long, v array<double>").repartition("row").mapInArrow(add, "row long, v binary").toPandas()
        z = np.zeros((width if last else len(terms), width))
        for r, v in zip(told["row"], told["v"]):
            z[r] = np.frombuffer(v)
        sent.unpersist()
        if last:
            values, turns = np.linalg.eigh((z + z.T) / 2)
            return (q @ turns[:, np.argsort(-values)[:rank]]).astype(np.float32)
        q = z
    raise AssertionError


def longest_common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, a row of the table at a time."""
    row = np.zeros(len(b) + 1, np.int32)
    for x in a:
        with_x = np.where(b == x, row[:-1] + 1, row[1:])
        row[1:] = np.maximum.accumulate(np.maximum(with_x, row[1:]))
    return int(row[-1])


def contaminated(docs: DataFrame, benchmark: DataFrame, **limits) -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer): each document and item that contaminates it, with the best figures; rows without id are one document."""
    rows = contaminated_rows(docs, benchmark, **limits)
    return rows.groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in ("cosine", "lcs", "answer")])


def contaminated_rows(docs: DataFrame, benchmark: DataFrame, step: int = 16, rank: int = 128, cosine: float = 0.4, share: float = 0.4, common: float = 0.03, sure: float = 0.8, likely: float = 0.6, answer: float = 0.6, block: int = 50_000) -> DataFrame:
    """(doc_id, tie, item_id, cosine, lcs, answer) of each contaminated text; `tie` is its hash, so rows of one id, or of none, are told apart."""
    spark = docs.sparkSession
    asked = written(items(benchmark))
    wanted = np.zeros(1 << BITS, bool)
    bits = asked.select(F.explode("words").alias("w")).select(F.shiftrightunsigned("w", 64 - BITS).cast("int").alias("b")).distinct().toPandas()["b"]  # 2**18 at most
    wanted[bits] = True
    empty = spark.createDataFrame([], "doc_id long, tie long, item_id long, cosine double, lcs double, answer double")
    if not wanted.any():
        return empty
    frequency, n_docs = document_frequencies(docs, wanted)
    rare = wanted & (frequency <= common * n_docs)
    kept = spark.sparkContext.broadcast(rare)
    searched = written(item_passages(asked, step))

    def lacking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Terms of passages with fewer than three rare terms."""
        for batch in batches:
            rows = [np.unique(buckets(np.array(row, np.int64).view(np.uint64))) for row in batch.column("words").to_pylist()]
            yield pa.record_batch([pa.array(np.concatenate([b for b in rows if kept.value[b].sum() < 3] or [np.empty(0, np.int64)]))], ["bucket"])

    rare[searched.select("words").mapInArrow(lacking, "bucket long").distinct().toPandas()["bucket"].astype(int)] = True
    weights = (np.log((2 + n_docs) / (1 + frequency)) * rare).astype(np.float32)
    directions = randomised_svd(searched, rare, weights, rank)
    place = np.zeros(1 << BITS, np.int32)
    place[np.flatnonzero(rare)] = np.arange(rare.sum())
    sent = spark.sparkContext.broadcast((place, weights, directions))

    def reached(at, ids, n, score, begins, ends, firsts, row, hashes):
        """Windows, items, best cosines and surrounding words of the hits; those of a long item within half its length are one."""
        order = np.lexsort((begins[at], n, ids, row[at]))
        at, ids, n, score = at[order], ids[order], n[order], score[order]
        heads, head = [], -1
        for k in range(len(at)):
            near = head >= 0 and n[k] > 4 * step and row[at[k]] == row[at[head]] and ids[k] == ids[head] and n[k] == n[head] and begins[at[k]] - begins[at[head]] <= n[k] // 2
            if not near:
                head = k
                heads.append(k)
        heads = np.array(heads)
        lasts = np.append(heads[1:], len(at)) - 1
        texts = []
        for a, z in zip(heads, lasts):
            reach, r = max(64, int(n[a])), row[at[a]]
            texts.append(hashes[max(firsts[r], begins[at[a]] - reach) : min(firsts[r + 1], ends[at[z]] + reach)].view(np.int64))
        return at[heads], ids[heads], np.maximum.reduceat(score, heads), texts

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, weights, directions = sent.value
        for batch in batches:
            rows, energy = [], []
            for row in batch.column("words").to_pylist():
                b = buckets(np.array(row, np.int64).view(np.uint64))
                rows.append((weights[b] @ directions[place[b]]).astype(np.float32).tobytes())
                energy.append(float(weights[b].sum()))
            yield pa.record_batch([batch.column("item_id"), batch.column("n"), pa.array(rows, pa.binary()), pa.array(energy)], ["item_id", "n", "v", "energy"])

    found = written(searched.mapInArrow(vectors, "item_id long, n long, v binary, energy double"))
    numbered = written(found.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(-(-found.count() // block)))))
    candidates = None
    for (part,) in numbered.select("block").distinct().collect():
        own = numbered.where(F.col("block") == part).toPandas()  # about `block` passages
        vecs = np.stack([np.frombuffer(v, np.float32) for v in own["v"]])
        sizes = np.maximum(np.linalg.norm(vecs, axis=1), 1e-9)
        block_sent = spark.sparkContext.broadcast((own["item_id"].to_numpy(), own["n"].to_numpy(), vecs / sizes[:, None], sizes * share, float(own["energy"].min()) * likely / 2))

        def search(batches: Iterator[pa.RecordBatch], block_sent=block_sent) -> Iterator[pa.RecordBatch]:
            place, weights, directions = sent.value
            item_ids, lengths, vecs, needed, least = block_sent.value
            for batch, body, starts in pieces(batches):
                hashes, firsts, _ = term_words(body, starts)
                b = buckets(hashes)
                w = weights[b]
                begins = np.concatenate([np.arange(a, z, step) for a, z in zip(firsts[:-1], firsts[1:])]) if len(hashes) else np.empty(0, np.int64)
                if not len(begins):
                    continue
                row = np.searchsorted(firsts, begins, "right") - 1
                ends = np.minimum(begins + 3 * step, firsts[row + 1])
                run = np.zeros(len(w) + 1)
                np.cumsum(w, out=run[1:])
                # a window that holds the likely share of a passage holds that share's weight, or near half of it beside its neighbour
                full = np.flatnonzero(run[ends] - run[begins] >= least)
                rows, hits, scores = [], [], []
                for first in range(0, len(full), 1024):
                    part = full[first : first + 1024]
                    sizes = ends[part] - begins[part]
                    at = np.repeat(begins[part] - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(sizes.sum())
                    own = np.flatnonzero(w[at] > 0)
                    at, of = at[own], np.repeat(np.arange(len(part)), sizes)[own]
                    latent = np.zeros((len(part), directions.shape[1]), np.float32)
                    cut = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
                    latent[of[cut]] = np.add.reduceat(directions[place[b[at]]] * w[at, None], cut)
                    along = latent @ vecs.T
                    i, j = np.nonzero(along >= needed)
                    cos = along[i, j] / np.maximum(np.linalg.norm(latent, axis=1)[i], 1e-9)
                    i, j, cos = i[cos >= cosine], j[cos >= cosine], cos[cos >= cosine]
                    rows.append(part[i])
                    hits.append(j)
                    scores.append(cos)
                if not rows or not sum(map(len, rows)):
                    continue
                at, hit, score = np.concatenate(rows), np.concatenate(hits), np.concatenate(scores)
                at, ids, scores, texts = reached(at, item_ids[hit], lengths[hit], score, begins, ends, firsts, row, hashes)
                of = pa.array(row[at])
                yield pa.record_batch([batch.column("doc_id").take(of), batch.column("tie").take(of), pa.array(ids), pa.array(scores.astype(float)), pa.array(texts, pa.list_(pa.int64()))], ["doc_id", "tie", "item_id", "cosine", "near"])

        hits = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text").mapInArrow(search, "doc_id long, tie long, item_id long, cosine double, near array<long>")
        candidates = hits if candidates is None else candidates.unionByName(hits)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lcs, answered = [], []
            for near, item, begin in zip(*(batch.column(c).to_pylist() for c in ("near", "words", "answer_from"))):
                near, item = np.array(near, np.int64), np.array(item, np.int64)
                lcs.append(longest_common(item, near) / len(item))
                answered.append(longest_common(item[begin:], near) / len(item[begin:]) if lcs[-1] >= likely else 0.0)
            yield pa.record_batch([*[batch.column(c) for c in ("doc_id", "tie", "item_id", "cosine")], pa.array(lcs, pa.float64()), pa.array(answered, pa.float64())], ["doc_id", "tie", "item_id", "cosine", "lcs", "answer"])

    verified = candidates.join(asked, "item_id").mapInArrow(check, "doc_id long, tie long, item_id long, cosine double, lcs double, answer double")
    good = (F.col("lcs") >= sure) | ((F.col("lcs") >= likely) & (F.col("answer") >= answer))
    return verified.where(good).groupBy("doc_id", "tie", "item_id").agg(*[F.max(c).alias(c) for c in ("cosine", "lcs", "answer")])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows, with all their columns, whose own text no item contaminates; rows without id are judged like others."""
    gone = contaminated_rows(docs, benchmark).select("doc_id", "tie").distinct()
    own = docs["doc_id"].cast("long").eqNullSafe(gone["doc_id"]) & (F.xxhash64(docs["text"]) == gone["tie"])
    return docs.join(gone, own, "left_anti")
