"""Quality of documents from a linear-chain conditional random field over their lines.

Every line is good or bad.  Its features are shares of kinds of bytes and of
repeated words, in the line itself and in the lines before and after it; the
chain adds a weight for each pair of neighbouring labels.  Forward-backward
gives each line's probability of being good, and the byte-weighted mean of the
bad ones is the evidence from which a logistic curve gives the document's score.

Labels are known for documents only.  Learning therefore alternates: lines of
good documents are good; lines of a bad one are bad unless the field finds them
good, but its worst line always stays bad.

The field is fitted on the driver on at most `most` labelled documents, those
whose ids hash lowest.  Scoring is a map over all texts and shuffles nothing.

Edge cases: null, empty and blank texts have no lines and get the curve's value
for no bad line; without labels of both classes all scores are the share of good
labels (1 without any).  Repeated rows get the same score each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicord.llm.folds import fold, logistic, sampled
from lexicord.llm.textarrays import BLANK, LOWER, pieces, range_hashes, spans


def kinds() -> np.ndarray:
    """Byte classes: upper-case, digit, sentence mark, other mark, beyond ASCII."""
    k = np.zeros((5, 256))
    k[0, 65:91] = 1
    k[1, 48:58] = 1
    k[2, [ord(c) for c in ".,;:'\"()?-"]] = 1
    k[3, [b for b in range(33, 127) if not chr(b).isalnum() and not k[2, b]]] = 1
    k[4, 128:] = 1
    return k


KINDS = kinds()
OWN = 11
N_FEATURES = 3 * OWN + 1


def per_run(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sums of values between one place and the next."""
    runs = np.zeros(len(values) + 1)
    np.cumsum(values, out=runs[1:])
    return runs[firsts[1:]] - runs[firsts[:-1]]


def line_features(body: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and byte counts of all lines that are not blank, and where each row's lines begin."""
    begins, ends, _ = spans(body != 10, starts)
    w_begins, w_ends, _ = spans(~BLANK[body], starts)
    w_firsts = np.searchsorted(w_begins, np.append(begins, len(body)))
    full = np.diff(w_firsts) > 0
    begins, ends = begins[full], ends[full]
    n = len(begins)
    firsts = np.searchsorted(begins, starts)
    w_firsts = np.searchsorted(w_begins, np.append(begins, len(body)))
    n_words, length = np.diff(w_firsts).astype(float), (ends - begins).astype(float)
    x = np.zeros((n, OWN))
    if n:
        for k, kind in enumerate(KINDS):
            sums = np.zeros(len(body) + 1)
            np.cumsum(kind[body], out=sums[1:])
            x[:, k] = (sums[ends] - sums[begins]) / length
        hashes = range_hashes(LOWER[body], w_begins, w_ends)
        line = np.repeat(np.arange(n), np.diff(w_firsts))
        again = np.zeros(len(hashes))
        again[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
        x[:, 5] = per_run(again, w_firsts) / n_words
        order = np.lexsort((hashes, line))
        same = np.zeros(len(hashes))
        same[1:] = (hashes[order][1:] == hashes[order][:-1]) & (line[order][1:] == line[order][:-1])
        x[:, 6] = per_run(same, w_firsts) / n_words
        marked = (KINDS[3][body[w_ends - 1]] > 0) | (KINDS[3][body[w_begins]] > 0)
        x[:, 7] = per_run(marked.astype(float), w_firsts) / n_words
        x[:, 8] = np.minimum(length / n_words, 40) / 10
        x[:, 9] = np.log1p(n_words) / 4
        shout = KINDS[0][body[w_ends - 1]] + KINDS[0][body[np.maximum(w_ends - 3, w_begins)]] > 0
        x[:, 10] = per_run((shout & (w_ends - w_begins > 1)).astype(float), w_firsts) / n_words
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    edge = firsts[:-1][np.diff(firsts) > 0]
    before[edge] = 0
    after[firsts[1:][np.diff(firsts) > 0] - 1] = 0
    return np.hstack([x, before, after, np.ones((n, 1))]), length, firsts


def chain_sums(e: np.ndarray, firsts: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log-odds (good against bad) of every line; e: the lines' own, pairs[i, j]: weights of label j after i."""
    counts = np.diff(firsts)
    order = np.argsort(-counts, kind="stable")
    heads, sizes = firsts[:-1][order], counts[order]
    t = np.exp(pairs)
    forward, backward = e.copy(), np.zeros_like(e)
    longest = int(sizes[0]) if len(sizes) else 0
    for k in range(1, longest):
        at = heads[: np.searchsorted(-sizes, -k, "left")] + k
        odds = np.exp(np.clip(forward[at - 1], -30, 30))
        forward[at] = e[at] + np.log((odds * t[1, 1] + t[0, 1]) / (odds * t[1, 0] + t[0, 0]))
    for k in range(longest - 1, 0, -1):
        at = heads[: np.searchsorted(-sizes, -k, "left")] + k
        odds = np.exp(np.clip(e[at] + backward[at], -30, 30))
        backward[at - 1] = np.log((odds * t[1, 1] + t[1, 0]) / (odds * t[0, 1] + t[0, 0]))
    return forward, backward


class Field:
    """Weights of features, weights of label pairs, and the curve of documents."""

    def __init__(self):
        self.weights, self.pairs, self.curve = np.zeros(N_FEATURES), np.zeros((2, 2)), np.zeros(3)

    def good(self, x: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Each line's probability of being good."""
        forward, backward = chain_sums(x @ self.weights, firsts, self.pairs)
        return 1 / (1 + np.exp(-np.clip(forward + backward, -30, 30)))

    def evidence(self, x: np.ndarray, length: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Share of each document's bytes that is bad, and its root."""
        share = per_run((1 - self.good(x, firsts)) * length, firsts) / np.maximum(per_run(length, firsts), 1)
        return np.stack([share, np.sqrt(np.maximum(share, 0))], axis=1)

    def score(self, body: np.ndarray, starts: np.ndarray) -> np.ndarray:
        z = self.evidence(*line_features(body, starts)) @ self.curve[:-1] + self.curve[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def climb(self, x: np.ndarray, firsts: np.ndarray, y: np.ndarray, rounds: int = 200, rate: float = 0.1, l2: float = 1e-3) -> None:
        """Maximise the likelihood of line labels y by Adam steps."""
        inner = np.ones(len(y), bool)
        inner[firsts[:-1][np.diff(firsts) > 0]] = False
        at = np.flatnonzero(inner)
        told = np.zeros((2, 2))
        np.add.at(told, (y[at - 1], y[at]), 1)
        m = v = np.zeros(N_FEATURES + 4)
        for step in range(1, rounds + 1):
            e = x @ self.weights
            forward, backward = chain_sums(e, firsts, self.pairs)
            p = 1 / (1 + np.exp(-np.clip(forward + backward, -30, 30)))
            a, b = np.clip(forward[at - 1], -30, 30), np.clip(e[at] + backward[at], -30, 30)
            both = np.exp(np.stack([self.pairs[0, 0] + 0 * a, self.pairs[0, 1] + b, self.pairs[1, 0] + a, self.pairs[1, 1] + a + b], axis=1))
            expected = (both / both.sum(1, keepdims=True)).sum(0).reshape(2, 2) if len(at) else np.zeros((2, 2))
            g = np.append(x.T @ (y - p), (told - expected).ravel()) / len(y) - l2 * np.append(self.weights, self.pairs.ravel())
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            self.weights, self.pairs = self.weights + move[:-4], self.pairs + move[-4:].reshape(2, 2)


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, most: int = 3_000, turns: int = 2) -> Field:
    """A field fitted on at most `most` labelled documents outside the held-out fold."""
    texts = sampled(docs, labels, "quality", folds, held_out, most)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, body, starts in pieces(batches, most=500_000):
            x, length, firsts = line_features(body, starts)
            yield pa.record_batch([batch.column("doc_id"), batch.column("label"), pa.array([x[a:b].astype("<f4").tobytes() for a, b in zip(firsts[:-1], firsts[1:])], pa.binary()), pa.array([length[a:b].tolist() for a, b in zip(firsts[:-1], firsts[1:])], pa.list_(pa.float64()))], ["doc_id", "label", "x", "length"])

    seen = texts.mapInArrow(measure, "doc_id long, label int, x binary, length array<double>").toPandas().sort_values("doc_id")
    field, label = Field(), seen["label"].to_numpy(int)
    if not len(label) or label.min() == label.max():
        field.curve[-1] = -30.0 if len(label) and not label.any() else 30.0
        return field
    x = np.concatenate([np.frombuffer(b, "<f4").reshape(-1, N_FEATURES) for b in seen["x"]]).astype(float)
    length = np.concatenate([np.asarray(n, float) for n in seen["length"]])
    firsts = np.append(0, np.cumsum([len(n) for n in seen["length"]]))
    of = np.repeat(label, np.diff(firsts))
    y = of.copy()
    for turn in range(turns):
        field.climb(x, firsts, y)
        good = field.good(x, firsts)
        y = np.where(of == 1, 1, (good > 0.5).astype(int))
        for a, b in zip(firsts[:-1][label == 0], firsts[1:][label == 0]):
            if b > a:
                y[a + np.argmin(good[a:b])] = 0
    field.climb(x, firsts, y)
    field.curve = logistic(field.evidence(x, length, firsts), label.astype(float), l2=1e-5)
    return field


def score_documents(docs: DataFrame, field: Field) -> DataFrame:
    """(doc_id, score) of every row; a map over the texts."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, body, starts in pieces(batches, most=500_000):
            yield pa.record_batch([batch.column("doc_id"), pa.array(field.score(body, starts))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    scored = score_documents(docs, fit(docs, labels, folds, held_out))
    return scored.select("doc_id", (fold("doc_id", folds) == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, field: Field, threshold: float = 0.3) -> DataFrame:
    """The rows, with all their columns, whose score reaches the threshold."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, body, starts in pieces(batches, most=500_000):
            yield batch.filter(pa.array(field.score(body, starts) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
