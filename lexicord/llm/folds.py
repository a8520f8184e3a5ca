"""Labelled documents of the folds that a learner may see."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexicord.llm.shared import written


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(0)) % folds


def told(labels: DataFrame, label: str, folds: int, held_out: int) -> DataFrame:
    """(doc_id, half, label) of labels 0 and 1 outside the held-out fold; half deals the other folds into 0 and 1.

    A document that is labelled more than once counts with its largest label.
    """
    own = fold("doc_id", folds)
    rows = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1) & (own != held_out))
    return rows.groupBy("doc_id").agg(F.max("label").alias("label")).select("doc_id", ((own - (own > held_out).cast("long")) % 2).alias("half"), "label")


def labelled(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most_sent: int = 2_000_000) -> DataFrame:
    """(doc_id, half, label, text) of all labelled documents outside the held-out fold.

    At most `most_sent` labels go to the texts; more meet them in a shuffle of the texts outside that fold.
    """
    seen = docs.select("doc_id", "text").where(fold("doc_id", folds) != held_out)
    known = written(told(labels, label, folds, held_out))
    return seen.join(F.broadcast(known) if known.count() <= most_sent else known, "doc_id")


def sampled(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int) -> DataFrame:
    """The same for at most `most` labels, those whose ids hash lowest; for fitting only.  The labels go to the texts."""
    some = told(labels, label, folds, held_out).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")  # `most` rows


def logistic(x, y, l2: float = 1e-3, rounds: int = 50):
    """Weights and intercept (last) of a logistic regression by Newton's method; columns are scaled inside."""
    import numpy as np

    mean, scale = x.mean(0), x.std(0) + 1e-9
    a = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a.T * (p * (1 - p) + 1e-9)) @ a + l2 * len(a) * np.eye(len(w)), a.T @ (p - y) + l2 * len(a) * np.append(w[:-1], 0))
        w -= step
        if abs(step).max() < 1e-8:
            break
    out = w[:-1] / scale
    return np.append(out, w[-1] - out @ mean)
