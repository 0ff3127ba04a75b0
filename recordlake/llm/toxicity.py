"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HASH_KEY, Words, as_binary, discard, held_out, mix, plain, slices, stored
from .labelled import FOLDS, MAX_ROWS, sample

BITS = 22
_U = np.uint64
_SALTS = (_U(0), _U(0x5851F42D4C957F2D), _U(0x14057B7EF767814F))


@dataclass(frozen=True)
class Ftrl:
    """alpha and beta set the rate of a coordinate, alpha / (beta + sqrt(sum of squared gradients)); l1 and l2 the penalty.

    A gradient is at most 1, so a feature of a single document stays without a weight if l1 is at least passes.
    """

    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 0.1
    passes: int = 5
    batch: int = 32


def features(texts: pa.Array, bits: int = BITS, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) pairs, each once and by row: words, pairs of words in a row, and pairs with a word between them.

    Words are lower-cased and lose punctuation at their ends. kept: a flag for each feature, others are left out.
    """
    w = Words(texts)
    vocab = plain(w.vocab)
    h = pd.util.hash_array(vocab.to_numpy(zero_copy_only=False), hash_key=HASH_KEY, categorize=False)[w.codes]
    row = w.rows()
    found = []
    with np.errstate(over="ignore"):
        for gap, salt in enumerate(_SALTS):
            n = len(h) - gap
            if n <= 0:
                break
            x = mix(h[:n] * _U(3) + h[gap:] + salt) if gap else mix(h)
            x = (x >> _U(64 - bits)).astype(np.int64)
            ok = row[:n] == row[gap:]
            if kept is not None:
                ok &= kept[x]
            found.append((row[:n][ok] << bits) | x[ok])
    pairs = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
    return pairs >> bits, pairs & ((1 << bits) - 1)


def weights(z: np.ndarray, n: np.ndarray, p: Ftrl) -> np.ndarray:
    """The weights that state z and n stand for."""
    return np.where(np.abs(z) <= p.l1, 0.0, -(z - np.sign(z) * p.l1) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2))


def learn(rows: list[np.ndarray], labels: np.ndarray, z: np.ndarray, n: np.ndarray, p: Ftrl) -> None:
    """One pass over rows of coordinates in mini-batches, changing z and n in place. The last coordinate is the bias."""
    bias = len(z) - 1
    for b in range(0, len(rows), p.batch):
        part, y = rows[b : b + p.batch], labels[b : b + p.batch]
        r = np.repeat(np.arange(len(part)), [len(x) for x in part])
        u, at = np.unique(np.concatenate([*part, [bias]]).astype(np.int64), return_inverse=True)
        w = weights(z[u], n[u], p)
        at, at_bias = at[:-1], at[-1]
        err = 1 / (1 + np.exp(-np.clip(np.bincount(r, w[at], len(part)) + w[at_bias], -30, 30))) - y
        g, g2 = (np.bincount(at, x, len(u)).astype(float) for x in (err[r], err[r] ** 2))  # of no coordinates they would be whole numbers
        g[at_bias], g2[at_bias] = err.sum(), (err**2).sum()
        z[u] += g - (np.sqrt(n[u] + g2) - np.sqrt(n[u])) / p.alpha * w
        n[u] += g2


@dataclass(frozen=True)
class Weights:
    """The features that have a weight, ascending, their weights, and the bias."""

    bits: int
    features: np.ndarray
    values: np.ndarray
    bias: float


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", params: Ftrl = Ftrl(), bits: int = BITS, max_rows: int = MAX_ROWS) -> Weights:
    """Weights learned from at most max_rows labelled rows (sample()).

    Texts are hashed to features by many tasks. The method is an online one: a single task passes over the features of
    the sample, in an order that a hash of the text gives, and sends the weights that are not 0. Its state has 2 ** bits
    coordinates, its rows are at most max_rows, whatever the input.
    """

    def hashed(batches):
        for batch in batches:
            for at, part in slices(batch.column(0)):
                row, f = features(part, bits)
                bounds = np.searchsorted(row, np.arange(len(part) + 1))
                own = (batch.column(c).slice(at, len(part)) for c in (1, 2))
                yield pa.RecordBatch.from_arrays([*own, as_binary(f.astype(np.int32), bounds)], ["label", "place", "features"])

    def learned(batches):
        z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
        own, y = [], [np.empty(0)]
        for batch in batches:
            y.append(batch.column(0).to_numpy())
            own += [np.frombuffer(x.as_py(), np.int32) for x in batch.column(1)]
        for _ in range(params.passes):
            learn(own, np.concatenate(y), z, n, params)
        w = weights(z, n, params)
        some = np.flatnonzero(w)
        yield pa.record_batch({"feature": pa.array(some.astype(np.int32)), "weight": pa.array(w[some])})

    rows = sample(docs, labels, label, max_rows).select("text", "label", F.xxhash64("text", "label").alias("place"))
    rows = stored(rows.mapInArrow(hashed, "label int, place long, features binary"), "ftrl-sample")
    got = rows.coalesce(1).sortWithinPartitions("place").select("label", "features").mapInArrow(learned, "feature int, weight double").collect()  # at most 2 ** bits
    discard(rows)
    of = {r["feature"]: r["weight"] for r in sorted(got)}
    bias = of.pop(1 << bits, 0.0)
    return Weights(bits, np.array(list(of), np.int32), np.array(list(of.values()), np.float32), bias)


def score(docs: DataFrame, model: Weights, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """doc_id, score, predicted, n_features (those with a weight) of each row, whole text. A null text counts as empty."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        m = sent.value
        w = np.zeros(1 << m.bits, np.float32)
        w[m.features] = m.values
        kept = w != 0
        for batch in batches:
            for at, part in slices(batch.column(1)):
                row, f = features(part, m.bits, kept)
                s = np.bincount(row, w[f], len(part)) + m.bias
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), pa.array(1 / (1 + np.exp(-np.clip(s, -30, 30)))), pa.array(np.bincount(row, minlength=len(part)))], ["doc_id", "score", "n_features"])

    kind = dict(docs.dtypes)[id_col]
    out = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(scored, f"doc_id {kind}, score double, n_features long")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame, params: Ftrl = Ftrl(), max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted, n_features of each document. Without labelled rows every score is 0.5.

    Null and empty texts have the score of the bias alone; very long texts are scored whole, in slices. Null ids are
    scored and not held out; repeated rows are scored each. Other columns are not read, whatever their names. No rows
    give no rows.
    """
    out = score(docs, fit(docs, labels, "toxic", params, max_rows=max_rows))
    return out.select("doc_id", held_out("doc_id", FOLDS).alias("held_out"), "score", "predicted", "n_features")
