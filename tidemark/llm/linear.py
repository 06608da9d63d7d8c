"""Numpy learners over sparse hashed n-grams, and the shared distributed scorer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hashed_tokens, list_parts, row_blocks, sparse_ngrams


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35.0, 35.0)))


def ftrl(ptr, index, value, label, size, weight=None, *, alpha=0.5, beta=1.0, l1=0.02, l2=0.5,
         epochs=3, seed=11):
    """Follow-the-regularised-leader (proximal) logistic regression.

    Returns (weights, bias). Coordinates keep (z, n); the weight of a coordinate is
    read from them lazily, so each example touches only its own coordinates.
    """
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    rng = np.random.default_rng(seed)
    rows = len(ptr) - 1
    weight = np.ones(rows) if weight is None else weight

    def read(i):
        zi = z[i]
        w = (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(n[i])) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    for _ in range(epochs):
        for r in rng.permutation(rows):
            i = np.append(index[ptr[r]:ptr[r + 1]], size)
            x = np.append(value[ptr[r]:ptr[r + 1]], 1.0)
            w = read(i)
            g = (sigmoid(w @ x) - label[r]) * x * weight[r]
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - step * w
            n[i] += g * g
    w = read(np.arange(size + 1))
    return w[:-1].astype(np.float32), float(w[-1])


def nnpu(ptr, index, value, positive, size, prior, *, epochs=8, rate=0.5, l2=1e-6, batch=256,
         least_steps=200, seed=11):
    """Non-negative positive-unlabelled logistic risk, minimised with Adagrad.

    risk = prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)]). Where the second
    part of a minibatch is below zero its gradient is left out, so the classifier can't
    win by pushing the estimated risk on negatives under zero. The unlabelled rows are
    draws from all text, so confirmed rows belong in them too, without their label.
    """
    rng = np.random.default_rng(seed)
    w, b = np.zeros(size), 0.0
    h, hb = np.full(size, 1e-8), 1e-8
    pos, unl = np.flatnonzero(positive), np.flatnonzero(~positive)
    steps = max(1, -(-len(unl) // batch))
    for _ in range(max(epochs, -(-least_steps // steps))):
        order = rng.permutation(unl)
        for k in range(steps):
            u = order[k * batch:(k + 1) * batch]
            p = rng.choice(pos, size=min(len(pos), max(16, batch // 2)), replace=False)
            rows = np.concatenate([p, u])
            at = np.concatenate([np.arange(ptr[r], ptr[r + 1]) for r in rows])
            lens = ptr[rows + 1] - ptr[rows]
            owner = np.repeat(np.arange(len(rows)), lens)
            i, x = index[at], value[at]
            g = np.bincount(owner, w[i] * x, minlength=len(rows)) + b
            gp, gu = g[:len(p)], g[len(p):]
            loss = lambda v: np.logaddexp(0.0, -v)
            negative = loss(-gu).mean() - prior * loss(-gp).mean()
            d = np.concatenate([-prior * sigmoid(-gp) / len(p), np.zeros(len(u))])
            if negative > 0:
                d += np.concatenate([-prior * sigmoid(gp) / len(p), sigmoid(gu) / len(u)])
            grad = np.bincount(i, d[owner] * x, minlength=size) + l2 * w
            h += grad * grad
            w -= rate * grad / np.sqrt(h)
            db = d.sum()
            hb += db * db
            b -= rate * db / np.sqrt(hb)
    return w.astype(np.float32), float(b)


def fit(sample: DataFrame, learner, bits: int) -> tuple[np.ndarray, float]:
    """Run ``learner(ptr, index, value, pandas frame)`` over a bounded sample in one task.

    ``sample`` has ``__tokens`` and the learner's own columns; its row count is bounded by
    the caller's sample size. The model is ``2**bits`` floats, whatever the input.
    """

    def train(key, pdf):
        import pandas as pd

        pdf = pdf.sort_values("__order", kind="stable").reset_index(drop=True)
        tokens = [np.asarray(t, dtype=np.int64) for t in pdf["__tokens"]]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
        flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
        parts, ptr = [], [np.zeros(1, np.int64)]
        for a, b in row_blocks(offsets):
            p, i, v = sparse_ngrams(offsets[a:b + 1] - offsets[a], flat[offsets[a]:offsets[b]], bits)
            parts.append((i.astype(np.int32), v.astype(np.float32)))
            ptr.append(p[1:] + ptr[-1][-1])
        index = np.concatenate([x for x, _ in parts])
        value = np.concatenate([x for _, x in parts])
        w, bias = learner(np.concatenate(ptr), index, value, pdf)
        return pd.DataFrame({"w": [w.astype("<f4").tobytes()], "b": [bias]})

    rows = sample.groupBy(F.lit("all")).applyInPandas(train, "w binary, b double").collect()
    if not rows:
        return np.zeros(1 << bits, dtype=np.float32), 0.0
    return np.frombuffer(rows[0]["w"], dtype="<f4"), rows[0]["b"]


def dots(offsets: np.ndarray, tokens: np.ndarray, w: np.ndarray, bits: int) -> np.ndarray:
    """Sparse dot product of each token row with the weights."""
    out = np.zeros(len(offsets) - 1)
    for lo, hi in row_blocks(offsets):
        ptr, i, v = sparse_ngrams(offsets[lo:hi + 1] - offsets[lo],
                                  tokens[offsets[lo]:offsets[hi]], bits)
        owner = np.repeat(np.arange(hi - lo), np.diff(ptr))
        out[lo:hi] = np.bincount(owner, w[i] * v, minlength=hi - lo)
    return out


def score(df: DataFrame, text: Column, keep: list[Column], model, bits: int,
          schema: str) -> DataFrame:
    """Score every row's whole text with a broadcast model.

    Returns the ``keep`` columns (described by ``schema``) and ``score`` in (0, 1).
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    rows = df.select(*keep, hashed_tokens(text).alias("__tokens"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = shared.value
        for batch in batches:
            offsets, tokens = list_parts(batch.column(batch.num_columns - 1))
            z = dots(offsets, tokens.to_numpy(zero_copy_only=False), w, bits) + b
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sigmoid(z))],
                                             names=[*batch.schema.names[:-1], "score"])

    return rows.mapInArrow(run, f"{schema}, score double")


def keep_scored(df: DataFrame, text: Column, model, bits: int, least: float) -> DataFrame:
    """Rows of ``df`` that score at least ``least``; columns are told apart by position."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    rows = df.select("*", hashed_tokens(text).alias("__tokens"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = shared.value
        for batch in batches:
            offsets, tokens = list_parts(batch.column(batch.num_columns - 1))
            z = dots(offsets, tokens.to_numpy(zero_copy_only=False), w, bits) + b
            rest = pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1])
            yield rest.filter(pa.array(sigmoid(z) >= least))

    return rows.mapInArrow(run, df.schema)
