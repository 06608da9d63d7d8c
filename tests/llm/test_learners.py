"""Quality and toxicity: held-out accuracy, folds and awkward rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from fixtures import documents
from pyspark.sql import functions as F

from tidemark.llm import linear, quality, toxicity
from tidemark.llm.common import crc_rest
from tidemark.llm.queries import op1_quality, op5_toxicity

SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize("query, label, good, bad", [
    (op1_quality, "quality", 0.98, 0.15), (op5_toxicity, "toxic", 0.8, 0.02)])
def test_held_out_accuracy(spark, query, label, good, bad):
    out = query(spark, SF)
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = out.cache()
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    rates = {r[label]: r["rate"] for r in out.where("held_out").join(labels, "doc_id")
             .groupBy(label).agg(F.avg("predicted").alias("rate")).collect()}
    assert rates[1] >= good and rates[0] <= bad
    assert out.where("score < 0 or score > 1 or score is null").count() == 0


def labels_of(spark):
    rows = [(k, k % 2, k % 2) for k in range(24)] + [(3, None, None), (None, 1, 1), (5, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_awkward_rows_are_scored(spark):
    docs, labels = documents(spark), labels_of(spark)
    keep, schema = [F.col("doc_id")], "doc_id long"
    q = quality.train(docs, labels, "quality", crc_rest(F.col("__id"), 5) != 0)
    t = toxicity.train(docs, labels, "toxic", lambda i: crc_rest(i, 3) != 1)
    for got in (quality.score_quality(docs, q, keep, schema),
                toxicity.score_toxicity(docs, t, keep, schema)):
        rows = got.collect()
        assert len(rows) == docs.count()
        assert all(0 <= r["score"] <= 1 for r in rows)
        by_id = {}
        for r in rows:
            by_id.setdefault(r["doc_id"], set()).add(round(r["score"], 12))
        assert len(by_id[4]) == 1  # a repeated row
        assert by_id[27] == by_id[28]  # null and empty
    kept = quality.accepted(docs, q, 0.0)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert kept.exceptAll(docs).count() == 0


def test_empty_tables(spark):
    docs, labels = documents(spark), labels_of(spark)
    none, no_labels = docs.limit(0), labels.limit(0)
    usable = crc_rest(F.col("__id"), 5) != 0
    model = quality.train(docs, no_labels, "quality", usable)
    scores = quality.score_quality(docs, model, [F.col("doc_id")], "doc_id long")
    assert {r["score"] for r in scores.collect()} == {0.5}
    assert quality.score_quality(none, quality.train(none, labels, "quality", usable),
                                 [F.col("doc_id")], "doc_id long").count() == 0
    model = toxicity.train(docs, no_labels, "toxic", lambda i: crc_rest(i, 3) != 1)
    scores = toxicity.score_toxicity(docs, model, [F.col("doc_id")], "doc_id long").collect()
    assert max(r["score"] for r in scores) < 1e-9
    model = toxicity.train(none, labels, "toxic", lambda i: crc_rest(i, 3) != 1)
    assert toxicity.score_toxicity(none, model, [F.col("doc_id")], "doc_id long").count() == 0


# -- slow versions -------------------------------------------------------------------

def sparse_rows(seed, rows, size):
    rng = np.random.default_rng(seed)
    dense = np.where(rng.random((rows, size)) < 0.3, rng.random((rows, size)), 0.0)
    dense[0] = 0.0  # a row without features
    ptr = np.concatenate([[0], np.cumsum((dense != 0).sum(axis=1))])
    index = np.concatenate([np.flatnonzero(r) for r in dense])
    return dense, ptr, index, dense[dense != 0]


def test_ftrl_is_the_dense_recurrence():
    dense, ptr, index, value = sparse_rows(1, 40, 12)
    label = (np.arange(40) % 3 == 0).astype(float)
    alpha, beta, l1, l2, epochs = 0.7, 1.0, 0.05, 0.3, 3
    w, bias = linear.ftrl(ptr, index, value, label, 12, alpha=alpha, beta=beta, l1=l1, l2=l2,
                          epochs=epochs, seed=4)
    z, n = [0.0] * 13, [0.0] * 13

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return (math.copysign(l1, z[i]) - z[i]) / ((beta + math.sqrt(n[i])) / alpha + l2)

    rng = np.random.default_rng(4)
    for _ in range(epochs):
        for r in rng.permutation(40):
            x = [*dense[r], 1.0]
            now = [weight(i) for i in range(13)]
            p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(now, x))))
            for i in range(13):
                g = (p - label[r]) * x[i]
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
                z[i] += g - sigma * now[i]
                n[i] += g * g
    want = [weight(i) for i in range(13)]
    assert np.allclose([*w, bias], want, atol=1e-5)


def risk(w, b, x, positive, prior, side):
    """The two parts of the positive-unlabelled risk on dense rows."""
    z = x @ w + b
    loss = np.logaddexp(0.0, -z)
    other = np.logaddexp(0.0, z)
    if side == "positive":
        return prior * loss[positive].mean()
    return other[~positive].mean() - prior * other[positive].mean()


@pytest.mark.parametrize("prior", [0.2, 0.9])
def test_one_step_follows_the_numeric_gradient_of_the_corrected_risk(prior):
    dense, ptr, index, value = sparse_rows(2, 30, 6)
    positive = np.arange(30) < 12
    w, b = linear.nnpu(ptr, index, value, positive, 6, prior, epochs=1, rate=0.1, l2=0.0, batch=64,
                       least_steps=1, seed=5)
    rng = np.random.default_rng(5)
    rng.permutation(np.flatnonzero(~positive))
    chosen = rng.choice(np.flatnonzero(positive), size=min(12, 32), replace=False)
    rows = np.concatenate([chosen, np.flatnonzero(~positive)])
    x, p = dense[rows], np.arange(len(rows)) < len(chosen)

    def total(v):
        corrected = risk(v[:6], v[6], x, p, prior, "unlabelled")
        at_start = risk(np.zeros(6), 0.0, x, p, prior, "unlabelled")
        # below zero the corrected part gives no gradient
        return risk(v[:6], v[6], x, p, prior, "positive") + (corrected if at_start > 0 else 0.0)

    step = 1e-6
    grad = np.array([(total(step * e) - total(-step * e)) / (2 * step) for e in np.eye(7)])
    want = -0.1 * grad / np.sqrt(grad * grad + 1e-8)
    assert np.allclose([*w, b], want, atol=1e-3)


def test_risk_on_negatives_is_not_pushed_below_zero():
    """With the true prior overstated the corrected part turns negative; its gradient stops."""
    dense, ptr, index, value = sparse_rows(3, 60, 8)
    positive = np.arange(60) < 30
    w, b = linear.nnpu(ptr, index, value, positive, 8, 0.9, epochs=200, rate=0.2, l2=0.0, batch=64)
    assert risk(w.astype(float), b, dense, positive, 0.9, "unlabelled") > -0.2


def test_dots_are_plain_sums():
    rng = np.random.default_rng(6)
    lengths = [0, 1, 2, 7, 300, 0, 5]
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    tokens = rng.integers(0, 50, offsets[-1]).astype(np.int32)
    bits = 10
    w = rng.normal(size=1 << bits)
    got = linear.dots(offsets, tokens, w, bits)
    for r, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        row = [int(t) for t in tokens[a:b]]
        m = 1 << 64
        keys = [(t * 0x9E3779B97F4A7C15 % m) >> (64 - bits) for t in row]
        for x, y in zip(row, row[1:]):
            two = 7 if x == y else (x * 0xC2B2AE3D27D4EB4F + y * 0x165667B19E3779F9) % m
            keys.append((two * 0x9E3779B97F4A7C15 % m) >> (64 - bits))
        count = Counter(keys)
        norm = math.sqrt(sum(math.log1p(c) ** 2 for c in count.values())) or 1.0
        assert math.isclose(got[r], sum(w[k] * math.log1p(c) / norm for k, c in count.items()),
                            abs_tol=1e-9)


@pytest.mark.parametrize("query, m, rest", [(op1_quality, 5, 0), (op5_toxicity, 3, 1)])
def test_held_out_folds_are_those_of_zlib(spark, query, m, rest):
    rows = query(spark, "/root/testdata/sf0.001").select("doc_id", "held_out").collect()
    assert rows and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % m == rest) for r in rows)


def test_models_do_not_depend_on_row_order_where_ids_repeat(spark):
    rows = [(k % 30, f"alder birch w{k} " + ("good cedar " if k % 2 else "poor elm ") * 5, "en", "s", 0)
            for k in range(90)]
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(30)],
                                   "doc_id long, quality int, toxic int")
    one, two = (documents(spark, r) for r in (rows, rows[::-1]))
    usable = crc_rest(F.col("__id"), 5) != 0
    a, b = (quality.train(d.repartition(5), labels, "quality", usable) for d in (one, two))
    assert (a[0] == b[0]).all() and a[1] == b[1]
    a, b = (toxicity.train(d.repartition(5), labels, "toxic", lambda i: crc_rest(i, 3) != 1)
            for d in (one, two))
    assert all(np.array_equal(x, y) for x, y in zip(a, b))
