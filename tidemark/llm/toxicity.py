"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic rows are the positives; a sample of all usable texts, confirmed rows
included but without their label, is the unlabelled set. Words and their prefixes are
hashed; buckets that positives use clearly more often than the unlabelled set stay, and
a numpy classifier on them minimises the class-prior-corrected non-negative risk.

Training takes at most ``MAX_POSITIVE`` confirmed and ``MAX_UNLABELLED`` unlabelled rows,
documented bounds. Scoring covers every row and its whole text.

Edge cases: null and empty texts have no words and score the bias alone. Without a
confirmed row nothing can be learnt and every row scores 0. Null labels are not read; of
several labels for one id the largest counts. Repeated documents score alike, repeated or
null ids are kept, other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_sample, list_parts, row_blocks
from tidemark.llm.linear import nnpu, sigmoid
from tidemark.llm.quality import labelled

BITS = 18
PREFIXES = (3, 4, 5, 6, 7)
MAX_POSITIVE = 4_000
MAX_UNLABELLED = 8_000
LEAST_LIFT = 6.0
CACHE_WORDS = 500_000


def word_buckets(word: str, bits: int) -> list[int]:
    """Buckets of a word and of its proper prefixes."""
    import xxhash

    names = [word, *(f"{k}:{word[:k]}" for k in PREFIXES if len(word) > k)]
    return [xxhash.xxh64_intdigest(x.encode(), 42) & ((1 << bits) - 1) for x in names]


def words(col: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))),
                                F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"), F.lit(0))


def count_buckets(offsets, tokens: pa.Array, bits: int, kept, cache: dict):
    """(row, bucket, count) of the kept buckets; ``cache`` maps a word to its kept buckets."""
    coded = tokens.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    lists = []
    for w in coded.dictionary.to_pylist():
        f = cache.get(w)
        if f is None:
            f = word_buckets(w, bits)
            if kept is not None:
                f = [x for x in f if kept[x]]
            if len(cache) < CACHE_WORDS:
                cache[w] = f
        lists.append(f)
    sizes = np.array([len(f) for f in lists], dtype=np.int64)
    flat = np.array([x for f in lists for x in f], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    rows = np.repeat(np.arange(len(offsets) - 1, dtype=np.int64), np.diff(offsets))
    used = sizes[codes] > 0
    codes, rows = codes[used], rows[used]
    n = sizes[codes]
    at = np.repeat(starts[codes] - np.concatenate([[0], np.cumsum(n)])[:-1], n) + np.arange(n.sum())
    key, count = np.unique((np.repeat(rows, n) << bits) | flat[at], return_counts=True)
    return key >> bits, key & ((1 << bits) - 1), count


def one_text(rows: DataFrame) -> DataFrame:
    """One row per ``__key``: of several texts the one with the smallest hash."""
    return rows.groupBy("__key").agg(F.min(
        F.struct(F.xxhash64("__text"), "__text"))["__text"].alias("__text"))


def train(docs: DataFrame, labels: DataFrame, label_col: str, usable, *, id_col: str = "doc_id",
          text_col: str = "text", max_positive: int = MAX_POSITIVE,
          max_unlabelled: int = MAX_UNLABELLED, bits: int = BITS):
    """(kept buckets, weights, bias). ``usable`` maps an id column to a boolean column."""
    known = labelled(labels, id_col, label_col).where(usable(F.col("__id")))
    counts = known.agg(F.sum("__label").alias("p"), F.count(F.lit(1)).alias("n")).first()
    if not counts["p"]:
        return np.zeros(0, np.int64), np.zeros(0, np.float32), -35.0
    prior = min(0.9, max(1e-4, counts["p"] / counts["n"]))
    rows = docs.select(F.col(id_col).alias("__key"), F.col(text_col).alias("__text"))
    positive = bounded_sample(known.where("__label = 1"), "__id", max_positive, 2)
    unlabelled = bounded_sample(
        rows.where(usable(F.col("__key"))).select("__key"), "__key", max_unlabelled, 3)
    sides = [
        one_text(rows.join(F.broadcast(positive.select("__id")), F.col("__key") == F.col("__id")))
        .select("__key", F.lit(1).alias("__p"), "__text"),
        one_text(rows.join(
            F.broadcast(unlabelled.dropDuplicates().select(F.col("__key").alias("__id"))),
            F.col("__key").eqNullSafe(F.col("__id"))))
        .select("__key", F.lit(0).alias("__p"), "__text"),
    ]
    sample = sides[0].unionByName(sides[1]).select(
        F.col("__key").cast("string").alias("id"), F.col("__p").alias("p"),
        words(F.col("__text")).alias("w"))

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for batch in batches:
            offsets, tokens = list_parts(batch.column(2))
            for lo, hi in row_blocks(offsets):
                r, i, c = count_buckets(offsets[lo:hi + 1] - offsets[lo],
                                        tokens.slice(offsets[lo], offsets[hi] - offsets[lo]),
                                        bits, None, cache)
                ends = np.concatenate([[0], np.cumsum(np.bincount(r, minlength=hi - lo))])
                ends = pa.array(ends.astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                    pa.ListArray.from_arrays(ends, pa.array(i.astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(np.log1p(c).astype(np.float32))),
                ], names=["id", "p", "i", "v"])

    featured = sample.mapInArrow(buckets, "id string, p int, i array<int>, v array<float>")

    def learn(pdf):
        import pandas as pd

        pdf = pdf.sort_values(["p", "id"], kind="stable", na_position="first")
        size = 1 << bits
        ptr = np.concatenate([[0], np.cumsum(pdf["i"].map(len).to_numpy())]).astype(np.int64)
        index = np.concatenate([np.asarray(x, np.int64) for x in pdf["i"]])
        value = np.concatenate([np.asarray(x, np.float64) for x in pdf["v"]])
        is_p = pdf["p"].to_numpy() == 1
        if not is_p.any() or is_p.all():
            return pd.DataFrame({"k": [b""], "w": [b""], "b": [-35.0]})
        owner = np.repeat(np.arange(len(pdf)), np.diff(ptr))
        n_p, n_u = is_p.sum(), (~is_p).sum()
        in_p = np.bincount(index[is_p[owner]], minlength=size) / n_p
        in_u = np.bincount(index[~is_p[owner]], minlength=size) / n_u
        lift = (in_p - in_u) / np.sqrt((in_u + 1.0 / len(pdf)) * (1.0 / n_p + 1.0 / n_u))
        kept = (lift > LEAST_LIFT) & (in_p * n_p >= 3)
        at = kept[index]
        ptr = np.concatenate([[0], np.cumsum(np.bincount(owner[at], minlength=len(pdf)))])
        w, b = nnpu(ptr, index[at], value[at], is_p, size, prior, epochs=40, rate=0.3,
                    l2=1e-5, batch=1024)
        k = np.flatnonzero(kept)
        return pd.DataFrame({"k": [k.astype("<i8").tobytes()], "w": [w[k].astype("<f4").tobytes()],
                             "b": [b]})

    got = featured.groupBy(F.lit("all")).applyInPandas(
        lambda key, pdf: learn(pdf), "k binary, w binary, b double").collect()
    if not got:
        return np.zeros(0, np.int64), np.zeros(0, np.float32), -35.0
    return (np.frombuffer(got[0]["k"], "<i8"), np.frombuffer(got[0]["w"], "<f4"), got[0]["b"])


def score_toxicity(docs: DataFrame, model, keep: list[Column], schema: str, *,
                   text_col: str = "text", bits: int = BITS) -> DataFrame:
    """``keep`` columns (types in ``schema``) and the toxicity score of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, words(F.col(text_col)).alias("__words"))

    def dot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, w, b = shared.value
        weights = np.zeros(1 << bits)
        weights[k] = w
        kept = np.zeros(1 << bits, dtype=bool)
        kept[k] = True
        cache: dict = {}
        for batch in batches:
            offsets, tokens = list_parts(batch.column(batch.num_columns - 1))
            out = np.full(batch.num_rows, b)
            for lo, hi in row_blocks(offsets):
                r, i, c = count_buckets(offsets[lo:hi + 1] - offsets[lo],
                                        tokens.slice(offsets[lo], offsets[hi] - offsets[lo]),
                                        bits, kept, cache)
                out[lo:hi] += np.bincount(r, weights[i] * np.log1p(c), minlength=hi - lo)
            cols = [*batch.columns[:-1], pa.array(sigmoid(out))]
            yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names[:-1], "score"])

    return rows.mapInArrow(dot, f"{schema}, score double")
