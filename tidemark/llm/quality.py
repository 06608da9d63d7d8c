"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

Training takes at most ``max_labelled`` labelled rows (``MAX_LABELLED``), a documented
bound; scoring covers every row and its whole text with a model of ``2**bits`` floats.

Edge cases: null and empty texts have no n-grams and score the bias alone. A label
table without usable rows gives score 0.5 everywhere. Rows whose label is null are not
learnt from; of several labels for one id the largest counts, and of several texts the one with the
smallest hash. Repeated documents are
scored alike; repeated or null ids are kept as they are. Other columns, whatever their
names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_sample, hashed_tokens
from tidemark.llm.linear import fit, ftrl, keep_scored, score

BITS = 18
MAX_LABELLED = 12_000
EPOCHS = 8  # passes over the labelled rows


def labelled(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """One row (__id, __label) per labelled id."""
    rows = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    return rows.groupBy(F.col(id_col).alias("__id")).agg(
        F.max(F.col(label_col).cast("int")).alias("__label"))


def train(docs: DataFrame, labels: DataFrame, label_col: str, usable: Column, *,
          id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED,
          bits: int = BITS, epochs: int = EPOCHS):
    """Model (weights, bias) from labelled rows for which ``usable`` (on ``__id``) holds."""
    ids = bounded_sample(labelled(labels, id_col, label_col).where(usable), "__id",
                         max_labelled, 1)
    rows = docs.select(F.col(id_col).alias("__key"), F.col(text_col).alias("__text"))
    sample = rows.join(F.broadcast(ids), F.col("__key") == F.col("__id")) \
        .groupBy("__id", "__label").agg(F.min(
            F.struct(F.xxhash64("__text"), "__text"))["__text"].alias("__text")) \
        .select(F.col("__id").alias("__order"), "__label",
                hashed_tokens(F.col("__text")).alias("__tokens"))

    def learn(ptr, index, value, pdf):
        return ftrl(ptr, index, value, pdf["__label"].to_numpy(float), 1 << bits,
                    alpha=2.0, l1=0.1, epochs=epochs)

    return fit(sample, learn, bits)


def score_quality(docs: DataFrame, model, keep: list[Column], schema: str, *,
                  text_col: str = "text", bits: int = BITS) -> DataFrame:
    """``keep`` columns (types in ``schema``) and the quality score of each whole text."""
    return score(docs, F.col(text_col), keep, model, bits, schema)


def accepted(docs: DataFrame, model, least: float, *, text_col: str = "text",
             bits: int = BITS) -> DataFrame:
    """Rows of ``docs``, all columns, whose text scores at least ``least``."""
    return keep_scored(docs, F.col(text_col), model, bits, least)
