"""Shared helpers of the corpus operators: table reads, shared folders, hashed tokens."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir, scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# ASCII blanks only: the word rule shared by the word-based operators.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` once to the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For loops: a checkpoint keeps what the optimizer inferred about its columns, and joins of
    joins of checkpoints multiply that; a table read back starts afresh.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def lower_ascii(col: Column) -> Column:
    return F.translate(col, UPPER, UPPER.lower())


def blank_words(col: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; an empty array for null or blank text."""
    words = F.split(F.coalesce(col, F.lit("")), BLANKS)
    return F.filter(words, lambda w: w != "")


def hashed_tokens(col: Column) -> Column:
    """31-bit hashes of letter/digit runs and symbol runs, in text order."""
    tokens = F.regexp_extract_all(
        F.lower(F.coalesce(col, F.lit(""))),
        F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"), F.lit(0))
    return F.transform(tokens, lambda t: F.xxhash64(t).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))


def crc_rest(id_col: Column, m: int) -> Column:
    """crc32(doc_id as text) mod m; null ids count as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % m


def sparse_ngrams(offsets: np.ndarray, tokens: np.ndarray, bits: int):
    """Hashed 1- and 2-grams of many token rows as CSR (ptr, index, value).

    ``offsets`` has one entry more than there are rows. Values are log(1 + count),
    scaled to unit length per row. A word that repeats its predecessor gives one
    common bigram, whatever the word. Rows without tokens have no entries.
    """
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    rows = np.repeat(np.arange(n, dtype=np.int64), lengths)
    t = tokens.astype(np.uint64)
    mask = np.uint64((1 << bits) - 1)
    mixed = (t * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
    keys = [(rows.astype(np.uint64) << np.uint64(bits)) | mixed]
    if len(t) > 1:
        inside = rows[1:] == rows[:-1]
        two = (t[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + t[1:] * np.uint64(0x165667B19E3779F9))
        two = np.where(t[:-1] == t[1:], np.uint64(7), two) * np.uint64(0x9E3779B97F4A7C15)
        two = two >> np.uint64(64 - bits)
        keys.append(((rows[1:].astype(np.uint64) << np.uint64(bits)) | two)[inside])
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    row = (key >> np.uint64(bits)).astype(np.int64)
    index = (key & mask).astype(np.int64)
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(row, value * value, minlength=n))
    value = value / norm[row]
    ptr = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))])
    return ptr, index, value


def row_blocks(offsets: np.ndarray, most: int = 500_000):
    """Cut rows into blocks of about ``most`` tokens: yields (first, last) row numbers."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def list_parts(column):
    """(offsets from 0, Arrow values) of an Arrow list column, nulls as empty lists."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    return offsets, column.flatten()


def bounded_sample(df: DataFrame, id_col: str, k: int, salt: int) -> DataFrame:
    """About uniform sample of at most ``k`` rows, the same on every run.

    A hash threshold taken from the row count lets only about 2k rows reach the final
    sort, however large ``df`` is.
    """
    h = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(salt))
    n = df.count()
    if n > 2 * k:
        df = df.where(F.pmod(h, F.lit(1 << 31)) < int((2.0 * k / n) * (1 << 31)))
    return df.orderBy(h, F.col(id_col)).limit(k)
