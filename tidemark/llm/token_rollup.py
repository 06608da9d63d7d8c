"""Token counts kept as delta-maintained rollups.

Changes to documents arrive in batches: inserts, deletes and revised counts. A batch is
reduced to signed additive totals per source, language and tokenizer version, and only
those are written; totals are the sum of all committed batches, so no batch reads the
documents of another.

A batch commits once: its totals go to a folder of their own, then a marker named after the
batch is created, which the file system allows one writer only, and the folder's name is
written into it. A batch that was replayed, or a task or driver that died half way, changes
nothing: folders without a marker are never read, and an empty marker, left by a driver that
died before it wrote the name, is not a commit; the replay replaces it.

Edge cases: null source, language or version are keys like any other. Null counts add 0.
Repeated rows are separate changes. An empty batch commits and adds nothing; a store
without batches has no totals. Keys whose totals have gone back to zero are left out. An
operation other than insert, delete or revise fails the batch before it commits. Other
columns of the changes are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "tokenizer_version"]
TOTALS = "source string, lang string, tokenizer_version string, documents long, tokens long"


def signed(changes: DataFrame) -> DataFrame:
    """Additive totals of a batch.

    ``changes`` has op, the keys, tokens, and old_tokens for revisions. An insert adds
    a document and its tokens, a delete takes them away, a revision adds the difference.
    """
    op = F.col("op")
    now = F.coalesce(F.col("tokens"), F.lit(0)).cast("long")
    old = F.coalesce(F.col("old_tokens"), F.lit(0)).cast("long")
    wrong = F.raise_error(F.concat(F.lit("unknown operation: "), F.coalesce(op, F.lit("null"))))
    documents = F.when(op == "insert", 1).when(op == "delete", -1).when(op == "revise", 0) \
        .otherwise(wrong.cast("int"))
    tokens = F.when(op == "insert", now).when(op == "delete", -now).when(op == "revise", now - old)
    return changes.groupBy(*KEYS).agg(F.sum(documents).cast("long").alias("documents"),
                                      F.sum(tokens).cast("long").alias("tokens"))


def file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def committed(fs, marker) -> bool:
    """Whether the marker exists and names a folder."""
    return fs.exists(marker) and fs.getFileStatus(marker).getLen() > 0


def commit(spark: SparkSession, root: str, batch_id: str, changes: DataFrame) -> bool:
    """Add a batch once. False if it had been committed before."""
    fs, marker = file_system(spark, f"{root}/commits/{batch_id}")
    if committed(fs, marker):
        return False
    folder = f"{batch_id}-{uuid.uuid4().hex}"
    signed(changes).write.parquet(f"{root}/batches/{folder}")
    if committed(fs, marker):
        return False
    if fs.exists(marker):
        fs.delete(marker, False)
    try:
        out = fs.create(marker, False)
    except Exception:
        if fs.exists(marker):  # another writer was first
            return False
        raise
    out.write(bytearray(folder.encode()))
    out.close()
    return True


def totals(spark: SparkSession, root: str) -> DataFrame:
    """documents and tokens per source, language and tokenizer version."""
    fs, commits = file_system(spark, f"{root}/commits")
    folders = [r[0] for r in spark.read.text(f"{root}/commits").collect()] \
        if fs.exists(commits) else []
    if not folders:
        return spark.createDataFrame([], TOTALS)
    deltas = spark.read.schema(TOTALS).parquet(*(f"{root}/batches/{x}" for x in folders))
    return deltas.groupBy(*KEYS).agg(F.sum("documents").alias("documents"),
                                     F.sum("tokens").alias("tokens")) \
        .where("documents != 0 or tokens != 0")


def count_words(col: Column) -> Column:
    """Tokenizer ``words-1``: runs of non-blank characters."""
    return F.regexp_count(F.coalesce(col, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def count_runs(col: Column) -> Column:
    """Tokenizer ``runs-1``: runs of letters and digits."""
    return F.regexp_count(F.coalesce(col, F.lit("")), F.lit(r"[\p{L}\p{N}]+")).cast("long")
