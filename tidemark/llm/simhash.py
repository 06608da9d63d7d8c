"""SimHash near-dedup: 64-bit fingerprints linked at a small Hamming distance.

Fingerprints are taken over whole texts. Equal fingerprints fall together first, so
copies never meet pairwise. Distinct ones are dealt to shards by a vantage-point tree: a
node sends a fingerprint inside when its distance to the vantage point is at most mu, else
outside, and those within the link distance of the boundary on the inner side go to both.
By the triangle inequality every pair within the link distance then shares a shard. Inside
a shard the same split recurses down to small sets that are compared exactly. A shard gives
back a spanning forest of its links, never all pairs, and components of the forest edges
are found by contraction.

The top tree is fitted on at most ``SAMPLE`` fingerprints (it only decides how work is
dealt, every fingerprint goes through it). A shard larger than ``BLOCK`` is dealt over
tasks as pairs of blocks.

Edge cases: null, empty and blank texts have fingerprint 0 and link like any other.
Texts with fewer words than a shingle hash their whole word sequence. Repeated rows share
their component; a null id takes no part in the smallest id, and a component of null ids
only has a null id. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut
from tidemark.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SAMPLE = 50_000
SHARD = 40_000
BLOCK = 96_000
SMALL = 2_048


def fingerprint(data: bytes | None, shingle: int) -> int:
    """SimHash of one text as an unsigned 64-bit integer."""
    import xxhash

    words = (data or b"").lower().split()  # bytes: A-Z and the ASCII blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])[:len(words) - shingle + 1]
    ends = ends[shingle - 1:] - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends.tolist())],
                      dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), 8192):
        part = hashes[k:k + 8192].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(id, th, fp) per document: th is a hash of the text, fp the signed fingerprint."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.xxhash64(F.col(text_col)).alias("th"),
                       F.col(text_col).cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x.as_py(), shingle) for x in batch.column(2)], dtype="<u8")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(fps.view("<i8"))], names=["id", "th", "fp"])

    return rows.mapInArrow(run, "id long, th long, fp long")


def distance(values: np.ndarray, one) -> np.ndarray:
    return np.bitwise_count(values ^ one)


def best_split(values: np.ndarray, bits: int, rng):
    """(vantage, mu) that leaves the least work, or None when no split helps."""
    best, n = None, len(values)
    for v in values[rng.integers(0, n, size=min(n, 6))]:
        counts = np.bincount(distance(values, v), minlength=65)
        inner = np.cumsum(counts)[:64]
        band = np.array([counts[max(0, mu - bits + 1):mu + 1].sum() for mu in range(64)])
        outer = n - inner + band
        cost = inner.astype(float) ** 2 + outer.astype(float) ** 2  # pairs left to compare
        mu = int(np.argmin(cost))
        if inner[mu] and (best is None or cost[mu] < best[0]):
            best = (cost[mu], v, mu)
    if best is None or best[0] > 0.95 * n * n:
        return None
    return best[1], best[2]


def grow(sample: np.ndarray, scale: float, bits: int, shard: float):
    """Top tree: nested (vantage, mu, inner, outer); a leaf is its number."""
    rng = np.random.default_rng(5)
    leaves = [0]

    def build(values):
        split = best_split(values, bits, rng) \
            if len(values) * scale > shard and len(values) >= 64 else None
        if split is None:
            leaves[0] += 1
            return leaves[0] - 1
        v, mu = split
        d = distance(values, v)
        return v, mu, build(values[d <= mu]), build(values[d > mu - bits])

    return build(sample)


def route(node, values: np.ndarray, at: np.ndarray, bits: int, out: list) -> None:
    """Append (leaf, row numbers) for every leaf that rows ``at`` reach."""
    if not len(at):
        return
    if not isinstance(node, tuple):
        out.append((node, at))
        return
    v, mu, inner, outer = node
    d = distance(values[at], v)
    route(inner, values, at[d <= mu], bits, out)
    route(outer, values, at[d > mu - bits], bits, out)


def forest(values: np.ndarray, bits: int) -> np.ndarray:
    """For distinct ``values``, the position of the smallest position linked with each."""
    label = np.arange(len(values))
    rng = np.random.default_rng(7)

    def compare(at):
        x = values[at]
        for k in range(0, len(x), 256):
            near = np.bitwise_count(x[k:k + 256, None] ^ x[None, k:]) <= bits
            for i in np.flatnonzero(near.sum(axis=1) > 1):
                roots = np.unique(label[at[k:][near[i]]])
                if len(roots) > 1:
                    label[np.isin(label, roots[1:])] = roots[0]

    todo = [np.arange(len(values))]
    while todo:
        at = todo.pop()
        split = best_split(values[at], bits, rng) if len(at) > SMALL else None
        if split is None:
            compare(at)
            continue
        v, mu = split
        d = distance(values[at], v)
        todo += [at[d <= mu], at[d > mu - bits]]
    return label


def links(distinct: DataFrame, *, bits: int = MAX_BITS, shard: int = SHARD, block: int = BLOCK,
          sample: int = SAMPLE) -> DataFrame:
    """Spanning edges (a, b) of the graph of distinct fingerprints (column fp) within ``bits``."""
    n = distinct.count()
    chosen = distinct
    if n > sample:
        at = int(sample / n * (1 << 31))
        chosen = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 31)) < at)
    seen = np.array([r[0] for r in chosen.limit(2 * sample).collect()], dtype=np.int64)
    tree = grow(seen.view(np.uint64), max(1.0, n / max(1, len(seen))), bits, shard)
    shared = distinct.sparkSession.sparkContext.broadcast(tree)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            out: list = []
            route(shared.value, fps.view(np.uint64), np.arange(len(fps)), bits, out)
            if out:
                leaf = np.concatenate([np.full(len(at), k) for k, at in out])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf.astype(np.int64)),
                     pa.array(fps[np.concatenate([at for _, at in out])])], names=["leaf", "fp"])

    dealt = cut(distinct.select("fp").mapInArrow(deal, "leaf long, fp long"))
    sizes = dealt.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    # One row per leaf of the tree, whose size follows from the bounded sample.
    dealt = dealt.join(F.broadcast(sizes), "leaf")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = dealt.withColumn("own", own).withColumn("other", other).select(
        "leaf", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")

    def span(key, pdf):
        import pandas as pd

        values = np.sort(pdf["fp"].to_numpy(np.int64))
        label = forest(values.view(np.uint64), bits)
        linked = label != np.arange(len(values))
        return pd.DataFrame({"a": values[label[linked]], "b": values[linked]})

    return pairs.groupBy("leaf", "i", "j").applyInPandas(span, "a long, b long")


def near_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """One row per document: id, th (hash of the text), fp (long), class_fp (a fingerprint
    naming the component) and component_id (smallest id in the component)."""
    rows = cut(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle))
    classes = cut(rows.groupBy("fp").agg(F.min("id").alias("least"),
                                         F.count(F.lit(1)).alias("n")))
    roots = components(links(classes.select("fp"), bits=bits)) \
        .select(F.col("node").alias("fp"), "root")
    # Only shared fingerprints and linked ones need a lookup; any other document is alone.
    named = classes.join(roots, "fp", "left").where("n > 1 or root is not null") \
        .select("fp", F.coalesce("root", "fp").alias("class_fp"), "least")
    named = cut(named)
    least = named.groupBy("class_fp").agg(F.min("least").alias("component_id"))
    named = cut(named.drop("least").join(least, "class_fp"))
    out = rows.join(named.withColumnRenamed("fp", "n_fp"), F.col("fp") == F.col("n_fp"), "left")
    return out.select(
        F.col("id").alias(id_col), "th", "fp", F.coalesce("class_fp", "fp").alias("class_fp"),
        F.when(F.col("n_fp").isNull(), F.col("id")).otherwise(F.col("component_id"))
        .alias("component_id"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """Rows of ``docs``, all columns: of each component the one with the smallest id (null
    ids last), then the smallest hash of the text."""
    last = F.lit((1 << 63) - 1)
    groups = near_groups(docs, id_col=id_col, text_col=text_col, shingle=shingle, bits=bits)
    keys = cut(groups.select(F.coalesce(F.col(id_col), last).alias("__kid"),
                             F.col("th").alias("__kth"), "class_fp"))
    rows = keys.groupBy("class_fp", "__kid", "__kth").agg(F.count(F.lit(1)).alias("n"))
    heads = cut(rows.groupBy("class_fp").agg(
        F.min(F.struct("__kid", "__kth", "n")).alias("head"),
        F.sum("n").alias("all")).where(F.col("all") > 1))
    others = keys.join(heads, "class_fp").where(
        F.struct("__kid", "__kth") != F.struct("head.__kid", "head.__kth")) \
        .select("__kid", "__kth").distinct()
    same = (F.coalesce(F.col(id_col).cast("long"), last) == F.col("__kid")) \
        & (F.xxhash64(F.col(text_col)) == F.col("__kth"))
    kept = docs.join(cut(others), same, "left_anti")
    # Heads that occur in several equal rows: one of them stays.
    again = heads.where("head.n > 1").select("head.__kid", "head.__kth")
    if again.isEmpty():
        return kept
    return kept.join(again, same, "left_anti").unionByName(
        kept.join(again, same, "left_semi").dropDuplicates([id_col, text_col]))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
