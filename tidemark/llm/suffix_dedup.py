"""Suffix-array dedup by bucket-pointer refinement: bytes under long strings that repeat.

Positions are refined from buckets of short grams to buckets of whole windows (400 bytes).
A bucket of length L is refined by sorting its positions on the bucket of the position L later,
so one round doubles the length, and every round reuses the buckets that the last one
made. Positions alone in their bucket are finished and leave.

Rounds over all positions at once would shuffle many times the input. Positions are therefore
dealt so that a task can refine its own to the end: every window is dealt by the smallest
hash among its q-grams (q is half the window), its seed, and neighbours that share a seed travel
as one run of bytes. Equal windows have equal seeds, so they always meet, and all later
offsets of a run lie inside its bytes. Seeds with a single run are finished; runs equal in whole are
settled at once and sent on once. What is left is dealt in bounded lots, each refined by
ranks, which compare bytes exactly. Hashes (128 bits) decide only which runs are equal in whole.

No group is gathered whole: runs are counted with map-side sums, and a seed with very many
different runs is compared window by window through a shuffle.

Edge cases: null and empty texts have no bytes. Texts below the length are never touched.
Matches don't cross documents. Repeated rows are copies of each other and so lose all they
share; rows that repeat id and text get the same result. Very long texts are read in pieces that
overlap by a window less one byte. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut

LENGTH = 400
MANY = 4_000  # different runs of a seed, beyond which windows are compared one by one
LOT_BYTES = 2 << 20
BLOCK_BYTES = 1 << 20
TIE_BITS = 32  # low bits of a gram's order that hold its position


def refine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bucket of a longer gram from the buckets at its start and at a later offset."""
    x = a * np.uint64(0x9E3779B97F4A7C15)
    x += b * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def gram_buckets(data: np.ndarray, q: int) -> np.ndarray:
    """Bucket of the q-gram at every position of a byte array."""
    have, ids = 1, data.astype(np.uint64) + np.uint64(1)
    while have * 2 <= q and have < 8:
        ids, have = refine(ids[:-have], ids[have:]), have * 2
    while have < q:
        step = min(have, q - have)
        if len(ids) <= step:
            return ids[:0]
        ids, have = refine(ids[:-step], ids[step:]), have + step
    return ids


class Block:
    """Runs of the windows of several documents laid end to end."""

    def __init__(self, texts: list[bytes], length: int):
        self.length, q = length, length // 2
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.base = np.concatenate([[0], np.cumsum(sizes)])
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        grams = gram_buckets(data, q)
        rest = length - q
        self.windows = refine(grams[:-rest], grams[rest:]) if len(grams) > rest else grams[:0]
        n = len(self.windows)
        # Smallest bucket among the q-grams of each window; the position, in the low bits,
        # settles ties to the left.
        low = np.uint64(TIE_BITS)
        mixed = (grams * np.uint64(0xD6E8FEB86659FD93)) >> low << low
        least = mixed | np.arange(len(grams), dtype=np.uint64)
        span, width = 1, rest + 1
        while span * 2 <= width:
            least, span = np.minimum(least[:-span], least[span:]), span * 2
        if span < width:
            least = np.minimum(least[:len(least) - (width - span)], least[width - span:])
        seed = (least[:n] & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
        starts = np.arange(n, dtype=np.int64)
        self.doc = np.searchsorted(self.base, starts, side="right") - 1
        inside = starts + length <= self.base[self.doc + 1]
        key = np.where(inside, seed, -1)
        change = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if n else starts
        ends = np.concatenate([change[1:], [n]]) if n else starts
        good = key[change] >= 0 if n else np.zeros(0, bool)
        self.first, self.last = change[good], ends[good] - 1
        at = key[self.first]
        self.bucket = grams[at]
        shape = ((at - self.first) * np.int64(1 << 20) + (self.last - self.first)).astype(np.uint64)
        self.whole = refine(refine(self.windows[self.first], self.windows[self.last]), shape)


def pieces(sizes: list[int], length: int, most: int) -> Iterator[list[tuple[int, int, int]]]:
    """Lots of (text, from, to) of about ``most`` bytes that hold every window of every text once.

    A text above ``most`` is read in parts that overlap by ``length - 1`` bytes.
    """
    lot, size = [], 0
    for k, total in enumerate(sizes):
        for lo in range(0, max(1, total - length + 1), most):
            part = (k, lo, min(total, lo + most + length - 1))
            if lot and size + part[2] - lo > most + length:
                yield lot
                lot, size = [], 0
            lot.append(part)
            size += part[2] - lo
    if lot:
        yield lot


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(kid, kth, id, t): two 64-bit hashes of id and text name the row."""
    of = F.col(id_col).cast("long"), F.col(text_col)
    return docs.select(
        F.xxhash64(*of).alias("kid"), F.xxhash64(*reversed(of), F.lit(1)).alias("kth"),
        of[0].alias("id"), F.coalesce(of[1].cast("binary"), F.lit(b"")).alias("t"))


def merged(spans: np.ndarray) -> np.ndarray:
    """Union of [start, end) rows; touching ones join."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    at = np.flatnonzero(new)
    return np.stack([spans[at, 0], reach[np.concatenate([at[1:] - 1, [len(spans) - 1]])]], axis=1)


def first_buckets(data: np.ndarray, room: np.ndarray, q: int) -> np.ndarray:
    """Rank of the q-gram (q <= 8) at every position with room for it, -1 if it is alone."""
    value = np.zeros(len(data), dtype=np.uint64)
    for k in range(q):
        value[:len(data) - k] |= data[k:].astype(np.uint64) << np.uint64(8 * (q - 1 - k))
    at = np.flatnonzero(room >= q)
    return ranked(value[at], at, len(data))


def ranked(keys: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Bucket of positions ``at`` by the order of their keys; -1 elsewhere and where alone."""
    out = np.full(n, -1, dtype=np.int64)
    if len(at):
        _, back, count = np.unique(keys, return_inverse=True, return_counts=True)
        shared = count[back] > 1
        out[at[shared]] = back[shared]
    return out


def repeated_windows(runs: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(start of each run in the joined bytes, True where a window's string starts twice or more).

    A run of n + length - 1 bytes has n windows.
    """
    data = np.frombuffer(b"".join(runs), dtype=np.uint8)
    sizes = np.array([len(r) for r in runs], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    room = np.repeat(starts[1:], sizes) - np.arange(len(data))
    have = min(8, length)
    bucket = first_buckets(data, room, have)
    while have < length:
        step = min(have, length - have)
        at = np.flatnonzero((bucket >= 0) & (room >= have + step))
        at = at[bucket[at + step] >= 0]
        bucket = ranked(bucket[at] * len(data) + bucket[at + step], at, len(data))
        have += step
    return starts[:-1], bucket >= 0


def window_spans(runs: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run, lo, hi) of the stretches of repeated windows in each run, as byte spans."""
    starts, hit = repeated_windows(runs, length)
    # The last windows of a run are followed by length - 1 bytes that start none, so stretches of
    # neighbouring runs never touch, unless a window is a single byte.
    edge = np.concatenate([[False], hit, [False]])
    begin, stop = edge[1:-1] & ~edge[:-2], edge[1:-1] & ~edge[2:]
    begin[starts], stop[starts[1:] - 1] = hit[starts], hit[starts[1:] - 1]
    begin, stop = np.flatnonzero(begin), np.flatnonzero(stop)
    run = np.searchsorted(starts, begin, side="right") - 1
    return run, begin - starts[run], stop - starts[run] + length


def removed_spans(rows: DataFrame, length: int, many: int) -> DataFrame:
    """(kid, kth, spans): set of struct(lo, hi) byte spans to remove, unmerged."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.as_py() for x in batch.column(2)]
            for lot in pieces([len(t) for t in texts], length, BLOCK_BYTES):
                b = Block([texts[k][lo:hi] for k, lo, hi in lot], length)
                doc = b.doc[b.first]
                at = pa.array(np.array([k for k, _, _ in lot])[doc])
                offset = np.array([lo for _, lo, _ in lot], dtype=np.int64)[doc]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b.bucket.view(np.int64)), pa.array(b.whole.view(np.int64)),
                     batch.column(0).take(at), batch.column(1).take(at),
                     pa.array((b.first - b.base[doc] + offset).astype(np.int32)),
                     pa.array((b.last - b.first + 1).astype(np.int32))],
                    names=["h", "whole", "kid", "kth", "p", "n"])

    long_rows = rows.where(F.length("t") >= length).select("kid", "kth", "t")
    runs = long_rows.mapInArrow(scan, "h long, whole long, kid long, kth long, p int, n int")
    # Seeds with a single run are finished.
    shared = cut(runs.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h"))
    live = cut(runs.join(shared, "h", "left_semi"))

    classes = cut(live.groupBy("h", "whole").agg(
        F.count(F.lit(1)).alias("c"), F.min(F.struct("kid", "kth", "p", "n")).alias("r")))
    repeated = classes.where("c > 1").select("h", "whole")
    settled = live.join(repeated, ["h", "whole"], "left_semi").select(
        "kid", "kth", F.struct(F.col("p").alias("lo"), (F.col("p") + F.col("n") + (length - 1))
                               .alias("hi")).alias("s"))
    heads = classes.groupBy("h").agg(F.count(F.lit(1)).alias("d"),
                                     F.sum((F.col("c") == 1).cast("int")).alias("open")) \
        .where("d > 1 and open > 0")
    todo = classes.join(heads, "h").select(
        "r.kid", "r.kth", "r.p", "r.n", "h", (F.col("c") == 1).alias("open"),
        (F.col("d") > many).alias("wide"))
    # Rows that repeat id and text are one here.
    once = long_rows.groupBy("kid", "kth").agg(F.first("t").alias("t"))
    opened = cut(once.join(todo, ["kid", "kth"]).select(
        "kid", "kth", "p", "n", "h", "open", "wide",
        F.substring(F.col("t"), F.col("p") + 1, F.col("n") + (length - 1)).alias("b")))
    total = opened.where("not wide").agg(F.sum(F.length("b"))).first()[0] or 0
    lots = max(1, -(-int(total) // LOT_BYTES))

    def refined_lot(key, pdf):
        import pandas as pd

        run, lo, hi = window_spans(pdf["b"].tolist(), length)
        p = pdf["p"].to_numpy()[run]
        out = pd.DataFrame({"kid": pdf["kid"].to_numpy()[run], "kth": pdf["kth"].to_numpy()[run],
                            "lo": (p + lo).astype(np.int32), "hi": (p + hi).astype(np.int32)})
        return out[pdf["open"].to_numpy()[run]]

    lot = F.pmod(F.xxhash64("h"), F.lit(lots))
    narrow = opened.where("not wide").groupBy(lot.alias("lot")).applyInPandas(
        refined_lot, "kid long, kth long, lo int, hi int")
    single = opened.where("wide").withColumn("d", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    window = F.substring(F.col("b"), F.col("d") + 1, F.lit(length))
    single = single.select("kid", "kth", "open", "h", (F.col("p") + F.col("d")).alias("lo"),
                           F.xxhash64(window).alias("w"))
    twice = single.groupBy("h", "w").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h", "w")
    wide = single.where("open").join(twice, ["h", "w"], "left_semi").select(
        "kid", "kth", "lo", (F.col("lo") + length).alias("hi"))
    refined = narrow.unionByName(wide).select("kid", "kth", F.struct("lo", "hi").alias("s"))
    return settled.unionByName(refined).groupBy("kid", "kth").agg(F.collect_set("s").alias("spans"))


def dedup_bytes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                length: int = LENGTH, many: int = MANY, with_text: bool = False) -> DataFrame:
    """Per document: id, n_bytes, n_removed, n_spans, kept_sha256 (and kept bytes if asked)."""
    rows = keyed(docs, id_col, text_col)
    spans = cut(removed_spans(rows, length, many))
    joined = rows.join(spans, ["kid", "kth"], "left").select("id", "t", "spans")
    schema = f"{id_col} long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", kept binary" if with_text else ""

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for t, s in zip(batch.column(1), batch.column(2)):
                data = t.as_py()
                gone = np.zeros((0, 2), dtype=np.int64)
                if s.is_valid and len(s.values):
                    gone = merged(np.stack([s.values.field(k).to_numpy().astype(np.int64)
                                            for k in ("lo", "hi")], axis=1))
                edges = [0, *gone.ravel().tolist(), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                for col, v in zip(out, (len(data), len(data) - len(kept), len(gone),
                                        hashlib.sha256(kept).hexdigest(), kept)):
                    col.append(v)
            cols = [batch.column(0), *(pa.array(c) for c in out[:4])]
            names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                cols, names = [*cols, pa.array(out[4], pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return joined.mapInArrow(render, schema)
