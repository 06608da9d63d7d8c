"""Benchmark decontamination: a BM25 index of test items queried by every training passage.

Items are indexed with BM25 impacts divided by the score an item gives itself, so one
threshold serves items of any length. Passages are windows of twice the longest item of a
length class, half overlapping, so an item that occurs in a text lies whole in one of them.
Each passage is a query. Block maxima of the rarer terms first rule out almost all
passages in numpy; what is left runs block-max WAND over the postings and gets back every
item above the threshold. A hit counts when its five-word shingles are confirmed in the
passage: at least ``OVERLAP`` of the item's, with a share of both question and answer.

Document frequencies and lengths cover all items. The index is built in slices of at
most about ``SLICE_TOKENS`` words, so what is broadcast stays bounded however many items
there are; each slice is one more pass over the documents.

Edge cases: words are lower-cased letter/digit runs. Items without words are ignored; items
shorter than a shingle must occur whole. An item of one sentence is question and answer at
once, unless an answer column is given; closing quotes, brackets, symbols and blanks at its end
are no answer. A question or answer without words (null, empty, symbols) stands for the whole
item. Null and empty texts match nothing. Repeated
documents or items give repeated hits. An empty table on either side gives no rows. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, list_parts, row_blocks

THRESHOLD = 0.5
OVERLAP = 0.8
SHINGLE = 5
BLOCK_ITEMS = 8
SLICE_TOKENS = 400_000
K1, B = 1.2, 0.75


def word_hashes(col: Column) -> Column:
    words = F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))),
                                 F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.transform(words, lambda w: F.xxhash64(w).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))


def shingles(tokens: np.ndarray, k: int) -> set[bytes]:
    t = np.ascontiguousarray(tokens, dtype=np.int32)
    if not len(t):
        return set()
    if len(t) < k:
        return {t.tobytes()}
    return {t[i:i + k].tobytes() for i in range(len(t) - k + 1)}


class LengthClass:
    """Postings, block maxima and shingles of the items of one length class."""

    def __init__(self, items: list[dict], size: int, threshold: float, shingle: int):
        self.items, self.size = items, size
        self.need = threshold
        impacts: dict[int, list[tuple[int, float]]] = {}
        rare: dict[int, dict[int, float]] = {}
        self.blocks = -(-len(items) // BLOCK_ITEMS)
        common = np.zeros(self.blocks)
        for n, item in enumerate(items):
            pairs = sorted(zip(item["impacts"], item["terms"]))
            rest = 0.0
            for value, term in pairs:
                impacts.setdefault(term, []).append((n, value))
                # The least telling terms, up to half the threshold, are left to a constant.
                if rest + value <= threshold / 2:
                    rest += value
                else:
                    cell = rare.setdefault(term, {})
                    cell[n // BLOCK_ITEMS] = max(cell.get(n // BLOCK_ITEMS, 0.0), value)
            common[n // BLOCK_ITEMS] = max(common[n // BLOCK_ITEMS], rest)
        self.postings = {}
        for term, rows in impacts.items():
            at = [n for n, _ in rows]
            values = [v for _, v in rows]
            tops: dict[int, float] = {}
            for n, v in rows:
                tops[n // BLOCK_ITEMS] = max(tops.get(n // BLOCK_ITEMS, 0.0), v)
            self.postings[term] = (at, values, tops, max(values))
        self.rare = np.array(sorted(rare), dtype=np.int64)
        lists = [sorted(rare[t].items()) for t in self.rare.tolist()]
        self.first = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        self.block = np.array([b for x in lists for b, _ in x], dtype=np.int64)
        self.top = np.array([v for x in lists for _, v in x])
        self.least = threshold - common - 1e-9
        self.shingles = [[shingles(np.array(x, dtype=np.int32), shingle)
                          for x in (i["all"], i["question"], i["answer"])] for i in items]

    def passages(self, offsets: np.ndarray, tokens: np.ndarray) -> Iterator[tuple[int, int]]:
        """(row, first token) of the passages that block maxima can't rule out."""
        lengths = np.diff(offsets)
        cells = -(-lengths // self.size) + 1  # one empty cell parts a row from the next
        base = np.concatenate([[0], np.cumsum(cells)])
        if not len(self.rare) or not len(tokens):
            return
        at = np.searchsorted(self.rare, tokens)
        hit = np.flatnonzero(self.rare[np.minimum(at, len(self.rare) - 1)] == tokens)
        row = np.searchsorted(offsets, hit, side="right") - 1
        cell = base[row] + (hit - offsets[row]) // self.size
        term = at[hit]
        count = self.first[term + 1] - self.first[term]
        before = np.cumsum(count) - count
        post = np.repeat(self.first[term] - before, count) + np.arange(count.sum())
        key = np.repeat(cell, count) * self.blocks + self.block[post]
        bound = np.bincount(key, self.top[post], minlength=int(base[-1]) * self.blocks)
        bound = bound.reshape(-1, self.blocks)
        both = bound.copy()
        both[:-1] += bound[1:]
        for c in np.flatnonzero((both >= self.least).any(axis=1)):
            r = int(np.searchsorted(base, c, side="right") - 1)
            start = int(offsets[r] + (c - base[r]) * self.size)
            if start < offsets[r + 1]:
                yield r, start

    def search(self, terms) -> list[tuple[int, float]]:
        """Block-max WAND: all (item, score) with score >= the threshold."""
        need = self.need - 1e-9
        cursors = [[p[0][0], 0, *p] for t in terms if (p := self.postings.get(t))]
        found = []
        while cursors:
            cursors.sort(key=lambda c: c[0])
            total, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                total += c[5]
                if total >= need:
                    pivot = k
                    break
            if pivot < 0:
                break
            doc = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == doc:
                pivot += 1
            block = doc // BLOCK_ITEMS
            if sum(c[4].get(block, 0.0) for c in cursors[:pivot + 1]) < need:
                # No item of this block up to the next cursor can reach the threshold.
                target = (block + 1) * BLOCK_ITEMS
                if pivot + 1 < len(cursors):
                    target = min(target, cursors[pivot + 1][0])
                target = max(target, doc + 1)
            elif cursors[0][0] == doc:
                score = sum(c[3][c[1]] for c in cursors[:pivot + 1])
                if score >= need:
                    found.append((doc, score))
                target = doc + 1
            else:
                target = doc
            for c in cursors[:pivot + 1]:
                at, k = c[2], c[1]
                while k < len(at) and at[k] < target:
                    k += 1
                c[1] = k
                c[0] = at[k] if k < len(at) else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return found


def index_rows(items: DataFrame, id_col: str, text_col: str,
               answer_col: str | None) -> tuple[DataFrame, int]:
    """One row per item (words, question, answer, distinct terms, impacts), and the slices."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    if answer_col:
        answer = F.coalesce(F.col(answer_col), F.lit(""))
        question, whole = text, F.concat_ws("\n", text, answer)
    else:
        # Up to the last letter or digit, so that the last sentence always has a word.
        body = F.regexp_extract(text, r"(?s)^(.*[\p{L}\p{N}])", 1)
        answer = F.regexp_extract(body, r"([^.!?\n]*)$", 1)
        cut_off = F.length(body) - F.length(answer)
        question = F.substring(body, F.lit(1), cut_off)
        whole = text
    rows = items.select(
        F.col(id_col).cast("long").alias("item"), F.monotonically_increasing_id().alias("row"),
        word_hashes(whole).alias("all"), word_hashes(question).alias("question"),
        word_hashes(answer).alias("answer")).where(F.size("all") > 0)
    rows = rows.withColumns({side: F.when(F.size(side) > 0, F.col(side)).otherwise(F.col("all"))
                             for side in ("question", "answer")})
    rows = cut(rows)
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("all")).alias("mean"),
                     F.sum(F.size("all")).alias("tokens")).first()
    n, mean = stats["n"], stats["mean"] or 1.0
    terms = rows.select("row", F.size("all").alias("dl"), F.explode("all").alias("term")) \
        .groupBy("row", "dl", "term").agg(F.count(F.lit(1)).alias("tf"))
    df = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log1p((F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) \
        / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.lit(float(mean))))
    impacts = terms.join(df, "term").withColumn("w", weight).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("term", "w"))).alias("p"))
    slices = max(1, -(-(stats["tokens"] or 0) // SLICE_TOKENS))
    return cut(rows.join(impacts, "row").select(
        "item", "row", "all", "question", "answer", F.col("p.term").alias("terms"),
        F.transform("p.w", lambda w: w / F.aggregate("p.w", F.lit(0.0), lambda a, b: a + b))
        .alias("impacts"), F.pmod(F.xxhash64("row"), F.lit(slices)).alias("slice"))), slices


def find_hits(offsets: np.ndarray, flat: np.ndarray, classes: list[LengthClass],
              overlap: float) -> dict[tuple[int, int], tuple]:
    """(row, item row) -> (item, score, overlaps) of the confirmed hits of token rows."""
    most = max([x.blocks / x.size for x in classes], default=1.0)
    limit = max(20_000, min(500_000, int(8e6 / most)))
    out: dict = {}
    for lo, hi in row_blocks(offsets, limit):
        for c in classes:
            for first, ends, part in stretches(offsets, flat, lo, hi, c.size, limit):
                for r, start in c.passages(ends, part):
                    end = offsets[lo + r + 1]
                    at = first + start
                    window = flat[at:min(at + 2 * c.size, int(end))]
                    for n, score in c.search(np.unique(window).tolist()):
                        got = [share(window, s) for s in c.shingles[n]]
                        if got[0] >= overlap and got[1] > 0 and got[2] > 0:
                            key = (lo + r, c.items[n]["row"])
                            row = (c.items[n]["item"], score, *got)
                            out[key] = max(out.get(key, row), row)
    return out


def stretches(offsets: np.ndarray, flat: np.ndarray, lo: int, hi: int, size: int, limit: int):
    """Rows lo to hi as (first token, offsets, tokens). A single row above ``limit`` comes in
    pieces of whole cells that overlap by one cell, so every passage lies in one of them."""
    first, last = int(offsets[lo]), int(offsets[hi])
    if hi - lo > 1 or last - first <= limit:
        yield first, offsets[lo:hi + 1] - first, flat[first:last]
        return
    step = max(1, limit // size) * size
    for at in range(first, last, step):
        stop = min(last, at + step + size)
        yield at, np.array([0, stop - at], dtype=np.int64), flat[at:stop]


def item_slices(items: DataFrame, item_col: str, text_col: str, answer_col: str | None):
    """Broadcast slices of the index: items by length class, bounded in words each."""
    index, slices = index_rows(items, item_col, text_col, answer_col)
    for k in range(slices):
        by_size: dict[int, list[dict]] = {}
        for r in index.where(F.col("slice") == k).drop("slice").orderBy("item", "row").collect():
            size = 1 << max(3, int(len(r["all"]) - 1).bit_length())
            by_size.setdefault(size, []).append(r.asDict())
        yield items.sparkSession.sparkContext.broadcast(by_size)


def contaminated(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                 answer_col: str | None = None, threshold: float = THRESHOLD,
                 overlap: float = OVERLAP, shingle: int = SHINGLE) -> DataFrame:
    """Confirmed hits: id, item_id, score, overlap, question_overlap, answer_overlap."""
    names = ["id", "item_id", "score", "overlap", "question_overlap", "answer_overlap"]
    schema = ", ".join(f"{c} {'long' if c.endswith('id') else 'double'}" for c in names)
    found = None
    for shared in item_slices(items, item_col, item_text_col, answer_col):

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            classes = [LengthClass(x, size, threshold, shingle)
                       for size, x in sorted(shared.value.items())]
            for batch in batches:
                offsets, flat = list_parts(batch.column(1))
                out = find_hits(offsets, flat.to_numpy(zero_copy_only=False), classes, overlap)
                at = pa.array([r for r, _ in out], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), pa.array([v[0] for v in out.values()], pa.int64()),
                     *[pa.array([v[j] for v in out.values()], pa.float64()) for j in range(1, 5)]],
                    names=names)

        part = docs.select(F.col(id_col).cast("long").alias("id"),
                           word_hashes(F.col(text_col)).alias("t")).mapInArrow(scan, schema)
        found = part if found is None else found.unionByName(part)
    return found.withColumnRenamed("id", id_col)


def clean(docs: DataFrame, items: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", answer_col: str | None = None,
          threshold: float = THRESHOLD, overlap: float = OVERLAP,
          shingle: int = SHINGLE) -> DataFrame:
    """Rows of ``docs``, all columns, in which no item is confirmed."""
    schema = docs.schema
    for shared in item_slices(items, item_col, item_text_col, answer_col):

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            classes = [LengthClass(x, size, threshold, shingle)
                       for size, x in sorted(shared.value.items())]
            for batch in batches:
                offsets, flat = list_parts(batch.column(batch.num_columns - 1))
                keep = np.ones(batch.num_rows, dtype=bool)
                for r, _ in find_hits(offsets, flat.to_numpy(zero_copy_only=False), classes,
                                      overlap):
                    keep[r] = False
                rest = pa.RecordBatch.from_arrays(batch.columns[:-1],
                                                  names=batch.schema.names[:-1])
                yield rest.filter(pa.array(keep))

        docs = docs.select("*", word_hashes(F.col(text_col)).alias("__words")) \
            .mapInArrow(scan, schema)
    return docs


def share(window: np.ndarray, wanted: set[bytes]) -> float:
    """Share of an item's shingles that occur in the window."""
    if not wanted:
        return 0.0
    k = len(next(iter(wanted))) // 4
    have = shingles(window, k) if len(window) >= k else set()
    return len(wanted & have) / len(wanted)
