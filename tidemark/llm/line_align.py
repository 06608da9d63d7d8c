"""Line dedup by pairwise alignment.

A run of consecutive lines (``LEAST_CHARS`` characters or more) goes from every document
but the first that holds it. Two ways find the runs, and together they find all:

Documents that share a rare line, held by at most ``RARE`` documents, are paired, each
holder with every earlier one. The shared lines of a pair are aligned by patience diff and
aligned blocks go from the later document; then what the alignment left of the pair's common
blocks (repeats and crossings) goes too. A run that holds a rare line is met in such a pair.

Runs of frequent lines only need no pairs, which would grow with the square of the holders.
They are covered by their shortest windows of ``LEAST_CHARS`` characters from each line on
and up to each line, and a window goes from every document but the first that holds it.

Earlier means the smaller (id, hash of the text), null ids last. Both ways look at the
input texts, so a block may go because of a document that itself loses it to a third one;
the first holder always keeps it.

Edge cases: lines are compared without blanks at their ends; blank lines are never
matched, do not break a block and are never deleted. Null and empty texts are returned as
they are. Rows that repeat both id and text are one document and get the same result. A
text may end up empty; its row stays. Empty tables give no rows. Columns of ``docs`` are
kept, whatever their names; only the text (and ``n_chars``, where present) changes.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut

RARE = 8
LEAST_CHARS = 20
BLANK = " \t\r\x0b\x0c"
LAST_ID = (1 << 63) - 1


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Matched index pairs of two sequences by patience diff."""
    matched = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            matched.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            matched.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = {}, {}
        for i in range(a0, a1):
            in_a[a[i]] = -1 if a[i] in in_a else i
        for j in range(b0, b1):
            in_b[b[j]] = -1 if b[j] in in_b else j
        unique = [(i, in_b[x]) for x, i in in_a.items() if i >= 0 and in_b.get(x, -1) >= 0]
        # Longest increasing run of the partner positions, found on piles.
        tops, piles, back = [], [], [-1] * len(unique)
        for n, (_, j) in enumerate(unique):
            k = bisect_left(tops, j)
            back[n] = piles[k - 1] if k else -1
            tops[k:k + 1], piles[k:k + 1] = [j], [n]
        if not piles:
            continue
        n, anchors = piles[-1], []
        while n >= 0:
            anchors.append(unique[n])
            n = back[n]
        anchors.reverse()
        edges = [(a0, b0), *((i + 1, j + 1) for i, j in anchors)]
        for (i0, j0), (i1, j1) in zip(edges, [*anchors, (a1, b1)]):
            if i0 < i1 and j0 < j1:
                todo.append((i0, i1, j0, j1))
        matched += anchors
    return sorted(matched)


def windows(at, common, chars, least: int) -> list[tuple[int, int]]:
    """(first, past last) of the shortest windows of ``least`` characters that start or end at
    each line, within runs of consecutive common lines."""
    out = set()
    n, begin = len(at), 0
    while begin < n:
        end = begin + 1
        if not common[begin]:
            begin = end
            continue
        while end < n and common[end] and at[end] == at[end - 1] + 1:
            end += 1
        first, size = begin, 0
        for j in range(begin, end):  # the shortest window that ends at j
            size += chars[j]
            while size - chars[first] >= least:
                size -= chars[first]
                first += 1
            if size >= least:
                out.add((first, j + 1))
        last, size = end, 0
        for i in range(end - 1, begin - 1, -1):  # the shortest window that starts at i
            size += chars[i]
            while size - chars[last - 1] >= least:
                last -= 1
                size -= chars[last]
            if size >= least:
                out.add((i, last))
        begin = end
    return sorted(out)


def common_blocks(a_at, a_line, b_at, b_line, b_chars, least: int) -> list[int]:
    """Indexes into b of the lines in common blocks of ``least`` characters: first the aligned
    ones, then those that alignment leaves (repeats and crossings)."""
    out, block, size, last = [], [], 0, (-2, -2)
    for i, j in [*patience(a_line, b_line), (-1, -1)]:
        here = (a_at[i] - 1, b_at[j] - 1) if i >= 0 else None
        if here != last:
            if size >= least:
                out += block
            block, size = [], 0
        if i >= 0:
            block.append(j)
            size += b_chars[j]
            last = (a_at[i], b_at[j])
    in_a = set(a_line)
    common = [x in in_a for x in b_line]
    if sum(common) == len(out):
        return out
    gone, places = set(out), {}
    for i, x in enumerate(a_line):
        places.setdefault(x, []).append(i)
    for first, end in windows(b_at, common, b_chars, least):
        n = end - first
        if not gone.issuperset(range(first, end)) and any(
                a_line[i:i + n] == b_line[first:end] and a_at[i + n - 1] - a_at[i] == n - 1
                for i in places[b_line[first]]):
            gone.update(range(first, end))
    return sorted(gone)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column]:
    return (F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("kid"),
            F.xxhash64(F.col(text_col)).alias("kth"))


def deletions(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
              rare: int = RARE, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(kid, kth, gone): the sorted positions of the deleted lines, for documents that lose any."""
    parts = F.transform(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1),
                        lambda x, i: F.struct(i.alias("pos"),
                                              F.btrim(x, F.lit(BLANK)).alias("s")))
    filled = docs.select(*keyed(docs, id_col, text_col),
                         F.posexplode(F.filter(parts, lambda x: x["s"] != "")).alias("at", "x"))
    lines = filled.select(
        "kid", "kth", "at", F.col("x.pos").alias("pos"), F.length("x.s").alias("chars"),
        F.xxhash64("x.s").alias("h1"), F.hash("x.s").alias("h2"))
    lines = cut(lines.dropDuplicates(["kid", "kth", "at"]))

    held = lines.select("h1", "h2", "kid", "kth").distinct()
    key = F.struct("kid", "kth")
    common = cut(held.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    held = cut(lines.select("h1", "h2", "kid", "kth").distinct()
               .join(common.where(F.col("n") <= rare), ["h1", "h2"]))
    few = held.groupBy("h1", "h2") \
        .agg(F.sort_array(F.collect_list(key)).alias("ks"))  # at most ``rare`` each
    pairs = few.select(F.explode(F.flatten(F.transform(
        "ks", lambda b, j: F.transform(F.slice("ks", 1, j),
                                       lambda a: F.struct(a.alias("a"), b.alias("b")))))).alias("p")) \
        .select("p.a", "p.b").where("a != b")
    pairs = cut(pairs.distinct())

    shared = lines.join(common.select("h1", "h2", (F.col("n") > rare).alias("often")), ["h1", "h2"])
    # Lines that no other document holds can't be aligned; only the others travel.
    rows = cut(shared.groupBy("kid", "kth").agg(F.sort_array(F.collect_list(F.struct(
        "at", "pos", "chars", "h1", "h2", "often"))).alias("l")).select(
            key.alias("k"), F.col("l.at").alias("at"), F.col("l.pos").alias("pos"),
            F.col("l.chars").alias("chars"), F.col("l.h1").alias("h"), F.col("l.h2").alias("h2"),
            F.col("l.often").alias("often")))
    left = rows.select(F.col("k").alias("a"), F.col("at").alias("a_at"), F.col("h").alias("a_h"))
    right = rows.select(F.col("k").alias("b"), F.col("at").alias("b_at"), F.col("h").alias("b_h"),
                        "pos", "chars")
    met = pairs.join(left, "a").join(right, "b").select(
        F.col("b.kid").alias("kid"), F.col("b.kth").alias("kth"), "a_at", "a_h", "b_at", "b_h",
        "chars", "pos")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, gone = [], []
            for r, (a_at, a_h, b_at, b_h, chars, pos) in enumerate(
                    zip(*(batch.column(k).to_pylist() for k in range(2, 8)))):
                lost = common_blocks(a_at, a_h, b_at, b_h, chars, least_chars)
                owner += [r] * len(lost)
                gone += [pos[j] for j in lost]
            at = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(gone, pa.int32())],
                names=["kid", "kth", "pos"])

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, lines, spans = [], [], []
            for r, (at, pos, chars, h, h2, often) in enumerate(
                    zip(*(batch.column(k).to_pylist() for k in range(2, 8)))):
                for i, j in windows(at, often, chars, least_chars):
                    owner.append(r)
                    lines.append(h[i:j] + h2[i:j])
                    spans.append(pos[i:j])
            own = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(own), batch.column(1).take(own),
                 pa.array(lines, pa.list_(pa.int64())), pa.array(spans, pa.list_(pa.int32()))],
                names=["kid", "kth", "lines", "span"])

    covers = cut(rows.where(F.exists("often", lambda x: x)).select(
        "k.kid", "k.kth", "at", "pos", "chars", "h", "h2", "often")
        .mapInArrow(cover, "kid long, kth long, lines array<long>, span array<int>")
        .select("kid", "kth", "span", F.xxhash64("lines").alias("w1"), F.hash("lines").alias("w2")))
    firsts = cut(covers.groupBy("w1", "w2").agg(F.min(key).alias("first"), F.max(key).alias("last"))
                 .where("first != last").drop("last"))
    later = covers.join(firsts, ["w1", "w2"]).where(key != F.col("first")) \
        .select("kid", "kth", F.explode("span").alias("pos"))

    return met.mapInArrow(align, "kid long, kth long, pos int").unionByName(later).distinct() \
        .groupBy("kid", "kth").agg(F.sort_array(F.collect_list("pos")).alias("gone"))


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                rare: int = RARE, least_chars: int = LEAST_CHARS,
                gone_col: str | None = None) -> DataFrame:
    """``docs`` with aligned common blocks deleted from the later documents.

    ``gone_col`` adds the positions (from 0) of the deleted lines, null where none is.
    """
    gone = cut(deletions(docs, id_col=id_col, text_col=text_col, rare=rare,
                         least_chars=least_chars))
    gone = gone.select(F.col("kid").alias("__kid"), F.col("kth").alias("__kth"),
                       F.col("gone").alias("__gone"))
    kid, kth = keyed(docs, id_col, text_col)
    joined = docs.join(gone, (kid == F.col("__kid")) & (kth == F.col("__kth")), "left")
    kept = F.array_join(F.filter(F.split(F.col(text_col), "\n", -1),
                                 lambda x, i: ~F.array_contains(F.col("__gone"), i)), "\n")
    text = F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(kept)
    out = []
    for c in docs.columns:
        if c == text_col:
            out.append(text.alias(c))
        elif c == "n_chars":
            out.append(F.when(F.col("__gone").isNull(), F.col(c))
                       .otherwise(F.length(text).cast(docs.schema[c].dataType)).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    if gone_col:
        out.append(F.col("__gone").alias(gone_col))
    return joined.select(*out)
