"""MinHash near-dedup: chosen-path set similarity join over word shingles.

Every distinct shingle set gets a minwise signature. A tree starts with all sets in one node; a
node sends each of its sets to one child per chosen signature position, named by the token
the set has there. The choice depends on the node alone, so sets that agree go on together.
Children with one set are finished, small nodes are compared exhaustively, and larger
ones branch again. With two positions a node, a pair at the threshold is lost by one tree with
probability ``q`` = (1 - s + s q)^2, at any depth; independent trees are repeated until
the recall of every single link is the wanted one.

A node that hardly shrinks holds sets that are nearly all alike. There every set is first
compared with one leader, and confirmed links contract to classes. What is then left are pairs
from different classes; they are compared in blocks, without a cap. The same two steps serve
small nodes (each set with its best partner, then pairs across classes), so a large group of near
copies costs about one confirmed link per set and not all pairs.

Signatures only propose: a pair goes on when its agreement is above five standard deviations
under the threshold, and every link is confirmed on the full sets, in the JVM.

No group is gathered whole: nodes and groups are counted with map-side sums, lists
hold at most ``LEAF`` sets or two blocks, and no links or classes reach the driver. Only signatures are
kept of all sets; full sets are made anew from the texts that occur in a proposed pair.

Edge cases: a null or blank text has the empty set, links with nothing and is its own
component. One or two words form one shingle. Equal sets, whatever their order of words,
are copies. Ids are compared as longs; a null id is the largest, and a component of null ids has
a null component_id. Rows that repeat an id each keep their own set. Empty tables give no
rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import blank_words, cut, list_parts, lower_ascii, written
from tidemark.llm.components import components

PERCENT = 85  # least similarity, in percent of the union
SHINGLE = 3
POSITIONS = 64  # signature length
CHOSEN = 2  # positions a node chooses
RECALL = 1 - 1e-8  # of any single link, as far as the branching decides
LEAF = 48  # sets in a node that are compared exhaustively
STUCK = 0.7  # a child with more of its parent's sets than this doesn't branch again
LEVELS = 6
BLOCK = 2_048
BLOCK_SHINGLES = 1 << 19


def tree_count(similarity: float, recall: float) -> int:
    """Independent trees that miss a pair of this similarity with at most 1 - recall."""
    s, q = similarity, 0.0
    for _ in range(200):
        q = (1 - s + s * q) ** CHOSEN
    return max(1, ceil(log(1 - recall) / log(q)))


def least_agreement(similarity: float) -> int:
    """Signature positions that a pair has to share to be proposed."""
    sd = sqrt(similarity * (1 - similarity) / POSITIONS)
    return int(POSITIONS * max(0.0, similarity - 5 * sd))


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9FB21C651E98DF25)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of one text's word hashes."""
    size = min(size, len(words))
    if not size:
        return words[:0]
    n = len(words) - size + 1
    total = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        total = mixed(total) + words[k:k + n]
    return np.unique(mixed(total))


def signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Minwise tokens (32 bits each) of a set, one per factor."""
    out = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for lo in range(0, len(shingles), 20_000):
        out = np.minimum(out, (factors[:, None] * shingles[None, lo:lo + 20_000]).min(axis=1))
    return (out >> np.uint64(32)).astype(np.uint32)


def row_keys(id_col: str, text_col: str) -> list[Column]:
    """(kid, kth): two 64-bit hashes of id and text that name a row's content."""
    of = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    return [F.xxhash64(*of).alias("kid"), F.xxhash64(*reversed(of), F.lit(1)).alias("kth")]


def word_column(text_col: str) -> Column:
    return F.transform(blank_words(lower_ascii(F.col(text_col).cast("string"))),
                       lambda w: F.xxhash64(w))


def batch_sets(column: pa.Array, shingle: int) -> list[np.ndarray]:
    offsets, values = list_parts(column)
    hashes = values.to_numpy(zero_copy_only=False).view(np.uint64)
    return [word_shingles(hashes[a:b], shingle) for a, b in zip(offsets[:-1], offsets[1:])]


def signatures(docs: DataFrame, *, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """Written rows (id, kid, kth, n, k1, k2, sig, bits) of whole documents.

    (k1, k2) names the set, ``sig`` is its signature and ``bits`` a byte of each position.
    """
    factors = np.random.default_rng(13).integers(
        0, 1 << 63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = batch_sets(batch.column(3), shingle)
            n = np.array([len(s) for s in sets], dtype=np.int64)
            keys = np.array([(mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64),
                              mixed(s + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64))
                             for s in sets], dtype=np.uint64).reshape(-1, 2)
            sigs = np.array([signature(s, factors) for s in sets],
                            dtype=np.uint32).reshape(-1, POSITIONS)
            ends = pa.array(np.arange(0, sigs.size + 1, POSITIONS, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(n), pa.array(keys[:, 0].copy().view(np.int64)),
                 pa.array(keys[:, 1].copy().view(np.int64)),
                 pa.ListArray.from_arrays(ends, pa.array(sigs.ravel().view(np.int32))),
                 pa.array([s.astype(np.uint8).tobytes() for s in sigs], pa.binary())],
                names=["id", "kid", "kth", "n", "k1", "k2", "sig", "bits"])

    return written(docs.select(
        F.col(id_col).cast("long").alias("id"), *row_keys(id_col, text_col),
        word_column(text_col).alias("w")).mapInArrow(
        build, "id long, kid long, kth long, n long, k1 long, k2 long, sig array<int>, bits binary"),
        "signatures")


def full_sets(docs: DataFrame, wanted: DataFrame, *, id_col: str, text_col: str,
              shingle: int) -> DataFrame:
    """(sid, shingles) of the rows (kid, kth, sid) in ``wanted``, made anew from their texts."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = batch_sets(batch.column(1), shingle)
            flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
            edges = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(edges),
                                                           pa.array(flat.view(np.int64)))],
                names=["sid", "shingles"])

    texts = docs.select(*row_keys(id_col, text_col), F.col(text_col).cast("string").alias("t"))
    return texts.join(wanted, ["kid", "kth"]).dropDuplicates(["sid"]) \
        .select("sid", word_column("t").alias("w")) \
        .mapInArrow(build, "sid long, shingles array<long>")


# -- pairs inside groups -------------------------------------------------------

def group_pairs(sizes: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Flat member positions (a, b) of all pairs inside groups, in bounded chunks."""
    for size in np.unique(sizes):
        i, j = np.triu_indices(int(size), 1)
        each = max(1, 200_000 // max(1, len(i)))
        at = starts[sizes == size]
        for lo in range(0, len(at), each):
            base = at[lo:lo + each, None]
            a, b = (base + i).ravel(), (base + j).ravel()
            for k in range(0, len(a), 200_000):
                yield a[k:k + 200_000], b[k:k + 200_000]


def bytes_matrix(column: pa.Array) -> np.ndarray:
    """Rows of a binary column of equal lengths."""
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, dtype=np.uint8).reshape(len(column), -1)


def struct_columns(x: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    sid, n, root = (x.field(k).to_numpy(zero_copy_only=False) for k in range(3))
    return sid, n, root, bytes_matrix(x.field(3))


def candidates(sizes, starts, n, root, bits, least: int, percent: int):
    """Chunks (a, b, agreement) of pairs of a group with different roots, sizes that allow a link,
    and at least ``least`` agreeing positions."""
    for a, b in group_pairs(sizes, starts):
        able = (root[a] != root[b]) & (
            100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b]))
        a, b = a[able], b[able]
        same = (bits[a] == bits[b]).sum(axis=1)
        ok = same >= least
        if ok.any():
            yield a[ok], b[ok], same[ok]


def best_of_each(who, other, same):
    """Of every ``who`` the pair with the largest agreement, ties to the smaller partner."""
    order = np.lexsort((other, -same, who))
    who, other, same = who[order], other[order], same[order]
    first = np.concatenate([[True], who[1:] != who[:-1]])[:len(who)]
    return who[first], other[first], same[first]


def joining(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Positions of the pairs (x, y) that join two trees, taken in order: a spanning forest."""
    lo, hi = np.minimum(x, y), np.maximum(x, y)
    order = np.lexsort((hi, lo))
    new = np.concatenate([[True], (lo[order][1:] != lo[order][:-1])
                          | (hi[order][1:] != hi[order][:-1])])[:len(x)]
    at = np.sort(order[new])
    parent: dict[int, int] = {}

    def find(v: int) -> int:
        while (up := parent.get(v, v)) != v:
            parent[v] = parent.get(up, up)
            v = up
        return v

    kept = []
    for k, u, v in zip(at.tolist(), lo[at].tolist(), hi[at].tolist()):
        u, v = find(u), find(v)
        if u != v:
            parent[v] = u
            kept.append(k)
    return np.array(kept, dtype=np.int64)


def edge_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


NONE = np.zeros(0, dtype=np.int64)


def best_pairs(groups: DataFrame, least: int, percent: int) -> DataFrame:
    """(a, b): of each member of a group ``x`` the candidate partner that agrees most."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, x = list_parts(batch.column(0))
            sid, n, root, bits = struct_columns(x)
            found = [(NONE, NONE, NONE)]
            for a, b, same in candidates(np.diff(offsets), offsets[:-1], n, root, bits, least,
                                         percent):
                found.append(best_of_each(np.concatenate([a, b]), np.concatenate([b, a]),
                                          np.concatenate([same, same])))
            who, other, _ = best_of_each(*map(np.concatenate, zip(*found)))
            yield edge_batch(sid[who], sid[other])

    return groups.mapInArrow(scan, "a long, b long").distinct()


def touching_roots(groups: DataFrame, least: int, percent: int) -> DataFrame:
    """(a, b): pairs of roots that connect the same roots as all candidates of the groups."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, x = list_parts(batch.column(0))
            _, n, root, bits = struct_columns(x)
            xs, ys = NONE, NONE
            for a, b, _ in candidates(np.diff(offsets), offsets[:-1], n, root, bits, least, percent):
                xs, ys = np.concatenate([xs, root[a]]), np.concatenate([ys, root[b]])
                on = joining(xs, ys)
                xs, ys = xs[on], ys[on]
            yield edge_batch(xs, ys)

    return groups.mapInArrow(scan, "a long, b long").distinct()


class Overlaps:
    """Intersection sizes of pairs of sets, on bit rows of the shingles that several sets share."""

    def __init__(self, sets: list[np.ndarray]):
        flat = np.concatenate([*sets, NONE])
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        _, back, count = np.unique(flat, return_inverse=True, return_counts=True)
        shared = count > 1
        on = shared[back]
        owner, at = owner[on], (np.cumsum(shared) - 1)[back[on]]
        parts = [np.zeros((len(sets), 0), dtype=np.uint8)]
        for lo in range(0, int(shared.sum()), 4096):
            here = (at >= lo) & (at < lo + 4096)
            dense = np.zeros((len(sets), 4096), dtype=bool)
            dense[owner[here], at[here] - lo] = True
            parts.append(np.packbits(dense, axis=1))
        self.rows = np.concatenate(parts, axis=1)

    def count(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), dtype=np.int64)
        each = max(64, (8 << 20) // max(1, self.rows.shape[1]))
        for k in range(0, len(a), each):
            both = self.rows[a[k:k + each]] & self.rows[b[k:k + each]]
            out[k:k + each] = np.bitwise_count(both).sum(axis=1, dtype=np.int64)
        return out


def cell_links(cells: DataFrame, least: int, percent: int) -> DataFrame:
    """(a, b): confirmed links between members of a cell ``x`` with different roots, as many as
    connect these roots. Members carry their full set."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, x = list_parts(batch.column(0))
            sid, n, root, bits = struct_columns(x)
            ends, flat = list_parts(x.field(4))
            flat = flat.to_numpy(zero_copy_only=False)
            for lo, hi in zip(offsets[:-1], offsets[1:]):
                sets = [flat[ends[k]:ends[k + 1]] for k in range(lo, hi)]
                xs, ys, shared = NONE, NONE, Overlaps(sets)
                for a, b, _ in candidates(np.array([hi - lo]), np.array([lo]), n, root, bits, least,
                                          percent):
                    both = shared.count(a - lo, b - lo)
                    ok = both * 100 >= (n[a] + n[b] - both) * percent
                    xs, ys = np.concatenate([xs, a[ok]]), np.concatenate([ys, b[ok]])
                    on = joining(root[xs], root[ys])
                    xs, ys = xs[on], ys[on]
                yield edge_batch(sid[xs], sid[ys])

    return cells.mapInArrow(scan, "a long, b long").distinct()


def led(rows: DataFrame, least: int) -> DataFrame:
    """(a, b) of rows (sid, bits, lead, lead_bits) that agree in enough positions."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            same = (bytes_matrix(batch.column(1)) == bytes_matrix(batch.column(3))).sum(axis=1)
            at = np.flatnonzero(same >= least)
            yield edge_batch(batch.column(0).to_numpy()[at], batch.column(2).to_numpy()[at])

    return rows.mapInArrow(scan, "a long, b long").distinct()


# -- trees ----------------------------------------------------------------------

def chosen(node: Column, k: int) -> Column:
    """The k-th of the two different positions that a node chooses."""
    first = F.pmod(F.xxhash64(node, F.lit(1)), F.lit(POSITIONS))
    if k == 0:
        return first
    step = F.pmod(F.xxhash64(node, F.lit(2)), F.lit(POSITIONS - 1)) + 1
    return F.pmod(first + step, F.lit(POSITIONS))


def children(rows: DataFrame) -> DataFrame:
    """(node, sid, parent, held): one row per set and chosen position of its node."""
    named = [F.xxhash64("node", F.lit(k), F.get("sig", chosen(F.col("node"), k).cast("int")))
             for k in range(CHOSEN)]
    return rows.select(F.explode(F.array(*named)).alias("child"), "sid", "held") \
        .withColumnRenamed("child", "node")


def sized(rows: DataFrame) -> DataFrame:
    """Rows of nodes with two sets or more, with the node's size."""
    counts = cut(rows.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    return cut(rows.join(counts, "node"))


def branch(sets: DataFrame, trees: int, leaf: int) -> tuple[DataFrame, DataFrame]:
    """((node, sid) of small nodes, (node, sid, size) of large ones that don't shrink)."""
    roots = F.array(*[F.lit(t).cast("long") for t in range(trees)])
    total = sets.count()
    rows = sets.select("sid", "sig", F.explode(roots).alias("node"), F.lit(total).alias("held"))
    small, large = [], []
    for level in range(LEVELS):
        live = sized(children(rows))
        small.append(live.where(F.col("size") <= leaf).select("node", "sid"))
        big = live.where(F.col("size") > leaf)
        stuck = F.col("size") > STUCK * F.col("held")
        if level == LEVELS - 1:
            stuck = F.lit(True)
        large.append(big.where(stuck).select("node", "sid", "size"))
        onward = big.where(~stuck)
        if onward.isEmpty():
            break
        rows = onward.select("node", "sid", F.col("size").alias("held")) \
            .join(sets.select("sid", "sig"), "sid")

    def union(parts):
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    return union(small), union(large)


def confirmed(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    # The second join, whose rows carry a set each, is split where one key, a leader, has many.
    left = full.select(F.col("sid").alias("a"), F.col("shingles").alias("sa"))
    right = full.select(F.col("sid").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return cut(pairs.join(right, "b").join(left, "a").where(
        both * 100 >= (F.size("sa") + F.size("sb") - both) * percent).select("a", "b"))


def cells(members: DataFrame, block: int, payload: list[str]) -> DataFrame:
    """Lists of members of nodes that hold sets of several classes, at most two blocks
    each, so that every pair from different classes meets in one of them. A block has about
    ``block`` sets and ``BLOCK_SHINGLES`` shingles at most, or one set.

    Members of a node's largest class needn't meet each other, so they only meet the blocks of
    the others.
    """
    members = cut(members)
    by_class = members.groupBy("node", "root").agg(F.count(F.lit(1)).alias("m"),
                                                   F.sum("n").alias("s"))
    heads = cut(by_class.groupBy("node").agg(
        F.max_by("root", F.struct("m", "root")).alias("major"),
        (F.sum("m") - F.max("m")).alias("others"), F.max("m").alias("most"),
        F.max_by("s", F.struct("m", "root")).alias("inside_s"), F.sum("s").alias("all_s"))
        .where("others > 0"))
    spread = F.xxhash64("sid")
    blocks_of = F.greatest(F.ceil(F.col("others") / block), F.ceil(
        (F.col("all_s") - F.col("inside_s")) / BLOCK_SHINGLES)).cast("int")
    majors_of = F.greatest(F.ceil(F.col("most") / block),
                           F.ceil(F.col("inside_s") / BLOCK_SHINGLES)).cast("int")
    inside = F.col("root") == F.col("major")
    rows = members.join(heads, "node").select(
        "node", *payload, inside.alias("inside"), blocks_of.alias("nb"),
        majors_of.alias("nm"),
        F.when(inside, F.pmod(spread, majors_of)).otherwise(F.pmod(spread, blocks_of))
        .cast("int").alias("own"))
    upto = F.sequence(F.lit(0), F.col("nb") - 1)
    beside = F.transform(upto, lambda i: F.struct(
        F.least(i, F.col("own")).alias("i"), F.greatest(i, F.col("own")).alias("j")))
    across = F.transform(F.sequence(F.lit(0), F.col("nm") - 1), lambda j: F.struct(
        F.col("own").alias("i"), (-j - 1).alias("j")))
    from_major = F.transform(upto, lambda i: F.struct(i.alias("i"), (-F.col("own") - 1).alias("j")))
    cell = F.when(F.col("inside"), from_major).otherwise(F.concat(beside, across))
    return rows.withColumn("cell", F.explode(cell)).groupBy("node", "cell").agg(
        F.collect_list(F.struct(*payload)).alias("x")).select("x")


def linked_sets(sets: DataFrame, fetch, *, percent: int, recall: float, leaf: int = LEAF,
                block: int = BLOCK) -> DataFrame:
    """(a, b): confirmed links that connect all sets of each component.

    ``fetch`` returns (sid, shingles) for a table of sids.
    """
    least = least_agreement(percent / 100)
    small, large = branch(sets, tree_count(percent / 100, recall), leaf)
    member = ["sid", "n", "root", "bits"]

    def leaves(rooted: DataFrame) -> DataFrame:
        return small.join(rooted, "sid").groupBy("node").agg(
            F.collect_list(F.struct(*member)).alias("x")).select("x")

    alone = sets.select("sid", "n", "bits", F.col("sid").alias("root"))
    first = best_pairs(leaves(alone), least, percent)
    # One leader, the member with the smallest hash, so that trees agree on it.
    leads = large.groupBy("node").agg(
        F.min(F.struct(F.xxhash64("sid"), "sid")).alias("l")).select(
        "node", F.col("l.sid").alias("lead"))
    star = large.join(leads, "node").select("sid", "lead").where("sid != lead").distinct()
    star = star.join(sets.select("sid", "bits"), "sid").join(
        sets.select(F.col("sid").alias("lead"), F.col("bits").alias("lead_bits")), "lead") \
        .select("sid", "bits", "lead", "lead_bits")
    tried = cut(first.unionByName(led(star, least)).distinct())
    # A set in any candidate pair of a small node has a best partner there, so these are all
    # the sets that are ever compared in full; texts are read for them once.
    ends = tried.select(F.explode(F.array("a", "b")).alias("sid")).unionByName(large.select("sid"))
    full = cut(fetch(ends.distinct()))
    links = confirmed(tried, full, percent)

    # Links that are left join different classes. Classes with candidates between them are brought
    # together, and their sets are compared in cells.
    roots = components(links)
    rooted = cut(sets.select("sid", "n", "bits").join(
        roots.withColumnRenamed("node", "sid"), "sid", "left")
        .withColumn("root", F.coalesce("root", "sid")))
    # Trees meet the same group in many nodes; nodes with one leader are compared as one.
    led_by = large.join(leads, "node").select(F.col("lead").alias("node"), "sid").distinct()
    big = cells(led_by.join(rooted, "sid").select("node", *member), block, member)
    near = touching_roots(leaves(rooted).unionByName(big), least, percent)
    groups = components(near).select(F.col("node").alias("root"), F.col("root").alias("node"))
    members = rooted.join(groups, "root").join(full, "sid").select("node", *member, "shingles")
    more = cut(cell_links(cells(members, block, [*member, "shingles"]), least, percent))
    return links.unionByName(more)


def near_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                percent: int = PERCENT, shingle: int = SHINGLE, recall: float = RECALL,
                leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id reachable), kept."""
    names = {"id_col": id_col, "text_col": text_col, "shingle": shingle}
    stored = signatures(docs, **names)
    classes = stored.where("n > 0").groupBy("k1", "k2").agg(
        F.min(F.struct("kid", "kth")).alias("row"), F.min("id").alias("least"),
        F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("sig").alias("sig"),
        F.first("bits").alias("bits"))
    classes = cut(classes.withColumn("sid", F.monotonically_increasing_id()))
    rows = classes.select("sid", "row.kid", "row.kth")

    def fetch(sids: DataFrame) -> DataFrame:
        return full_sets(docs, rows.join(sids, "sid"), **names)

    links = linked_sets(classes.select("sid", "n", "sig", "bits"), fetch, percent=percent,
                        recall=recall, leaf=leaf, block=block)
    roots = components(links).withColumnRenamed("node", "sid")
    # Only sets with copies or links need a lookup; any other document is alone.
    named = cut(classes.select("sid", "k1", "k2", "least", "copies").join(roots, "sid", "left")
                .where("copies > 1 or root is not null")
                .withColumn("root", F.coalesce("root", "sid")))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = cut(named.join(least, "root").select("k1", "k2", "component_id", F.lit(1).alias("on")))
    out = stored.select("id", "n", "k1", "k2").join(named, ["k1", "k2"], "left")
    component = F.when(F.col("on").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))
