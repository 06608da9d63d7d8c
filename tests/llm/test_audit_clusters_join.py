"""Filter audit, centroid clustering and the chosen-path join against slow versions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from fixtures import WORDS, documents
from pyspark.sql import functions as F

from tidemark.llm import centroid_threshold, chosen_path, filter_audit

BLANK = r"[\x20\x09-\x0D]+"
LABELS = "doc_id long, quality int, toxic int"


def words_of(text):
    return [w for w in re.split(BLANK, text or "") if w]


# -- filter audit ---------------------------------------------------------------

def slow_audit(rows, labels):
    good, toxic = Counter(), Counter()
    for i, q, t in labels:
        if i is not None:
            good[i] |= int(q == 1)
            toxic[i] |= int(t == 1)
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    fails = defaultdict(list)
    for i, t, _, source, _ in rows:
        text, w = t or "", words_of(t)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
             "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
             "D": any(c in "#$%&*|" for c in text),
             "E": i is not None and i > least[text]}
        fails[source or ""].append(({k for k, v in f.items() if v}, good[i], toxic[i]))
    out = []
    for part, docs in fails.items():
        total = Counter()
        lines = []
        for order in permutations("ABCDE"):
            left = docs
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[0]]
                left = [d for d in left if x not in d[0]]
                total[x] += len(gone)
                lines.append(["".join(order), step, len(left), len(gone),
                              sum(x in d[0] for d in docs) - len(gone),
                              sum(d[0] == {x} for d in docs),
                              sum(d[1] for d in gone), sum(d[2] for d in gone), x])
        out += [(part, *line[:-1], total[line[-1]]) for line in lines]
    return Counter(out)


def test_intervals_cover_every_order_once():
    intervals = filter_audit.removal_intervals(5)
    assert len(intervals) == 840
    ranks = [filter_audit.lehmer_rank(p, 5) for p in permutations(range(5))]
    assert ranks == list(range(120))
    for mask in range(1, 32):
        hit = Counter(r for m, _, lo, hi in intervals if m == mask for r in range(lo, hi))
        assert hit == Counter(range(120))


def test_audit_is_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for k in range(60):
        text = " ".join(rng.choice(["a", "b", f"w{rng.randrange(400)}", "X", "#", "é"])
                        for _ in range(rng.choice([0, 3, 199, 200, 260])))
        rows.append((k, text, "en", rng.choice(["s1", "s2", "", None]), 0))
    rows += [(60 + k, rows[k][1], "en", "s1", 0) for k in range(12)]
    rows += [rows[3], rows[3], (None, rows[4][1], "en", "s2", 0), (None, None, None, None, None),
             (90, None, None, None, None), (91, "", None, "s9", None), (92, "Long " * 50_000, "en", "s9", 0)]
    labels = [(k, k % 2, k % 3 == 0) for k in range(0, 70, 2)]
    labels = [(i, q, int(t)) for i, q, t in labels] + [(2, 1, 1), (None, 1, 1), (5, None, 1)]
    got = filter_audit.audit_documents(documents(spark, rows), spark.createDataFrame(labels, LABELS))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant",
                           "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert Counter(map(tuple, got.collect())) == slow_audit(rows, labels)


def test_audit_of_empty_tables(spark):
    none = documents(spark, []), spark.createDataFrame([], LABELS)
    assert filter_audit.audit_documents(*none).count() == 0


# -- centroid clustering ----------------------------------------------------------

@pytest.mark.parametrize("spread", [2, 50, 1 << 27])
def test_threshold_walk_is_exhaustive_search(spread):
    rng = np.random.default_rng(spread)
    for k, dims in ((1, 3), (2, 1), (5, 4), (40, 6), (8, 64)):
        c = rng.integers(-spread, spread + 1, (k, dims))
        x = np.concatenate([rng.integers(-spread, spread + 1, (200, dims)), c, c])
        d = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        number, best = centroid_threshold.threshold_nearest(x, c)
        assert (best == d.min(axis=1)).all() and (number == d.argmin(axis=1)).all()
    number, best = centroid_threshold.threshold_nearest(x[:0], c)
    assert len(number) == len(best) == 0


def slow_clusters(rows, dims, k, rounds, seed):
    kept = [(i, [math.floor(1024 * c) for c in v]) for i, v in rows
            if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    named = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), v)
                   for i, v in kept)
    centroids = [v for _, v in named[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[near(v)[1]].append(v)
        for n, vs in groups.items():
            centroids[n] = [sum(col) // len(vs) for col in zip(*vs)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    sums = Counter()
    for _, n, d in found:
        sums[n] += d
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, n, d, sums[n], sum(sums.values()), digests[n]) for i, n, d in found)


@pytest.mark.parametrize("n", [0, 3, 120])
def test_clusters_are_plain_k_means(spark, n):
    rng = random.Random(n)
    rows = [(k, [rng.choice([rng.uniform(-2, 2), 0.5, -1.0]) for _ in range(3)]) for k in range(n)]
    rows += rows[:n // 3]  # a hot group of equal rows
    rows += [(1, [0.25, 0.5, 0.75])] * (n // 2) + [(None, [0.1, 0.2, 0.3]), (None, [9.0, 0.2, 0.3])] * (n > 3)
    rows += [(900, None), (901, []), (902, [1.0, 2.0]), (903, [1.0, None, 2.0]),
             (904, [float("nan"), 0.0, 0.0]), (905, [float("inf"), 0.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows],
                               "vec_id long, embedding array<double>, id int, distance int")
    got = centroid_threshold.clustered(df, dimensions=3, k=4, rounds=5)
    want = slow_clusters(rows, 3, 4, 5, centroid_threshold.SEED)
    assert Counter(map(tuple, got.collect())) == want


def test_components_too_large_are_refused(spark):
    df = spark.createDataFrame([(1, [2e5, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        centroid_threshold.clustered(df, dimensions=2).collect()


# -- chosen-path join ---------------------------------------------------------------

def slow_components(rows, percent=85, size=3):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text, *_ in rows:
        w = words_of((text or "").translate(table))
        n = min(size, len(w))
        sets.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if n else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both * 100 >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    last = 1 << 62
    least = defaultdict(lambda: last)
    for k, (i, *_) in enumerate(rows):
        least[find(k)] = min(least[find(k)], last if i is None else i)
    out = []
    for k, (i, *_) in enumerate(rows):
        c = least[find(k)]
        c = None if c == last else c
        out.append((i, len(sets[k]), c, i == c))
    return Counter(out)


def near_copies(seed, count, words, changes):
    """Variants of one text with up to ``changes`` replaced words each."""
    rng = random.Random(seed)
    base = [f"{rng.choice(WORDS)}{rng.randrange(50)}" for _ in range(words)]
    for k in range(count):
        w = list(base)
        for _ in range(rng.randrange(changes + 1)):
            w[rng.randrange(words)] = f"new{seed}x{k}y{rng.randrange(1000)}"
        yield " ".join(w)


def join_rows():
    texts = list(near_copies(1, 90, 120, 4)) + list(near_copies(2, 40, 60, 3))
    texts += list(near_copies(3, 40, 200, 12)) + list(near_copies(4, 8, 30, 1))
    # A shared passage makes texts half alike: candidates that are no links.
    passage = next(near_copies(5, 1, 80, 0))
    texts += [passage + " " + next(near_copies(100 + k, 1, 40, 0)) for k in range(60)]
    texts += ["One", "one", "one two", "two one", "ONE\ttwo", "a b c", "c b a", None, "", " \n"]
    texts += [texts[0]] * 30 + ["word " * 5000, "word word word"]
    texts.append(next(near_copies(6, 1, 30_000, 0)))
    rows = [(k * 7 % 1009, t, "en", "s", 0) for k, t in enumerate(texts)]
    return rows + [rows[5], rows[5], (None, texts[3], "en", "s", 0), (None, "none like it", "en", "s", 0),
                   (rows[8][0], "same id, another text", "en", "s", 0)]


@pytest.mark.parametrize("leaf,block", [(chosen_path.LEAF, chosen_path.BLOCK), (6, 5)])
def test_join_is_brute_force(spark, leaf, block):
    rows = join_rows()
    got = chosen_path.near_groups(documents(spark, rows), leaf=leaf, block=block)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert Counter(map(tuple, got.collect())) == slow_components(rows)


def test_join_of_empty_and_unlinked_tables(spark):
    assert chosen_path.near_groups(documents(spark, [])).count() == 0
    rows = [(1, "a b c d", None, None, 0), (2, None, None, None, 0), (3, None, None, None, 0)]
    got = chosen_path.near_groups(documents(spark, rows))
    assert sorted(map(tuple, got.collect())) == [(1, 2, 1, True), (2, 0, 2, True), (3, 0, 3, True)]


def test_trees_reach_the_recall():
    trees = chosen_path.tree_count(0.85, chosen_path.RECALL)
    q = 0.0
    for _ in range(50):
        q = (0.15 + 0.85 * q) ** chosen_path.CHOSEN
    assert q ** trees <= 1e-8 < q ** (trees - 1)


def test_two_texts_near_the_threshold(spark):
    rows = [(k, t, "en", "s", 0) for k, t in enumerate(near_copies(9, 2, 400, 9))]
    got = chosen_path.near_groups(documents(spark, rows)).agg(F.countDistinct("component_id"))
    assert got.first()[0] == len({r[2] for r in slow_components(rows)})
