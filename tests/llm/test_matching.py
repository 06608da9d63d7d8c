"""SimHash, line alignment, byte dedup and decontamination against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from fixtures import documents, lines, prose
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, line_align, simhash, suffix_dedup
from tidemark.llm.components import components
from tidemark.llm.queries import op6_line_dedup, op7_simhash, op9_suffix_dedup, op10_decontaminate

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    parts = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] if len(words) > 2 \
        else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_groups(rows, bits=3):
    fps = [slow_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (i, _), c in zip(rows, label):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    return Counter((i, f"{f:016x}", least.get(c)) for (i, _), f, c in zip(rows, fps, label))


@pytest.mark.parametrize("kind", ["awkward", "table"])
def test_simhash_is_brute_force(spark, kind):
    if kind == "table":
        docs = spark.read.parquet(f"{SF}/documents.parquet")
        got = op7_simhash(spark, SF)
    else:
        docs = documents(spark)
        got = simhash.near_groups(docs).select(
            "doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")
    assert Counter(map(tuple, got.collect())) == slow_groups(rows_of(docs))


def test_simhash_shards_lose_no_link(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 400, dtype=np.int64)
    near = base[:200] ^ (np.int64(1) << rng.integers(0, 62, 200))
    hub = base[0] ^ (np.int64(1) << np.arange(40)) ^ (np.int64(1) << ((np.arange(40) + 7) % 41))
    fps = np.unique(np.concatenate([base, near, hub]))
    table = spark.createDataFrame([(int(x),) for x in fps], "fp long")
    edges = simhash.links(table, shard=40, block=30, sample=300)
    root = {r["node"]: r["root"] for r in components(edges).collect()}
    x = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    for i, j in zip(*np.nonzero(x)):
        if i != j:
            assert root[int(fps[i])] == root[int(fps[j])]
    for e in edges.collect():
        assert ((e["a"] ^ e["b"]) & ((1 << 64) - 1)).bit_count() >= 1
    linked = {int(fps[i]) for i, j in zip(*np.nonzero(x)) if i != j}
    assert set(root) == linked


def test_one_document_of_each_group_stays(spark):
    docs = documents(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    groups = simhash.near_groups(docs)
    assert kept.count() == groups.select("class_fp").distinct().count()
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert 3 in ids and not ids & {24, 25}
    assert simhash.near_groups(docs.limit(0)).count() == 0
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(50)] + [(100, 100 + k) for k in range(1, 30)]
    got = components(spark.createDataFrame([*chain, (7, 7), (None, 3)], "a long, b long"))
    groups = defaultdict(set)
    for r in got.collect():
        groups[r["root"]].add(r["node"])
    assert sorted(map(len, groups.values())) == [30, 51]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def slow_line_dedup(rows):
    """Deleted line positions by (id, text), from all candidate pairs in memory."""
    held, have = {}, {}
    blank = line_align.BLANK
    for key in set(rows):
        cut = [(p, x.strip(blank)) for p, x in enumerate((key[1] or "").split("\n"))]
        have[key] = [(at, p, x) for at, (p, x) in enumerate((p, x) for p, x in cut if x)]
    order = {}
    for key in have:
        order[key] = (key[0] if key[0] is not None else line_align.LAST_ID, key[2])
    for key, own in have.items():
        for x in {x for _, _, x in own}:
            held.setdefault(x, []).append(key)
    pairs = set()
    for keys in held.values():
        keys.sort(key=order.get)
        for j in range(1, len(keys)):
            pairs |= {(a, keys[j]) for a in (keys[:j] if len(keys) <= line_align.RARE else keys[:1])}
    gone = defaultdict(set)
    for a, b in pairs:
        one, two = ([x for x in have[k] if len(held[x[2]]) > 1] for k in (a, b))
        lost = line_align.common_blocks(
            [x[0] for x in one], [x[2] for x in one], [x[0] for x in two], [x[2] for x in two],
            [len(x[2]) for x in two], line_align.LEAST_CHARS)
        gone[b] |= {two[j][1] for j in lost}
    return gone


def hashed_rows(docs):
    return [tuple(r) for r in docs.select("doc_id", "text", F.xxhash64("text")).collect()]


@pytest.mark.parametrize("kind", ["awkward", "table"])
def test_line_dedup_is_brute_force(spark, kind):
    docs = spark.read.parquet(f"{SF}/documents.parquet") if kind == "table" else documents(spark)
    rows = hashed_rows(docs)
    gone = slow_line_dedup(rows)
    want = Counter()
    for key in rows:
        text = key[1]
        if gone.get(key):
            text = "\n".join(x for p, x in enumerate(text.split("\n")) if p not in gone[key])
        want[(key[0], text)] += 1
    got = line_align.dedup_lines(docs)
    assert got.columns == docs.columns
    assert Counter(rows_of(got)) == want
    if kind == "table":
        out = op6_line_dedup(spark, SF).collect()
        assert sum(r["n_deleted"] for r in out) == sum(map(len, gone.values())) > 0
        assert all(r["n_deleted"] == len(r["deleted_lines"]) for r in out)


def test_frequent_line_goes_from_all_but_its_first_holder(spark):
    common = "this very common line stands in every document"
    rows = [(k, f"{prose(f'a{k}', 9)}\n{common}\n{prose(f'b{k}', 9)}", "en", "s", 1) for k in range(30)]
    got = dict(rows_of(line_align.dedup_lines(documents(spark, rows))))
    assert common in got[0]
    assert not any(common in got[k] for k in range(1, 30))
    assert all(prose(f"a{k}", 9) in got[k] for k in range(30))
    assert line_align.dedup_lines(documents(spark, []).limit(0)).count() == 0


def frequent_rows():
    """Blocks with over RARE holders that one alignment with each line's first holder leaves."""
    x, y = "this very common line is in all of them", "another line that many documents hold"
    texts = [f"{x}\n{prose('p', 5)}\n{y}"]
    texts += [f"{y}\n{prose(f'c{k}', 9)}\n{x}" for k in range(5)]          # crossing
    texts += [f"{x}\n{prose(f'r{k}', 9)}\n{x}\n{prose(f's{k}', 9)}\n{y}" for k in range(6)]  # repeats
    # Short lines with first holders of their own, first together in the third of these.
    texts += ["first part\n" + prose("u", 9), "second part\n" + prose("v", 9)]
    texts += [f"{prose(f'w{k}', 9)}\nfirst part\n \nsecond part\n{prose(f'z{k}', 9)}" for k in range(12)]
    texts += [f"second part\nfirst part\n{prose('t', 9)}"]
    return [(k, t, "en", "s", 1) for k, t in enumerate(texts)]


@pytest.mark.parametrize("rare", [line_align.RARE, 2])
def test_blocks_go_whatever_the_number_of_holders(spark, monkeypatch, rare):
    rows = frequent_rows()
    docs = documents(spark, rows)
    got = {r["doc_id"]: set(r["gone"] or ())
           for r in line_align.dedup_lines(docs, rare=rare, gone_col="gone").collect()}
    hashed = hashed_rows(docs)
    monkeypatch.setattr(line_align, "RARE", len(rows))
    every = {key[0]: gone for key, gone in slow_line_dedup(hashed).items()}
    assert every and all(gone <= got[i] for i, gone in every.items())
    # Exactly the runs of 20 characters that stand in an earlier document.
    own = {i: [(p, x) for p, x in enumerate(t.split("\n")) if x.strip()] for i, t, *_ in rows}
    seen = set()
    for i, here in own.items():
        runs = [(tuple(x for _, x in here[a:b]), [p for p, _ in here[a:b]])
                for a in range(len(here)) for b in range(a + 1, len(here) + 1)]
        runs = [r for r in runs if sum(map(len, r[0])) >= line_align.LEAST_CHARS]
        assert got[i] == {p for run, at in runs if run in seen for p in at}
        seen |= {run for run, _ in runs}


def test_windows_cover_every_block():
    rng = np.random.default_rng(4)
    for _ in range(300):
        n = int(rng.integers(1, 14))
        chars, at = rng.integers(1, 26, n).tolist(), np.cumsum(rng.integers(1, 3, n)).tolist()
        often = (rng.random(n) < 0.8).tolist()
        spans = line_align.windows(at, often, chars, 20)
        for a in range(n):
            for b in range(a + 1, n + 1):
                if sum(chars[a:b]) >= 20 and all(often[a:b]) and at[b - 1] - at[a] == b - 1 - a:
                    inside = [(i, j) for i, j in spans if a <= i and j <= b]
                    assert {k for i, j in inside for k in range(i, j)} == set(range(a, b))
        assert all(sum(chars[i:j]) >= 20 and all(often[i:j]) for i, j in spans)


def test_patience_keeps_order():
    a, b = list("abcdefgh"), list("xabdcefgy")
    pairs = line_align.patience(a, b)
    assert pairs == sorted(pairs) and all(a[i] == b[j] for i, j in pairs)
    assert [j for _, j in pairs] == sorted(j for _, j in pairs)
    assert line_align.patience([], b) == []


def slow_byte_dedup(rows, length):
    seen = Counter()
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, b in data:
        for p in range(len(b) - length + 1):
            seen[b[p:p + length]] += 1
    out = Counter()
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[(i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("many", [suffix_dedup.MANY, 1])
def test_byte_dedup_is_brute_force(spark, many):
    docs = documents(spark)
    got = suffix_dedup.dedup_bytes(docs, length=50, many=many)
    assert Counter(map(tuple, got.collect())) == slow_byte_dedup(rows_of(docs), 50)
    assert suffix_dedup.dedup_bytes(docs.limit(0)).count() == 0


def test_byte_dedup_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = Counter(map(tuple, op9_suffix_dedup(spark, SF).collect()))
    assert got == slow_byte_dedup(rows_of(docs), 400)


def byte_text(seed, n, letters=b"abcdefghij"):
    rng = random.Random(seed)
    return bytes(rng.choice(letters) for _ in range(n)).decode()


def test_byte_refinement_ranks_windows_exactly():
    rng = random.Random(3)
    for length in (1, 2, 5, 8, 9, 20, 50):
        runs = [byte_text(k, length + rng.randrange(40), b"ab").encode() for k in range(30)]
        starts, hit = suffix_dedup.repeated_windows(runs, length)
        count = Counter(r[k:k + length] for r in runs for k in range(len(r) - length + 1))
        for s, r in zip(starts, runs):
            for k in range(len(r) - length + 1):
                assert hit[s + k] == (count[r[k:k + length]] > 1)
        got = {(int(r), int(x)) for r, lo, hi in zip(*suffix_dedup.window_spans(runs, length))
               for x in range(lo, hi)}
        want = {(n, x) for n, r in enumerate(runs) for k in range(len(r) - length + 1)
                if count[r[k:k + length]] > 1 for x in range(k, k + length)}
        assert got == want


def test_null_ids_with_equal_short_hashes_keep_their_own_text(spark):
    """Two texts of one 32-bit hash: the one that nothing repeats stays whole."""
    text = F.repeat(F.md5(F.col("id").cast("string")), 4)
    pair = spark.range(200_000).select(text.alias("t")).groupBy(F.hash("t")).agg(
        F.collect_list("t").alias("ts")).where("size(ts) > 1").first().ts
    rows = [(None, pair[0], None, None, 0), (1, pair[0], None, None, 0), (None, pair[1], None, None, 0)]
    docs = documents(spark, rows)
    got = Counter(map(tuple, suffix_dedup.dedup_bytes(docs, length=100).collect()))
    assert got == slow_byte_dedup(rows_of(docs), 100)
    assert sorted(r[2] for r in got) == [0, 128, 128]


def test_many_copies_without_ids_give_one_set_of_spans(spark):
    text = byte_text("copy", 700)
    rows = [(None, text, None, None, 0)] * 2000 + [(5, text[100:400] + byte_text("rest", 300), None, None, 0)]
    docs = documents(spark, rows)
    spans = suffix_dedup.removed_spans(suffix_dedup.keyed(docs, "doc_id", "text"), 50, 100)
    assert spans.agg(F.max(F.size("spans"))).first()[0] < 100
    got = Counter(map(tuple, suffix_dedup.dedup_bytes(docs, length=50, many=100).collect()))
    small = [rows[0], rows[1], rows[-1]]
    want = slow_byte_dedup([(r[0], r[1]) for r in small], 50)
    assert set(got) == set(want) and got[next(x for x in got if x[0] is None)] == 2000


@pytest.mark.parametrize("block", [suffix_dedup.BLOCK_BYTES, 700])
def test_long_texts_are_read_in_overlapping_pieces(spark, monkeypatch, block):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
    long = byte_text("long", 20_000)
    rows = [(1, long, None, None, 0), (2, byte_text("b", 333) + long[650:790] + byte_text("c", 50), None, None, 0),
            (3, long[5_000:9_000], None, None, 0), (4, "ab" * 900, None, None, 0)]
    docs = documents(spark, rows)
    got = Counter(map(tuple, suffix_dedup.dedup_bytes(docs, length=50).collect()))
    assert got == slow_byte_dedup(rows_of(docs), 50)
    for sizes in ([0, 10, 49, 50, 51, 749, 750, 5_000], [0]):
        parts = [p for lot in suffix_dedup.pieces(sizes, 50, 700) for p in lot]
        windows = Counter((k, x) for k, lo, hi in parts for x in range(lo, hi - 49))
        assert windows == Counter((k, x) for k, n in enumerate(sizes) for x in range(n - 49))


def test_long_passages_are_searched_in_pieces(monkeypatch):
    rng = np.random.default_rng(2)
    tokens = rng.integers(0, 1000, 60_000).astype(np.int32)
    items = [{"item": 1, "row": 1, "all": tokens[30_100:30_140].tolist(),
              "question": tokens[30_100:30_120].tolist(), "answer": tokens[30_120:30_140].tolist(),
              "terms": np.unique(tokens[30_100:30_140]).tolist(), "impacts": None},
             {"item": 2, "row": 2, "all": tokens[39_990:40_020].tolist(),
              "question": tokens[39_990:40_000].tolist(), "answer": tokens[40_000:40_020].tolist(),
              "terms": np.unique(tokens[39_990:40_020]).tolist(), "impacts": None}]
    for i in items:
        i["impacts"] = [1 / len(i["terms"])] * len(i["terms"])
    classes = [decontaminate.LengthClass(items, 64, 0.8, 5)]
    offsets = np.array([0, 60_000])
    whole = decontaminate.find_hits(offsets, tokens, classes, 0.8)
    monkeypatch.setattr(decontaminate, "stretches",
                        lambda o, f, lo, hi, size, limit, real=decontaminate.stretches:
                        real(o, f, lo, hi, size, 10_000))
    assert {k[1] for k in whole} == {1, 2}
    assert decontaminate.find_hits(offsets, tokens, classes, 0.8) == whole


def test_decontamination_query_is_brute_force(spark):
    token = re.compile(r"[^\W_]+")

    def shingles(t):
        w = token.findall(t.lower())
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} or {tuple(w)}

    items = {r[0]: shingles(r[1]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    want = {(i, k) for i, t in rows_of(spark.read.parquet(f"{SF}/documents.parquet"))
            for k, s in items.items() if len(s & shingles(t)) >= 0.8 * len(s)}
    got = {(r["doc_id"], r["item_id"]) for r in op10_decontaminate(spark, SF).collect()}
    assert got == want and want


def test_decontamination_edges(spark):
    item = "what grows by the river? " + lines(1, 1, 20)
    part = " ".join(item.split()[:8])
    rows = [(1, f"{prose(5, 300)} {item} {prose(6, 300)}", None, None, 0), (2, prose(7, 500), None, None, 0),
            (3, None, None, None, 0), (4, "", None, None, 0), (5, f"{prose(8, 40)} {part}", None, None, 0),
            (None, item.upper(), None, None, 0), (1, item, None, None, 0)]
    docs = documents(spark, rows)
    items = spark.createDataFrame([(9, item), (9, item), (10, None), (11, ""), (12, "!")],
                                  "item_id long, text string")
    got = decontaminate.contaminated(docs, items)
    assert Counter((r["doc_id"], r["item_id"]) for r in got.collect()) == \
        Counter({(1, 9): 4, (None, 9): 2})
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 5]
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0
    assert decontaminate.clean(docs, items.limit(0)).count() == len(rows)


def test_items_that_end_in_symbols_are_confirmed(spark):
    ends = ['the old heron said "yes."', 'print("Hello river!")', "(see Fig. 2.)", "it is $x=3.$",
            "it is a reed.\t", "it is a reed.\n\n", "a reed?! ...", "it is 3.5)"]
    texts = [f"what grows by the river {prose(f'q{k}', 9)}? {end}" for k, end in enumerate(ends)]
    texts += [f"{prose('one', 12)}.\"", f'"?" {prose("two", 12)}']
    docs = documents(spark, [(k, f"{prose(k, 90)} {t} {prose(k + 50, 90)}", None, None, 0)
                             for k, t in enumerate(texts)])
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, items).collect()}
    assert got >= {(k, k) for k in range(len(texts))}
    assert decontaminate.clean(docs, items).count() == 0
    answers = [None, "", '"', " ?!", *["a reed"] * (len(texts) - 4)]
    items = spark.createDataFrame([(k, t, a) for k, (t, a) in enumerate(zip(texts, answers))],
                                  "item_id long, text string, answer string")
    got = decontaminate.contaminated(docs, items, answer_col="answer").collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} >= {(k, k) for k in range(4)}


def test_index_in_slices_finds_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = Counter(map(tuple, decontaminate.contaminated(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "SLICE_TOKENS", 500)
    assert Counter(map(tuple, decontaminate.contaminated(docs, items).collect())) == whole


def test_block_max_wand_is_exhaustive_scoring():
    rng = np.random.default_rng(2)
    items = []
    for n in range(60):
        terms = sorted(rng.choice(80, size=12, replace=False).tolist())
        w = rng.random(12)
        items.append({"item": n, "row": n, "all": terms, "question": terms, "answer": terms,
                      "terms": terms, "impacts": (w / w.sum()).tolist()})
    index = decontaminate.LengthClass(items, 16, 0.5, 5)
    for _ in range(200):
        query = set(rng.choice(80, size=25, replace=False).tolist())
        want = {}
        for i in items:
            s = sum(w for t, w in zip(i["terms"], i["impacts"]) if t in query)
            if s >= 0.5:
                want[i["item"]] = round(s, 9)
        assert {n: round(s, 9) for n, s in index.search(query)} == want
