"""URL filters, nearest neighbours, token rollups, mixing and the pipeline."""

import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from fixtures import documents
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from tidemark.llm import ann, mixing, token_rollup, url_filter
from tidemark.llm import queries as corpus
from tidemark.session import scratch_path

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def test_all_queries_are_registered():
    names = contract.queries()
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 14))
    assert "pipeline" in names and "pipeline" not in contract.oracle_sql()


@pytest.mark.parametrize("name", sorted(corpus.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = corpus.QUERIES[name](spark, SF)
    want = duck.execute(corpus.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(want.fetchall())


def slow_judge(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:end], rest[end:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    fit = [(len(h) + len(p), len(h), v, h + p) for h, p, v in rules
           if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


@pytest.mark.parametrize("broadcast", [url_filter.BROADCAST_RULES, 0])
def test_url_rules_are_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", broadcast)
    rng = random.Random(4)
    hosts = ["a.net", "A.Example.NET", "example.com", "x.y.example.com", "net", "b.org", "", "é.org",
             "notexample.com", "user@b.org:80", ".net", "..", "w." * 200 + "net"]
    paths = ["", "/", "/en/", "/en", "/de/x?y=/en/", "/fr/a/b#c", "?q", "#f", "/EN/", "/é/",
             "/" + "p/" * 500]
    urls = [f"{rng.choice(['http', 'https', 'x'])}://{h}{p}" for h in hosts for p in paths]
    urls += [None, "", "no scheme/net/", "://", "a://b://net/", "http://a.net/\nb"]
    rules = [*corpus.URL_RULES, ("net", "/en", "allow"), ("w.net", "/p/p", "block"),
             ("a.net", "/", "allow"), ("org", "", "block")]
    rows = [(k % 90, u, None, "h", "r", 1) for k, u in enumerate(urls)]
    pages = spark.createDataFrame(
        rows, "page_id long, url string, html string, host string, rule string, n long")
    table = spark.createDataFrame([*rules, rules[0], (None, "/", "block"), ("x.org", None, "block")],
                                  "host string, path string, verdict string")
    got = Counter(map(tuple, url_filter.judge(pages, table).collect()))
    assert got == Counter((k % 90, *slow_judge(u, rules)) for k, u in enumerate(urls))
    assert url_filter.judge(pages.limit(0), table).count() == 0
    assert {r["verdict"] for r in url_filter.judge(pages, table.limit(0)).collect()} == {"allow"}


def test_nearest_recall_and_scores(spark):
    sf = "/root/testdata/sf0.1"
    got = defaultdict(list)
    for r in corpus.op3_nearest(spark, sf).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r[0] for r in rows if r[1]])
    unit = np.array([r[1] for r in rows if r[1]], dtype=float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    hit = total = 0
    for i in np.flatnonzero(ids % 50 == 0):
        score = unit @ unit[i]
        order = [j for j in np.lexsort((ids, -score)) if j != i][:5]
        mine = got[ids[i]]
        assert len(mine) == 5
        at = {v: k for k, v in enumerate(ids)}
        assert all(abs(s - score[at[v]]) < 1e-12 for v, s in mine)
        hit += len({v for v, _ in mine} & set(ids[order]))
        total += 5
    assert hit / total >= 0.9


def test_nearest_ties_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(k, [1.0, 0.0, 0.0]) for k in range(0, 40)]  # one very common vector
    rows += [(50, [0.0, 2.0, 0.0]), (51, [0.0, 1.0, 0.1]), (100, [1e300, 0.0, 1e299]), (100, [1e300, 0.0, 1e299])]
    rows += [(150, None), (200, []), (250, [0.0, 0.0, 0.0]), (300, [nan, 1.0, 1.0]),
             (350, [1.0, None, 1.0]), (400, [inf, 1.0, 1.0]), (450, [1.0, 2.0]), (None, [1.0, 1.0, 1.0])]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows],
                                  "vec_id long, embedding array<double>, ids string, leaf int")
    got = defaultdict(list)
    for r in ann.nearest(table, F.col("id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"]))
    assert set(got) == {0, 50, 100}
    assert got[0] == [(k, k) for k in range(1, 6)]
    assert got[50][0] == (1, 51)
    assert got[100] == [(k + 1, k) for k in range(5)]
    few = ann.nearest(table.where("vec_id in (50, 51)"), F.col("id") % 50 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in few] == [(50, 1, 51)]
    assert ann.nearest(table.limit(0), F.col("id") % 50 == 0).count() == 0


def test_rollup_commits_once(spark):
    schema = "op string, source string, lang string, tokenizer_version string, tokens long, " \
             "old_tokens long, documents int"
    make = lambda rows: spark.createDataFrame([(*r, 1) for r in rows], schema)
    root = scratch_path(spark, "rollup-test")
    assert token_rollup.totals(spark, root).count() == 0
    first = make([("insert", "a", "en", "v1", 10, None), ("insert", "a", "en", "v1", 10, None),
                  ("insert", None, None, "v1", None, None), ("insert", "b", "en", "v1", 4, None)])
    assert token_rollup.commit(spark, root, "1", first)
    assert not token_rollup.commit(spark, root, "1", first)
    second = make([("delete", "b", "en", "v1", 4, None), ("revise", "a", "en", "v1", 7, 10)])
    assert token_rollup.commit(spark, root, "2", second)
    with pytest.raises(Exception, match="unknown operation"):
        token_rollup.commit(spark, root, "3", make([("upsert", "a", "en", "v1", 1, None)]))
    assert token_rollup.commit(spark, root, "3", make([]))
    got = {(r["source"], r["documents"], r["tokens"]) for r in token_rollup.totals(spark, root).collect()}
    assert got == {("a", 2, 17), (None, 1, 0)}


def test_rollup_replays_a_batch_with_an_empty_marker(spark):
    schema = "op string, source string, lang string, tokenizer_version string, tokens long, old_tokens long"
    root = scratch_path(spark, "rollup-empty-marker")
    fs, marker = token_rollup.file_system(spark, f"{root}/commits/1")
    fs.create(marker, False).close()  # the driver died before it wrote the folder's name
    assert token_rollup.totals(spark, root).count() == 0
    batch = spark.createDataFrame([("insert", "a", "en", "v1", 10, None)], schema)
    assert token_rollup.commit(spark, root, "1", batch)
    assert not token_rollup.commit(spark, root, "1", batch)
    assert [(r["documents"], r["tokens"]) for r in token_rollup.totals(spark, root).collect()] == [(1, 10)]


def test_mixing_hits_targets_and_repeats(spark):
    docs = documents(spark).repartition(5)
    one = sorted(map(tuple, mixing.mix(docs).collect()), key=str)
    assert one == sorted(map(tuple, mixing.mix(docs.repartition(3)).collect()), key=str)
    assert len(one) == docs.count()
    sizes, targets, taken, largest = Counter(), {}, Counter(), Counter()
    for _, size, source, source_size, target, took in one:
        sizes[source] += size
        targets[source] = target
        taken[source] += took
        largest[source] = max(largest[source], size)
        assert 0 <= took <= 2 * size and (size == 0 or took % size == 0)
    total = 1.5 * sum(sizes.values())
    weights = dict(zip(sorted(filter(None, sizes)) + [None], [5, 2, 1, 5]))
    open_, want = set(sizes), {}
    while open_:
        left = total - sum(want.values())
        level = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = {s for s in open_ if level[s] > 2 * sizes[s]}
        want.update({s: 2.0 * sizes[s] if s in over else level[s] for s in over or open_})
        open_ -= over or open_
    for s in sizes:
        assert targets[s] == pytest.approx(want[s])
        assert abs(taken[s] - targets[s]) <= largest[s] / 2 + 1e-6
    assert mixing.mix(docs.limit(0)).count() == 0
    blank = documents(spark, [(1, None, None, "a", 0), (2, " ", None, None, 0)])
    assert {(r["target"], r["taken"]) for r in mixing.mix(blank).collect()} == {(0.0, 0)}


def test_mixing_counts_repeated_rows(spark, monkeypatch):
    """A third of all rows repeat one id and text: the targets hold and no chunk grows."""
    monkeypatch.setattr(mixing, "REPEATS", 7)
    rows = [(k, "w " * (1 + k % 9), "en", "a" if k % 2 else "b", 0) for k in range(600)]
    rows += [(7, "same text here", "en", "a", 0)] * 300 + [(None, None, "en", None, 0)] * 20
    docs = documents(spark, rows)
    one, two = (sorted(map(tuple, mixing.mix(d).collect()), key=str) for d in (docs, docs.repartition(3)))
    assert one == two and len(one) == len(rows)
    for source in ("a", "b"):
        mine = [r for r in one if r[2] == source]
        assert abs(sum(r[5] for r in mine) - mine[0][4]) <= 9
    same = [r for r in one if r[0] == 7 and r[1] == 3]
    ratio = same[0][4] / same[0][3]
    assert len(same) == 300 and abs(sum(r[5] for r in same) - ratio * 900) <= 3
    assert {r[5] // 3 for r in same} <= {int(ratio), int(ratio) + 1}


def slow_fold(items, seed):
    """Pairs of one chunk in order, with the draws of the operator: (words, got) by draw."""
    left, out = None, {}
    for words, draw, mass, u_of in items:
        if left is None:
            left = [words, draw, mass]
            continue
        x = [words, draw, mass]
        up, down = min(left[0] - left[2], x[2]), min(left[2], x[0] - x[2])
        rises = u_of(left[1], draw) * (up + down) < down
        if rises:
            over = left[0] - left[2] <= x[2]
            left[2], x[2] = left[2] + up, x[2] - up
        else:
            over = left[2] <= x[0] - x[2]
            left[2], x[2] = left[2] - down, x[2] + down
        gone, kept = (left, x) if over else (x, left)
        out[gone[1]] = gone[0] if gone[2] > gone[0] / 2 else 0
        left = kept
    return out, left


def test_rounding_follows_the_pairs_one_by_one(spark):
    rng = random.Random(8)
    rows = [(rng.randrange(1, 40), k * 7919, k) for k in range(60)]
    frame = spark.createDataFrame([("s", w, rng.uniform(0.05, 0.95) * w, d, i, 1) for w, d, i in rows],
                                  "source string, words long, mass double, draw long, id long, m long")
    got = {r.draw: r.got for r in mixing.pivotal(frame).collect()}
    order = sorted(((r.words, r.draw, r.mass) for r in frame.collect()), reverse=True)
    pairs = [(a[1], b[1]) for a in order for b in order]
    asked = spark.createDataFrame(pairs, "a long, b long").select("a", "b", F.pmod(
        F.xxhash64("a", "b", F.lit(0)), F.lit(1 << 52)).alias("h")).collect()
    draws = {(r.a, r.b): r.h / (1 << 52) for r in asked}
    want, left = slow_fold([(*o, lambda a, b: draws[a, b]) for o in order], 0)
    want[left[1]] = left[0] if 2 * left[2] >= left[0] else 0
    assert got == want
    total = sum(r.mass for r in frame.collect())
    assert abs(sum(got.values()) - total) <= max(r.words for r in frame.collect()) / 2


def test_mixing_many_levels_is_unbiased(spark):
    rows = [(k, "w " * (1 + k % 9), "en", "hot" if k % 3 else "b", 0) for k in range(3000)]
    got = mixing.mix(documents(spark, rows, extra=False)).toPandas()
    for _, g in got.groupby("source"):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 9
    share = got[got.source == "b"]
    ratio = share.groupby("size").taken.sum() / share.groupby("size")["size"].sum()
    assert ratio.between(share.target.iloc[0] / share.source_size.iloc[0] - 0.3,
                         share.target.iloc[0] / share.source_size.iloc[0] + 0.3).all()


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF)
        path = scratch_path(spark, "pipeline-test")
        got.write.parquet(path)
        got = spark.read.parquet(path)
        assert got.columns == first.columns
        assert got.select("doc_id").subtract(docs.select("doc_id")).count() == 0
        docs = got
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count()
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()), key=str) == \
        sorted(map(tuple, last.collect()), key=str)


def test_pipeline_stages_on_awkward_rows(spark):
    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
        assert stage(spark, docs, SF).count() > 0
