"""Registered corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    ann,
    centroid_threshold,
    chosen_path,
    decontaminate,
    filter_audit,
    line_align,
    mixing,
    quality,
    simhash,
    suffix_dedup,
    token_rollup,
    toxicity,
    url_filter,
)
from tidemark.llm.common import crc_rest, cut, table
from tidemark.session import scratch_path

QUALITY_FROM = 0.3
TOXIC_FROM = 0.7


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; learnt from rows outside the held-out fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels, "quality", crc_rest(F.col("__id"), 5) != 0)
    return quality.score_quality(
        docs, model, [F.col("doc_id"), (crc_rest(F.col("doc_id"), 5) == 0).alias("held_out")],
        "doc_id long, held_out boolean",
    ).withColumn("predicted", (F.col("score") >= QUALITY_FROM).cast("int"))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors found for every 50th vector id."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals after inserts of all documents, removals, revisions and a replay.

    Every document is inserted under two tokenizer versions. Documents labelled toxic are
    then deleted, and documents labelled as poor have their word count revised to the
    count of letter/digit runs. The deletions are sent twice; the second time adds nothing.
    """
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", token_rollup.count_words(F.col("text")).alias("words"),
        token_rollup.count_runs(F.col("text")).alias("runs"))
    docs = cut(docs.join(labels, "doc_id", "left"))
    words, runs = F.lit("words-1"), F.lit("runs-1")
    each = F.explode(F.array(F.struct(words.alias("tokenizer_version"), F.col("words").alias("tokens")),
                             F.struct(runs.alias("tokenizer_version"), F.col("runs").alias("tokens"))))
    both = docs.withColumn("x", each).select("source", "lang", "x.*", "toxic", "quality")
    blank = F.lit(None).cast("long").alias("old_tokens")
    inserted = both.select(F.lit("insert").alias("op"), *token_rollup.KEYS, "tokens", blank)
    deleted = both.where("toxic = 1").select(
        F.lit("delete").alias("op"), *token_rollup.KEYS, "tokens", blank)
    revised = docs.where("quality = 0 and coalesce(toxic, 0) != 1").select(
        F.lit("revise").alias("op"), "source", "lang", words.alias("tokenizer_version"),
        F.col("runs").alias("tokens"), F.col("words").alias("old_tokens"))
    root = scratch_path(spark, "token-rollup")
    for batch, changes in (("1-insert", inserted), ("2-delete", deleted), ("3-revise", revised),
                           ("2-delete", deleted)):
        token_rollup.commit(spark, root, batch, changes)
    return token_rollup.totals(spark, root)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; learnt from rows outside the held-out fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, "toxic", lambda i: crc_rest(i, 3) != 1)
    return toxicity.score_toxicity(
        docs, model, [F.col("doc_id"), (crc_rest(F.col("doc_id"), 3) == 1).alias("held_out")],
        "doc_id long, held_out boolean",
    ).withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


# The rules of the contract, as (host, path, verdict).
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, winning rule and verdict of every page."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that every document loses to earlier ones, and a digest of what stays."""
    kept = line_align.dedup_lines(table(spark, sf_dir, "documents"), gone_col="deleted_lines")
    return kept.select(
        "doc_id", F.coalesce(F.size("deleted_lines"), F.lit(0)).alias("n_deleted"),
        F.coalesce("deleted_lines", F.array().cast("array<int>")).alias("deleted_lines"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"),
                         "component_id")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes that every document loses to strings of 400 bytes that start more than once."""
    return suffix_dedup.dedup_bytes(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confirmed occurrences of benchmark items in documents."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"),
                                      table(spark, sf_dir, "benchmark"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from every source, under all orders and steps."""
    return filter_audit.audit_documents(table(spark, sf_dir, "documents"),
                                        table(spark, sf_dir, "labels"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after ten rounds from eight hashed starts."""
    return centroid_threshold.clustered(table(spark, sf_dir, "embeddings"))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under shingle sets of 85 % similarity."""
    return chosen_path.near_groups(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_url_filter": op2_url_filter,
    "op3_nearest": op3_nearest,
    "op4_token_counts": op4_token_counts,
    "op5_toxicity": op5_toxicity,
    "op6_line_dedup": op6_line_dedup,
    "op7_simhash": op7_simhash,
    "op8_mixing": op8_mixing,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_decontaminate": op10_decontaminate,
    "op11_filter_audit": op11_filter_audit,
    "op12_centroids": op12_centroids,
    "op13_minhash": op13_minhash,
}


def centroid_sql() -> str:
    """Plain k-means over the integer vectors: one pair of tables a round."""
    k, rounds, dims = (centroid_threshold.CENTROIDS, centroid_threshold.ROUNDS,
                       centroid_threshold.DIMENSIONS)

    def nearest(r: int) -> str:
        return f"""a{r} AS MATERIALIZED (
            SELECT rid, c, d FROM (
                SELECT rid, c, d, row_number() OVER (PARTITION BY rid ORDER BY d, c) AS o FROM (
                    SELECT x.rid, m.c, CAST(sum((x.v - m.v) * (x.v - m.v)) AS BIGINT) AS d
                    FROM x JOIN m{r} m USING (i) GROUP BY x.rid, m.c)) WHERE o = 1
        )"""

    def moved(r: int) -> str:
        return f"""m{r} AS MATERIALIZED (
            SELECT m.c, m.i, CASE WHEN s.n IS NULL THEN m.v
                                  ELSE CAST((s.t - ((s.t % s.n) + s.n) % s.n) // s.n AS BIGINT)
                             END AS v
            FROM m{r - 1} m LEFT JOIN (
                SELECT a.c, x.i, sum(x.v) AS t, count(*) AS n
                FROM a{r - 1} a JOIN x USING (rid) GROUP BY a.c, x.i) s USING (c, i)
        )"""

    steps = [nearest(0)]
    for r in range(1, rounds + 1):
        steps += [moved(r), nearest(r)]
    chain = ",\n".join(steps)
    return f"""
        WITH e AS (
            SELECT row_number() OVER () AS rid, vec_id, embedding FROM embeddings
        ), u AS (
            SELECT rid, vec_id, unnest(range(1, {dims + 1})) AS i, unnest(embedding) AS raw
            FROM e WHERE len(embedding) = {dims}
        ), good AS (
            SELECT rid FROM u GROUP BY rid HAVING count(raw) = {dims} AND bool_and(isfinite(raw))
        ), x AS MATERIALIZED (
            SELECT rid, vec_id, i, CAST(floor(1024 * CAST(raw AS DOUBLE)) AS BIGINT) AS v
            FROM u JOIN good USING (rid)
        ), ids AS (
            SELECT rid, vec_id,
                   sha256('{centroid_threshold.SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h,
                   list(v ORDER BY i) AS vs
            FROM x GROUP BY rid, vec_id
        ), seeds AS (
            SELECT rid, row_number() OVER (ORDER BY h, vs) - 1 AS c FROM ids
            ORDER BY h, vs LIMIT {k}
        ), m0 AS MATERIALIZED (
            SELECT c, i, v FROM seeds JOIN x USING (rid)
        ), {chain}, names AS (
            SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256
            FROM m{rounds} GROUP BY c
        )
        SELECT ids.vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance,
               CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
               CAST(sum(a.d) OVER () AS BIGINT) AS inertia, names.centroid_sha256
        FROM a{rounds} a JOIN ids USING (rid) JOIN names USING (c)
    """


ORACLE_SQL: dict[str, str] = {
    "op12_centroids": centroid_sql(),
    "op11_filter_audit": r"""
        WITH d AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), l AS (
            SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good,
                   max(CAST(toxic = 1 AS INTEGER)) AS toxic
            FROM labels GROUP BY doc_id
        ), f AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                   CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
                   || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
                   || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t)
                           THEN 'C' ELSE '' END
                   || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
                   || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS mask
            FROM d LEFT JOIN l USING (doc_id)
        ), counts AS (
            SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
            FROM f GROUP BY part, mask
        ), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        orders AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS o
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
        ), steps AS (
            SELECT o, s, substr(o, s, 1) AS x, substr(o, 1, s - 1) AS before
            FROM orders, (SELECT unnest(range(1, 6)) AS s)
        ), sums AS (
            SELECT part, o, s, x,
                   sum(CASE WHEN translate(mask, before || x, '') = mask THEN n ELSE 0 END) AS kept,
                   sum(CASE WHEN contains(mask, x) AND translate(mask, before, '') = mask
                            THEN n ELSE 0 END) AS removed,
                   sum(CASE WHEN contains(mask, x) AND translate(mask, before, '') <> mask
                            THEN n ELSE 0 END) AS redundant,
                   sum(CASE WHEN mask = x THEN n ELSE 0 END) AS unique_fails,
                   sum(CASE WHEN contains(mask, x) AND translate(mask, before, '') = mask
                            THEN good ELSE 0 END) AS good_lost,
                   sum(CASE WHEN contains(mask, x) AND translate(mask, before, '') = mask
                            THEN toxic ELSE 0 END) AS toxic_lost
            FROM counts, steps GROUP BY part, o, s, x
        )
        SELECT part, o AS filter_order, CAST(s AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
               CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
               CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
               CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
        FROM sums
    """,
    "op4_token_counts": r"""
        WITH l AS (
            SELECT doc_id, max(toxic) AS toxic, min(quality) AS quality FROM labels GROUP BY doc_id
        ), d AS (
            SELECT source, lang, coalesce(toxic, 0) AS toxic, coalesce(quality, 1) AS quality,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
                   len(regexp_extract_all(coalesce(text, ''), '[\p{L}\p{N}]+')) AS runs
            FROM documents LEFT JOIN l USING (doc_id)
        ), kept AS (
            SELECT source, lang, 'words-1' AS tokenizer_version,
                   CASE WHEN quality = 0 THEN runs ELSE words END AS tokens
            FROM d WHERE toxic <> 1
            UNION ALL
            SELECT source, lang, 'runs-1', runs FROM d WHERE toxic <> 1
        )
        SELECT source, lang, tokenizer_version, count(*) AS documents,
               CAST(sum(tokens) AS BIGINT) AS tokens
        FROM kept GROUP BY source, lang, tokenizer_version
    """,
    "op2_url_filter": r"""
        WITH parts AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path
            FROM pages
        ), judged AS (
            SELECT *,
                   CASE
                       WHEN (host = 'example.net' OR ends_with(host, '.example.net'))
                            AND starts_with(path, '/en/') THEN 'example.net/en/'
                       WHEN (host = 'example.com' OR ends_with(host, '.example.com'))
                            AND starts_with(path, '/de/') THEN 'example.com/de/'
                       WHEN (host = 'org' OR ends_with(host, '.org'))
                            AND starts_with(path, '/fr/') THEN 'org/fr/'
                       WHEN (host = 'net' OR ends_with(host, '.net'))
                            AND starts_with(path, '/') THEN 'net/'
                   END AS rule
            FROM parts
        )
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END
                   AS verdict
        FROM judged
    """,
}
