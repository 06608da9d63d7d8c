"""URL filters: host-suffix and path-prefix expressions looked up by short hash prefix.

Distinct (host, head of path) pairs are expanded into the expressions a rule could be
written as: every host suffix that starts at a label, times the path prefixes of the
lengths that rules have. Expressions meet rules in an equi-join on the first 4 bytes of
their SHA-256; the full digest confirms, and the longest rule wins (at equal length the
longer host, then block before allow). The path is cut at the longest rule path for the
lookup only, since no rule can look further.

The rules table may be of any size: it is broadcast only below ``BROADCAST_RULES`` rows
(counted), else both sides shuffle on the hash prefix, salted against frequent hosts.

Edge cases: a null url, or one without ``://``, has an empty host and path and matches no
rule; the empty host never matches. A page without a rule gets the default verdict
``allow`` and a null rule. Rules with a null host or path are ignored; repeated rules
count once, and block wins where one (host, path) is both. Repeated pages stay repeated.
An empty rules table gives the default for all; an empty pages table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, lower_ascii

DEFAULT_VERDICT = "allow"
BROADCAST_RULES = 200_000
SALTS = 16


def split_url(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(text, pattern, 1)), F.regexp_extract(text, pattern, 2)


def digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge(pages: DataFrame, rules: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
          default: str = DEFAULT_VERDICT) -> DataFrame:
    """One row per page: id, host, path, rule (text or null) and verdict.

    ``rules`` has string columns host, path and verdict (allow or block).
    """
    host, path = split_url(F.col(url_col))
    seen = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))

    rules = rules.where("host is not null and host != '' and path is not null") \
        .groupBy(lower_ascii(F.col("host")).alias("r_host"), F.col("path").alias("r_path")) \
        .agg(F.max("verdict").alias("r_verdict"))  # block sorts after allow
    rules = cut(rules.withColumn("r_digest", digest(F.col("r_host"), F.col("r_path")))
                .withColumn("r_prefix", F.substring("r_digest", 1, 8)))
    shape = rules.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.length("r_path")).alias("longest"),
        F.collect_set(F.length("r_path")).alias("lengths"),
        F.collect_set(F.size(F.split("r_host", r"\."))).alias("labels")).first()
    if not shape["n"]:
        return seen.select(id_col, "host", "path", F.lit(None).cast("string").alias("rule"),
                           F.lit(default).alias("verdict"))

    # Lengths and label counts that no rule has can't match; both lists are bounded by the
    # length of the longest rule.
    lengths = F.array(*[F.lit(int(x)) for x in sorted(shape["lengths"])])
    labels = F.array(*[F.lit(int(x)) for x in sorted(shape["labels"])])
    sites = seen.where("host != ''") \
        .select("host", F.substring("path", 1, max(1, shape["longest"])).alias("head")).distinct()
    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.filter(labels, lambda k: k <= F.size(parts)),
        lambda k: F.array_join(F.slice(parts, F.size(parts) - k + 1, k), "."))
    heads = F.transform(F.filter(lengths, lambda k: k <= F.length("head")),
                        lambda k: F.substring(F.col("head"), F.lit(1), k))
    expressions = sites.withColumn("e_host", F.explode(suffixes)) \
        .withColumn("e_path", F.explode(heads)) \
        .withColumn("e_digest", digest(F.col("e_host"), F.col("e_path"))) \
        .select("host", "head", "e_digest", F.substring("e_digest", 1, 8).alias("e_prefix"))

    if shape["n"] <= BROADCAST_RULES:
        found = expressions.join(F.broadcast(rules), F.col("e_prefix") == F.col("r_prefix"))
    else:
        salted = expressions.withColumn(
            "e_salt", F.pmod(F.xxhash64("host", "head"), F.lit(SALTS)).cast("int"))
        copies = rules.withColumn("r_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        found = salted.join(copies, (F.col("e_prefix") == F.col("r_prefix"))
                            & (F.col("e_salt") == F.col("r_salt")))
    order = F.struct(F.length("r_host") + F.length("r_path"), F.length("r_host"),
                     F.col("r_verdict"), F.col("r_path"))
    best = found.where("e_digest = r_digest").groupBy("host", "head").agg(
        F.max_by(F.struct(F.concat("r_host", "r_path").alias("rule"),
                          F.col("r_verdict").alias("verdict")), order).alias("best"))
    best = cut(best.select(F.col("host").alias("b_host"), F.col("head").alias("b_head"), "best"))
    return seen.join(
        best, (F.col("host") == F.col("b_host"))
        & (F.substring("path", 1, max(1, shape["longest"])) == F.col("b_head")), "left") \
        .select(id_col, "host", "path", F.col("best.rule").alias("rule"),
                F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"))
