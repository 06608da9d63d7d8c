"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same expected number of copies, target / size of the
source. Its whole part is granted outright; the fractional part is a copy probability.
Pairs of fractional documents exchange mass, measured in words, at random until one of
the two is integral: the expected copies stay as they were and a pair's total of words
stays exactly the same. A bounded chunk leaves at most one fractional document; these
residuals meet in the chunks of the next level, a reduction tree whose depth is the
logarithm of the document count. The one document left per source is rounded to the nearer
side, so a source's taken words miss its target by half of one document at most.

Only DataFrame functions run here. Chunks come from a hash, so a source with a third of
all rows is spread over many tasks; rows that repeat id and text are counted first and count as
one, so no task holds more than a chunk at once. All draws
are hashes of the document's own columns, so reruns and recomputed tasks agree.

Edge cases: null text has size 0; documents of size 0 take 0 words. Null is a source of
its own, last in order. Repeated rows are separate documents and may differ in what they
take. A corpus without words has targets of 0. Empty tables give no rows. Other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_COPIES = 2.0
CHUNK = 96
LAST_LEVEL = 2 * CHUNK
BROADCAST_SOURCES = 100_000
REPEATS = 10_000


def word_count(col: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` words; 0 for null."""
    return F.regexp_count(F.coalesce(col, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_targets(sizes: DataFrame, *, weights=WEIGHTS, share=SHARE,
                   most=MOST_COPIES) -> DataFrame:
    """Targets per source from (source, source_size): capped water filling.

    The windows below see one row per source, not the documents.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    named = sizes.withColumn("weight", F.element_at(
        cycle, F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1))
    named = named.withColumn("cap", most * F.col("source_size")) \
        .withColumn("fill", F.col("cap") / F.col("weight"))
    everything = Window.partitionBy(F.lit(0))
    before = everything.orderBy("fill", F.col("source").asc_nulls_last()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    # With the sources sorted by the level at which each one fills up, the right level is
    # the first one that the next source does not reach.
    level = (F.lit(share) * F.sum("source_size").over(everything)
             - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) \
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    named = named.withColumn("level", level)
    water = F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "level"))) \
        .over(everything)["level"]
    return named.withColumn("water", water).select(
        "source", "source_size",
        F.when(F.col("water").isNull(), F.col("cap"))
        .otherwise(F.least("cap", F.col("water") * F.col("weight"))).alias("target"))


def fold_chunk(items: Column, seed: int) -> Column:
    """Fold one chunk: struct(done: array of decided items, left: the one residual or null).

    An item has words, mass (0..words, its expected words) and draw (a uniform hash).
    """
    def merge(state, x):
        left = state["left"]
        up = F.least(left["words"] - left["mass"], x["mass"])
        down = F.least(left["mass"], x["words"] - x["mass"])
        # Drawn from both items, so each pair has its own draw.
        u = F.pmod(F.xxhash64(left["draw"], x["draw"], F.lit(seed)), F.lit(1 << 52)) \
            / F.lit(float(1 << 52))
        rises = u * (up + down) < down
        m_left = F.when(rises, left["mass"] + up).otherwise(left["mass"] - down)
        m_x = F.when(rises, x["mass"] - up).otherwise(x["mass"] + down)
        left_done = F.when(rises, left["words"] - left["mass"] <= x["mass"]) \
            .otherwise(left["mass"] <= x["words"] - x["mass"])
        taken_left = F.when(rises, left["words"]).otherwise(F.lit(0).cast("long"))
        taken_x = F.when(rises, F.lit(0).cast("long")).otherwise(x["words"])
        decided = F.when(left_done, left.withField("got", taken_left)) \
            .otherwise(x.withField("got", taken_x))
        kept = F.when(left_done, x.withField("mass", m_x)) \
            .otherwise(left.withField("mass", m_left))
        return F.when(
            left.isNull(), F.struct(state["done"].alias("done"), x.alias("left"))
        ).otherwise(F.struct(F.array_append(state["done"], decided).alias("done"),
                             kept.alias("left")))

    first = F.struct(F.slice(items, 1, 0).alias("done"), F.get(F.slice(items, 1, 0), F.lit(0))
                     .alias("left"))
    return F.aggregate(items, first, merge)


def by_source(rows: DataFrame, small: DataFrame) -> DataFrame:
    """Join a table with one row per source (column t_source) to ``rows``.

    It is broadcast only while its counted rows stay few; beyond that the join shuffles on
    the source, and adaptive execution splits a frequent one.
    """
    if small.count() <= BROADCAST_SOURCES:
        small = F.broadcast(small)
    return rows.join(small, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")


def pivotal(docs: DataFrame) -> DataFrame:
    """Decide every fractional document, level by level up the reduction tree.

    ``docs`` has source, words (> 0), mass (strictly between 0 and words), draw, id and m (carried
    along). Returns the same rows with ``got``, 0 or ``words``.
    """
    done = []
    level, current = 0, docs.withColumn("got", F.lit(0).cast("long"))
    while True:
        counts = cut(current.groupBy(F.col("source").alias("t_source"))
                     .agg(F.count(F.lit(1)).alias("n")))
        last = (counts.agg(F.max("n")).first()[0] or 0) <= LAST_LEVEL
        chunks = F.when(F.col("n") <= LAST_LEVEL, 1).otherwise(F.ceil(F.col("n") / CHUNK))
        keyed = by_source(current, counts).withColumn(
            "chunk", F.pmod(F.xxhash64("draw", F.lit(level)), chunks))
        items = F.sort_array(F.collect_list(F.struct("words", "draw", "id", "mass", "got", "m")),
                             asc=False)
        folded = cut(keyed.groupBy("source", "chunk").agg(items.alias("items"))
                     .select("source", fold_chunk(F.col("items"), level).alias("f")))
        done.append(folded.select("source", F.explode("f.done").alias("x"))
                    .select("source", "x.*"))
        current = folded.select("source", "f.left.*")
        if last:
            break
        level += 1
    nearer = F.when(F.col("mass") * 2 >= F.col("words"), F.col("words")) \
        .otherwise(F.lit(0).cast("long"))
    result = current.withColumn("got", nearer)
    for part in done:
        result = result.unionByName(part)
    return result


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights=WEIGHTS, share=SHARE, most=MOST_COPIES) -> DataFrame:
    """doc_id, size, source, source_size, target, taken (words, repeats counted) per document."""
    # Rows that repeat id and text are one item with a count: they differ in nothing that the mix
    # reads, so only the number of them that take a copy more has to be decided.
    sized = cut(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                            word_count(F.col(text_col)).alias("words"),
                            F.xxhash64(F.col(id_col), F.col(text_col)).alias("draw"))
                .groupBy("source", "words", "draw", "id").agg(F.count(F.lit(1)).alias("m")))
    sizes = sized.groupBy("source").agg(F.sum(F.col("words") * F.col("m")).alias("source_size"))
    targets = cut(source_targets(sizes, weights=weights, share=share, most=most))
    named = targets.withColumnRenamed("source", "t_source")
    rows = by_source(sized, named)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")) \
        .otherwise(F.lit(0.0))
    whole = F.floor(ratio + F.lit(1e-12))
    extra = F.greatest(F.lit(0.0), ratio - whole) * F.col("m")
    sure = F.floor(extra + F.lit(1e-12))
    rows = rows.withColumns({"copies": whole, "sure": sure, "mass": F.greatest(
        F.lit(0.0), extra - sure) * F.col("words")})
    part = (F.col("mass") > 1e-9) & (F.col("words") > 0)
    fixed = rows.where(~part).withColumn("got", F.lit(0).cast("long"))
    decided = pivotal(rows.where(part).select("source", "words", "mass", "draw", "id", "m"))
    decided = by_source(decided, named).withColumns({"copies": whole, "sure": sure})
    more = F.col("sure") + (F.col("got") > 0).cast("long")

    def spread(df: DataFrame) -> DataFrame:
        """The rows again, ``REPEATS`` of an item at a time."""
        lots = F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / REPEATS))
        df = df.withColumn("more", more).withColumn("lot", F.explode(lots))
        here = F.least(F.lit(REPEATS).cast("long"), F.col("m") - F.col("lot") * REPEATS)
        df = df.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), here)))
        copies = F.col("copies") + (F.col("lot") * REPEATS + F.col("nth") <= F.col("more")).cast("long")
        return df.select(F.col("id").alias(id_col), F.col("words").alias("size"), F.col("source"),
                         "source_size", "target", (copies * F.col("words")).cast("long").alias("taken"))

    return spread(fixed.select("id", "words", "source", "source_size", "target", "m", "copies",
                               "sure", "got")).unionByName(
        spread(decided.select("id", "words", "source", "source_size", "target", "m", "copies",
                              "sure", "got")))
