"""Registered streaming queries.

Each lands the ``events`` table in the shared folder by an ordinary parallel
write, runs the stream over the files in a few micro-batches with
``availableNow``, and returns the table the stream maintained. The final tables
equal the batch results, so the batch oracle SQL applies. The queries of late rows land the
table in steps by arrival and run the stream after each, as files written in parallel
have no arrival order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.catalog import AS_OF
from tidemark.schemas import RAW_COLUMNS
from tidemark.session import checkpoint_dir, scratch_path
from tidemark.sources.raw import city_dim, observations, observations_from_events, read_table
from tidemark.sources.versions import Store
from tidemark.streaming import incremental as inc
from tidemark.streaming.daily_state import read_daily, run_batch

MICRO_BATCHES = 4
EARLIER = "2024-01-12 12:00:00"
STEP_ENDS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")


def _raw_stream(spark: SparkSession, sf: str, batches: int = MICRO_BATCHES) -> DataFrame:
    events = read_table(spark, sf, "events")
    checkpoint_dir(spark)
    landing = scratch_path(spark, "landing-events")
    files = max(batches, int(spark.conf.get("spark.sql.shuffle.partitions")))
    events.repartition(files).write.parquet(landing)
    each = -(-files // batches) if batches > 1 else None
    stream = inc.read_landing(spark, landing, events.schema, max_files_per_trigger=each)
    return observations_from_events(stream, city_dim(spark))


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def q_stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    target = scratch_path(spark, "stream-raw")
    _finish(inc.ingest(_raw_stream(spark, sf), target, scratch_path(spark, "ckpt")))
    return spark.read.parquet(target).select(*RAW_COLUMNS)


def q_stream_latest_wins(spark: SparkSession, sf: str) -> DataFrame:
    target = scratch_path(spark, "stream-latest")
    _finish(inc.run_latest_wins(_raw_stream(spark, sf), target, scratch_path(spark, "ckpt")))
    return inc.read_latest(spark, target)


def _arrival_steps(spark: SparkSession, sf: str, run) -> None:
    """Land the observations in three steps by arrival and call ``run(stream)`` after each.

    Every 40th id of the first step comes with the last one, far behind the watermark.
    """
    raw = observations(spark, sf)
    arrived = F.col("inserted_at")
    first = arrived < F.lit(STEP_ENDS[0]).cast("timestamp_ntz")
    second = arrived < F.lit(STEP_ENDS[1]).cast("timestamp_ntz")
    step = F.when(first, F.when(F.col("id") % 40 == 7, 3).otherwise(1)).when(second, 2).otherwise(3)
    checkpoint_dir(spark)
    landing = scratch_path(spark, "landing-steps")
    for k in (1, 2, 3):
        raw.where(step == k).write.mode("append").parquet(landing)
        _finish(run(inc.read_landing(spark, landing, raw.schema)))


def q_stream_windowed_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Latest-wins through the state store; rows behind the watermark are dropped."""
    target, checkpoint = scratch_path(spark, "stream-windowed"), scratch_path(spark, "ckpt")
    _arrival_steps(spark, sf, lambda s: inc.run_windowed_latest(s, target, checkpoint))
    return inc.read_latest(spark, target)


def q_stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The rows that came behind the watermark."""
    root, checkpoint = scratch_path(spark, "stream-late"), scratch_path(spark, "ckpt")
    _arrival_steps(spark, sf, lambda s: inc.run_with_late(s, root, checkpoint))
    return Store(spark, root).read(inc.LATE).select(*RAW_COLUMNS)


def q_stream_daily_refresh(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "stream-daily")
    _finish(inc.run_refresh(_raw_stream(spark, sf), root, scratch_path(spark, "ckpt"),
                            as_of=AS_OF))
    return read_daily(spark, root)


def q_stream_daily_expiry(spark: SparkSession, sf: str) -> DataFrame:
    """Daily rollup after two runs: half of the events (even ids) under an earlier clock,
    then the rest under ``AS_OF``. Rows kept by the first run expire in the second."""
    raw = observations(spark, sf)
    root = scratch_path(spark, "stream-expiry")
    for epoch, (rest, as_of) in enumerate(((0, EARLIER), (1, AS_OF))):
        run_batch(raw.where(F.col("id") % 2 == rest), root, as_of, stream="expiry", epoch=epoch)
    return read_daily(spark, root)


STREAM_QUERIES = {
    "stream_ingest": q_stream_ingest,
    "stream_latest_wins": q_stream_latest_wins,
    "stream_windowed_latest": q_stream_windowed_latest,
    "stream_late_rows": q_stream_late_rows,
    "stream_daily_refresh": q_stream_daily_refresh,
    "stream_daily_expiry": q_stream_daily_expiry,
}

# streaming query -> batch query whose oracle SQL it must match
STREAM_ORACLES: dict[str, str] = {
    "stream_ingest": "raw_projection",
    "stream_latest_wins": "dedup_latest",
    "stream_windowed_latest": "stream_windowed_latest",
    "stream_late_rows": "stream_late_rows",
    "stream_daily_refresh": "daily_average",
    "stream_daily_expiry": "daily_average",
}
