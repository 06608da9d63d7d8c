"""Incremental pipeline on Structured Streaming.

The scheduled full refresh becomes a stream over a landing folder:

* ``ingest``: new files -> raw rows -> append (exactly once through the
  stream checkpoint), ``trigger(availableNow=True)`` for scheduled runs.
* ``merge_latest``: each micro-batch is reduced latest-wins and merged into a versioned
  table cut by slot date. Only the dates the batch touches are read and written anew, to
  fresh folders, and one commit puts them in force together with the epoch's number: a merge
  stopped half way changes nothing, and a replayed epoch that was committed is skipped. Rows
  without a slot time share one part of their own.
* ``run_refresh``: the retained rows and the daily rollup by additive state
  (``streaming.daily_state``).
* ``merge_with_late``: the merge under the same rule for late rows, which keeps them in a table.
* ``windowed_latest``: the state-store form for event-time sources: a
  watermark on arrival time bounds the state, rows are pre-reduced per
  (key, arrival hour) and the merge finishes latest-wins across hours.

Streams need ``timestamp`` (not ``timestamp_ntz``) for watermarks, and
``row_number`` is not allowed on a stream, so the stateful form uses ``max`` of
an ordering struct, and the window form runs inside ``foreachBatch`` where the
micro-batch is a static DataFrame.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.timeshift import hour_floor
from tidemark.operators.dedup import latest_by_aggregate, latest_per_key
from tidemark.schemas import RAW_COLUMNS, RETENTION_HOURS
from tidemark.session import checkpoint_dir
from tidemark.sources.versions import Store, Version
from tidemark.streaming.daily_state import (
    daily_sink,
    epoch_done,
    epoch_notes,
    part_names,
    slot_part,
)

LATEST, LATE = "latest", "late"


def read_landing(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None,
                 fmt: str = "parquet") -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


# -- R1: append ingest ------------------------------------------------------------

def ingest(raw_stream: DataFrame, target_path: str, checkpoint: str) -> StreamingQuery:
    """Append raw rows to ``target_path``; runs everything available, then stops."""
    return (
        raw_stream.select(*RAW_COLUMNS).writeStream.format("parquet")
        .option("path", target_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


# -- R2: latest-wins merge ----------------------------------------------------------

def merge_latest(
    batch: DataFrame, target_path: str, keys=("city", "time"), order_col: str = "inserted_at",
    tie_col: str = "id", date_of: str = "time", stream: str = "", epoch: int | None = None,
) -> Version:
    """Merge one micro-batch into the latest-wins table of the store at ``target_path``."""
    spark = batch.sparkSession
    store = Store(spark, target_path)
    base = store.latest()
    if epoch_done(base, stream, epoch):
        return base
    touched = part_names(batch, slot_part(date_of))
    staged = []
    if touched:
        current = store.read(LATEST, base, touched)
        rows = batch if current is None else current.unionByName(batch)
        merged = latest_per_key(rows, list(keys), order_col, tie_col)
        staged = [store.stage(LATEST, merged, slot_part(date_of), touched)]
    return store.commit(staged, base, epoch_notes(base, stream, epoch))


def latest_wins_sink(target_path: str, stream: str = "", **kw):
    def _sink(batch: DataFrame, epoch_id: int) -> None:
        # Written once: the sink also receives the output of a stateful aggregation, which
        # should run one time only, and caching that fails in the optimizer of PySpark 4.1.
        checkpoint_dir(batch.sparkSession)
        merge_latest(batch.checkpoint(eager=True), target_path, stream=stream, epoch=epoch_id, **kw)
    return _sink


def run_latest_wins(raw_stream: DataFrame, target_path: str, checkpoint: str) -> StreamingQuery:
    return (
        raw_stream.select(*RAW_COLUMNS).writeStream
        .foreachBatch(latest_wins_sink(target_path, stream=checkpoint))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_latest(spark: SparkSession, target_path: str, version: Version | None = None) -> DataFrame:
    return Store(spark, target_path).read(LATEST, version).select(*RAW_COLUMNS)


# -- R3: retained rows and daily rollup ----------------------------------------------

def run_refresh(raw_stream: DataFrame, root: str, checkpoint: str, as_of,
                hours: int = RETENTION_HOURS) -> StreamingQuery:
    """Keep the store at ``root`` (see ``daily_state``) up to date with the stream."""
    return (
        raw_stream.select(*RAW_COLUMNS).writeStream
        .foreachBatch(daily_sink(root, as_of, hours, stream=checkpoint))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


# -- R4: watermarked state-store form -----------------------------------------------

def windowed_latest(raw_stream: DataFrame, delay: str = f"{RETENTION_HOURS} hours",
                    arrival_col: str = "inserted_at") -> DataFrame:
    """Pre-reduce latest-wins per (city, time, arrival hour) with bounded state.

    Rows arriving later than ``delay`` behind the newest arrival are dropped
    (unlike the wall-clock retention filter, this is an arrival-time rule).
    """
    arrival = F.col(arrival_col).cast("timestamp")
    keyed = raw_stream.select(*RAW_COLUMNS).withColumn("_arrival", arrival) \
        .withWatermark("_arrival", delay) \
        .withColumn("_arrival_hour", F.window("_arrival", "1 hour"))
    reduced = latest_by_aggregate(keyed, ["city", "time", "_arrival_hour"], arrival_col, "id")
    return reduced.select(*RAW_COLUMNS)


def merge_with_late(batch: DataFrame, root: str, delay_hours: int = RETENTION_HOURS,
                    arrival_col: str = "inserted_at", stream: str = "",
                    epoch: int | None = None) -> Version:
    """Latest-wins merge that keeps the rows which the watermark of :func:`windowed_latest` drops.

    The mark is the newest arrival of the batches before, less the delay, and a row is
    late once its arrival hour ends by the mark. Late rows go to the table ``late``; the others are
    merged. Both tables, the next mark and the epoch's number are one commit; its notes count
    the late rows of the batch and of all batches.
    """
    store = Store(batch.sparkSession, root)
    base = store.latest()
    if epoch_done(base, stream, epoch):
        return base
    newest = base.notes.get("newest")
    mark = (F.lit(newest).cast("timestamp_ntz") if newest else F.lit(None).cast("timestamp_ntz")) \
        - F.make_dt_interval(F.lit(0), F.lit(delay_hours))
    hour_end = hour_floor(arrival_col) + F.make_dt_interval(F.lit(0), F.lit(1))
    late = F.coalesce(hour_end <= mark, F.lit(False))
    seen = batch.agg(F.max(arrival_col).cast("string").alias("newest"),
                     F.count_if(late).alias("late")).first()
    fresh = batch.where(~late)
    touched = part_names(fresh, slot_part())
    staged = []
    if touched:
        current = store.read(LATEST, base, touched)
        rows = fresh if current is None else current.unionByName(fresh)
        staged.append(store.stage(LATEST, latest_per_key(rows), slot_part(), touched))
    if seen.late or LATE not in base.tables:
        # late rows are only ever added: a part for every batch that has some
        part = F.lit(f"{base.number + 1:020d}")
        staged.append(store.stage(LATE, batch.where(late), part, set()))
    notes = epoch_notes(base, stream, epoch)
    notes["newest"] = max(filter(None, [newest, seen.newest]), default=None)
    notes["late"] = seen.late
    notes["late_total"] = base.notes.get("late_total", 0) + seen.late
    return store.commit(staged, base, notes)


def late_sink(root: str, delay_hours: int = RETENTION_HOURS, stream: str = ""):
    def _sink(batch: DataFrame, epoch_id: int) -> None:
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            merge_with_late(held, root, delay_hours, stream=stream, epoch=epoch_id)
        finally:
            held.unpersist()
    return _sink


def run_with_late(raw_stream: DataFrame, root: str, checkpoint: str,
                  delay_hours: int = RETENTION_HOURS) -> StreamingQuery:
    return (
        raw_stream.select(*RAW_COLUMNS).writeStream
        .foreachBatch(late_sink(root, delay_hours, stream=checkpoint))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows that the state operators of a finished query dropped as late (after the reduction
    inside the batch, so rows of one key and hour may count once)."""
    return sum(op["numRowsDroppedByWatermark"] for progress in query.recentProgress
               for op in progress["stateOperators"])


def run_windowed_latest(raw_stream: DataFrame, target_path: str, checkpoint: str,
                        delay: str = f"{RETENTION_HOURS} hours") -> StreamingQuery:
    return (
        windowed_latest(raw_stream, delay).writeStream
        .outputMode("update")
        .foreachBatch(latest_wins_sink(target_path, stream=checkpoint))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
