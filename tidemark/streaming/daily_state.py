"""Daily rollup kept by additive state: every run touches what changed and nothing else.

The store holds two tables that are committed together (see ``sources.versions``):

* ``retained``, by slot date: per (city, time) the rows that are or may become the visible one.
  The visible row is the latest of those not expired. An older row is kept only while it outlives
  all newer ones (a forecast never expires, so it comes back when the observation that
  hid it expires); all others can never be visible again.
* ``daily``, by local date: per (city, date) the exact sums and counts of the visible rows
  (``functions.means``), from which the means are read off.

A run merges a batch, expires rows against its ``as_of``, and compares the visible rows before
and after. Rows that became visible add to the sums of their day, rows that ceased to be
take theirs back; no other row of the day is read. The manifest keeps for every slot date when its
next row expires, which is the index that expiry goes by: slot dates without new rows
and without due rows aren't opened.

``as_of`` must not go back from run to run. Both tables, and the number of the epoch, come into
force in one commit, so a run stopped at any step leaves the version before it, and a replayed
epoch either finds itself done or starts from that version.
"""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.means import mean_of_sums_sql, sum_columns
from tidemark.functions.timeshift import shift_by_seconds
from tidemark.operators.dedup import latest_by_aggregate
from tidemark.operators.retention import cutoff, retain
from tidemark.plans.marts import daily_average
from tidemark.plans.staging import with_local_time
from tidemark.schemas import DAILY_COLUMNS, RAW_COLUMNS, RETENTION_HOURS, STAGING_COLUMNS
from tidemark.session import checkpoint_dir
from tidemark.sources.versions import Store, Version, part_name

RETAINED, DAILY = "retained", "daily"
KEYS = ["city", "time"]
MEASURES = {"temperature": "avg_temperature", "wind_speed": "avg_wind_speed",
            "humidity": "avg_humidity", "pressure": "avg_pressure"}
NEVER = "9999-12-31 00:00:00"
TIME_FORMAT = "%Y-%m-%d %H:%M:%S.%f"
STATE_TYPES = {"whole": "decimal(38,0)", "part": "decimal(38,16)", "n": "long", "odd": "long"}


def slot_part(time_col: str = "time"):
    return part_name(F.to_date(F.col(time_col)))


def part_names(df: DataFrame, col) -> set[str]:
    """Distinct part names of ``df``: as many as there are dates."""
    return {r[0] for r in df.select(col).distinct().collect()}


def epoch_done(version: Version, stream: str, epoch: int | None) -> bool:
    return epoch is not None and version.notes.get("epochs", {}).get(stream, -1) >= epoch


def epoch_notes(version: Version, stream: str, epoch: int | None) -> dict:
    epochs = dict(version.notes.get("epochs", {}))
    if epoch is not None:
        epochs[stream] = epoch
    return {**version.notes, "epochs": epochs}


def _with_expiry(df: DataFrame) -> DataFrame:
    """``_local`` (local slot time) and ``_until``: the row is kept while the cutoff is earlier."""
    local = with_local_time(df)
    never = F.lit(NEVER).cast("timestamp_ntz")
    return local.withColumn("_until", F.when(F.col("is_forecast"), never)
                            .otherwise(F.col("time_local_tz"))) \
        .withColumnRenamed("time_local_tz", "_local")


def _changes(current: DataFrame | None, batch: DataFrame, limit) -> DataFrame:
    """Rows of the touched slots with ``_keep`` (stays in the table), ``_was`` and ``_is``
    (visible before and after)."""
    # Of rows that expire together only the newest can ever be visible: reduced map-side, so that
    # a slot with very many rows arrives as a few.
    new = latest_by_aggregate(batch, [*KEYS, "_until"])
    rows = new.withColumn("_old", F.lit(False))
    if current is not None:
        rows = rows.unionByName(current.withColumn("_old", F.lit(True)))
    order = [F.col("inserted_at").desc_nulls_first(), F.col("id").desc_nulls_last(),
             F.col("_old").desc()]
    upto = Window.partitionBy(*KEYS).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    alive = F.col("_until") > limit
    return rows.withColumn("_alive", alive).select(
        *rows.columns,
        (F.col("_old") & (F.sum(F.col("_old").cast("int")).over(upto) == 1)).alias("_was"),
        (F.col("_alive") & (F.sum(F.col("_alive").cast("int")).over(upto) == 1)).alias("_is"),
        (F.col("_alive") & (F.col("_until") > F.coalesce(
            F.max(F.when(F.col("_alive"), F.col("_until"))).over(before),
            F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")))).alias("_keep"))


def _state_columns() -> list[str]:
    return [f"{m}_{k}" for m in MEASURES for k in STATE_TYPES]


def day_state(rows: DataFrame, sign: str) -> DataFrame:
    """(city, date, _part, state...) summed over rows with ``_local`` and a sign."""
    aggs = [F.expr(sql).cast(STATE_TYPES[k]).alias(f"{m}_{k}")
            for m in MEASURES for k, sql in sum_columns(m, sign).items()]
    flag = F.coalesce(F.sum(F.col("is_forecast").cast("int") * F.col(sign)), F.lit(0))
    return rows.groupBy("city", F.to_date("_local").alias("date")).agg(
        *aggs, flag.cast("long").alias("flags"), F.sum(sign).cast("long").alias("rows"))


def merged_state(old: DataFrame | None, delta: DataFrame) -> DataFrame:
    """Sum of states; days without rows go."""
    both = delta if old is None else old.unionByName(delta)
    sums = [F.sum(c).cast(STATE_TYPES[c.rpartition("_")[2]]).alias(c) for c in _state_columns()]
    return both.groupBy("city", "date").agg(
        *sums, F.sum("flags").alias("flags"), F.sum("rows").alias("rows")).where("rows > 0")


def run_batch(batch: DataFrame, root: str, as_of, hours: int = RETENTION_HOURS,
              stream: str = "", epoch: int | None = None) -> Version:
    """Merge one batch of raw rows and expire rows against ``as_of``; returns the version."""
    spark = batch.sparkSession
    checkpoint_dir(spark)
    store = Store(spark, root)
    base = store.latest()
    if epoch_done(base, stream, epoch):
        return base
    edge = spark.range(1).select(cutoff(batch, as_of, hours).alias("l")).first().l
    before = base.notes.get("cutoff")
    if before and edge < dt.datetime.strptime(before, TIME_FORMAT):
        raise ValueError(f"as_of went back: rows up to {before} are gone")
    kept = retain(_with_expiry(batch.select(*RAW_COLUMNS)), hours=hours, local_col="_local",
                  as_of=edge + dt.timedelta(hours=hours))
    due = {name for name, p in base.parts(RETAINED).items()
           if p.get("next") and dt.datetime.strptime(p["next"], TIME_FORMAT) <= edge}
    touched = part_names(kept, slot_part()) | due
    notes = {**epoch_notes(base, stream, epoch), "cutoff": edge.strftime(TIME_FORMAT)}
    if not touched:
        return store.commit([], base, notes)
    current = store.read(RETAINED, base, touched)
    rows = _changes(current, kept, F.lit(edge)).checkpoint(eager=True)
    staged = store.stage(RETAINED, rows.where("_keep").drop("_old", "_was", "_is", "_keep"),
                         slot_part(), touched)
    # one row per touched slot date
    nexts = rows.where("_keep and not is_forecast").groupBy(slot_part().alias("p")) \
        .agg(F.min("_until").alias("u")).collect()
    for r in nexts:
        staged.parts[r.p]["next"] = r.u.strftime(TIME_FORMAT)
    changed = rows.where("_was != _is").withColumn(
        "_sign", F.when(F.col("_is"), F.lit(1)).otherwise(F.lit(-1)))
    delta = day_state(changed, "_sign").checkpoint(eager=True)
    days = part_names(delta, part_name(F.col("date")))
    out = [staged]
    if days or DAILY not in base.tables:
        state = merged_state(store.read(DAILY, base, days), delta)
        out.append(store.stage(DAILY, state, part_name(F.col("date")), days))
    return store.commit(out, base, notes)


def visible(store: Store, version: Version | None = None) -> DataFrame | None:
    """The staging rows of a version."""
    retained = store.read(RETAINED, version)
    if retained is None:
        return None
    latest = latest_by_aggregate(retained, KEYS)
    return latest.select(
        "id", "city", "temperature", "weather_description", "wind_speed", "humidity", "pressure",
        F.col("time").alias("weather_time_utc"), F.col("_local").alias("weather_time_local"),
        shift_by_seconds("inserted_at", "_offset_s").alias("inserted_at_local"), "is_forecast",
    ).select(*STAGING_COLUMNS)


def read_daily(spark: SparkSession, root: str, version: Version | None = None) -> DataFrame | None:
    """The daily rollup of a version, as ``plans.marts.daily_average`` gives it."""
    store = Store(spark, root)
    version = version or store.latest()
    state = store.read(DAILY, version)
    if state is None:
        return None
    means = [F.expr(mean_of_sums_sql(f"{m}_whole", f"{m}_part", f"{m}_n")).alias(dst)
             for m, dst in MEASURES.items()]
    flag = F.when(F.col("flags") > 0, F.lit(1)).otherwise(F.lit(0)).alias("has_forecast_data")
    odd = " + ".join(f"{m}_odd" for m in MEASURES) + " > 0"
    daily = state.where(f"not ({odd})").select("city", "date", *means, flag).select(*DAILY_COLUMNS)
    strange = state.where(odd).select(F.col("city").alias("_c"), F.col("date").alias("_d"))
    if strange.isEmpty():
        return daily
    # NaN, infinities and values beyond the exact rule have no sums: such days are averaged anew
    again = daily_average(visible(store, version))
    return daily.unionByName(again.join(strange, again["city"].eqNullSafe(F.col("_c"))
                                        & again["date"].eqNullSafe(F.col("_d")), "left_semi")
                             .select(*DAILY_COLUMNS))


def daily_sink(root: str, as_of, hours: int = RETENTION_HOURS, stream: str = ""):
    """``foreachBatch`` function of :func:`run_batch`; ``stream`` names the query whose epoch
    numbers count."""
    def _sink(batch: DataFrame, epoch_id: int) -> None:
        # kept in memory or on disk, so that the actions of a run don't read its files again
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            run_batch(held, root, as_of, hours, stream, epoch_id)
        finally:
            held.unpersist()
    return _sink
