"""Registered queries: one per operator family, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (or data Spark derives from them) in
full. Parameters that are part of a query's meaning (``AS_OF``, list values,
slice dates) are fixed here and mirrored by the oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timeshift import hour_floor, offset_seconds, shift_by_seconds
from tidemark.operators import quality as dq
from tidemark.operators import relational as rel
from tidemark.operators.dedup import first_per_key, latest_by_aggregate, latest_per_key
from tidemark.operators.retention import retain
from tidemark.operators.rollup import count_rows, daily_min_max
from tidemark.plans.marts import daily_average, daily_sorted, report, report_sorted
from tidemark.plans.runs import (
    append_observations,
    forecast_slots,
    load_observations,
    read_model,
    refresh,
)
from tidemark.plans.staging import legacy_staging, staging, staging_sorted, with_local_time
from tidemark.schemas import (
    DAILY_COLUMNS, LEGACY_TOP_K, LIKE_DATASET, RESULT_ROW_CAP, WEATHER_DESCRIPTIONS,
)
from tidemark.session import checkpoint_dir, scratch_path
from tidemark.sources.ids import assign_ids
from tidemark.sources.keyed import KeyedTable
from tidemark.sources.ledger import RawTable
from tidemark.sources.payload import parse_payload, payload_rows
from tidemark.sources.raw import city_dim, observations, read_table, scan_raw, scan_wildcard
from tidemark.sources.tables import (
    delete_where_equal, insert_if_absent, upsert,
)

# Query parameters (mirrored in the oracle SQL).
AS_OF = "2024-01-20 12:00:00"
EARLIER_AS_OF = "2024-01-10 12:00:00"
LEGACY_SMALL_K = 100
TOP_LATEST_K = 10
STAR_TYPES = ("ECONOMY", "SMALL", "PROMO")
STAR_NATIONS = (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12)
BRIDGE_REGION = "EUROPE"
DISTINCT_STATUS = "F"
IN_BRANDS = ("Brand#1", "Brand#7", "Brand#13", "Brand#22")
KEEP_STATUSES = ("O", "F")
DROP_PRIORITIES = ("1-URGENT", "2-HIGH")
ALWAYS_PRIORITIES = ("5-LOW",)
EQUALS_STATUS = "P"
TARGET_BEFORE = "1999-01-01"
INCOMING_FROM = "1998-01-01"
DELETE_PRIORITY = "1-URGENT"


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


def _raw(spark, sf):
    return observations(spark, sf)


def _stg(spark, sf):
    return staging(_raw(spark, sf), as_of=AS_OF)


# -- step 1: offsets, shifts, scans ------------------------------------------

def q_offset_parse(spark, sf):
    raw = _raw(spark, sf)
    return raw.select("id", "city", "utc_offset",
                      offset_seconds("utc_offset").cast("double").alias("offset_seconds"))


def q_offset_parse_odd(spark, sf):
    """Offsets of every event, spoilt in a way that depends on its type."""
    kind, offset = F.col("weather_description"), F.col("utc_offset")
    odd = (F.when(kind == "error", F.concat(offset, F.lit("x")))
           .when(kind == "signup", F.concat(offset, F.lit(":30:15")))
           .when(kind == "purchase", F.lit("12345678"))
           .when(kind == "view", F.concat(F.lit(" "), offset)))
    raw = _raw(spark, sf).withColumn("odd", odd)
    return raw.select("id", "odd", offset_seconds("odd").cast("double").alias("offset_seconds"))


def q_daily_mean_fine(spark, sf):
    """Daily means of a measure with many decimals."""
    stg = _stg(spark, sf).withColumn("fine", F.col("temperature") / F.lit(7.0) - F.lit(3.0))
    return daily_min_max(stg, measure="fine", prefix="fine")


def q_local_shift(spark, sf):
    local = with_local_time(_raw(spark, sf))
    return local.select(
        "id", "city", "time",
        F.col("time_local_tz").alias("weather_time_local"),
        shift_by_seconds("inserted_at", "_offset_s").alias("inserted_at_local"),
    )


def q_hour_truncate(spark, sf):
    ev = _t(spark, sf, "events")
    return ev.select("event_id", "ts", hour_floor("ts").alias("hour"))


def q_raw_projection(spark, sf):
    return scan_raw(_raw(spark, sf))


def q_raw_wildcard(spark, sf):
    local = with_local_time(scan_wildcard(_raw(spark, sf)))
    return local.drop("_offset_s")


# -- step 2: retention, dedup, staging ----------------------------------------

def q_retention_filter(spark, sf):
    return retain(with_local_time(_raw(spark, sf)), as_of=AS_OF).drop("_offset_s")


def q_dedup_latest(spark, sf):
    return latest_per_key(_raw(spark, sf), ["city", "time"], "inserted_at", "id")


def q_dedup_latest_agg(spark, sf):
    return latest_by_aggregate(_raw(spark, sf), ["city", "time"], "inserted_at", "id")


def q_dedup_first(spark, sf):
    return first_per_key(_raw(spark, sf), ["time"], "inserted_at", "id")


def q_staging(spark, sf):
    return _stg(spark, sf)


def q_staging_legacy(spark, sf):
    return legacy_staging(_raw(spark, sf), LEGACY_TOP_K)


def q_staging_legacy_top100(spark, sf):
    return legacy_staging(_raw(spark, sf), LEGACY_SMALL_K)


# -- step 3: marts, sorts, limits -----------------------------------------------

def q_report(spark, sf):
    return report(_stg(spark, sf))


def q_daily_average(spark, sf):
    return daily_average(_stg(spark, sf))


def q_daily_flag(spark, sf):
    stg = _stg(spark, sf)
    return stg.groupBy("city", F.to_date("weather_time_local").alias("date")).agg(
        F.max(F.col("is_forecast").cast("int")).alias("has_forecast_data"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def q_daily_minmax(spark, sf):
    return daily_min_max(_stg(spark, sf))


def q_top10_latest(spark, sf):
    return rel.top_k(report(_stg(spark, sf)),
                     [("weather_time_local", "desc"), ("id", "desc")], TOP_LATEST_K)


def q_row_cap(spark, sf):
    return rel.row_cap(_t(spark, sf, "orders"),
                       [("o_orderdate", "desc"), ("o_orderkey", "asc")], RESULT_ROW_CAP)


def q_daily_newest_first(spark, sf):
    return daily_sorted(daily_average(_stg(spark, sf)))


def q_sort_mixed(spark, sf):
    return report_sorted(report(_stg(spark, sf)))


def q_staging_sorted(spark, sf):
    return staging_sorted(_stg(spark, sf))


# -- step 4: data quality -----------------------------------------------------------

def q_dq_not_null(spark, sf):
    return dq.null_counts(_payload_rows(spark, sf))


def q_dq_unique(spark, sf):
    return dq.unique_failures(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_dq_accepted(spark, sf):
    return dq.accepted_failures(report(_stg(spark, sf)), "weather_description",
                                WEATHER_DESCRIPTIONS)


def q_dq_accepted_where(spark, sf):
    return dq.accepted_failures(daily_average(_stg(spark, sf)), "avg_humidity", (0, 100),
                                where="avg_humidity >= 0 AND avg_humidity <= 100")


def q_dq_range(spark, sf):
    rep = report(_stg(spark, sf))
    checks = [c for c in dq.range_checks() if c.model == "weather_report"]
    return dq.run_suite(spark, {"weather_report": rep}, checks).select(
        "column_name", "n_failed", "passed")


def _stg_materialised(spark, sf):
    """Staging computed once and checkpointed to the shared folder, for
    queries that read it several times."""
    checkpoint_dir(spark)
    return _stg(spark, sf).checkpoint(eager=True)


def q_dq_suite(spark, sf):
    stg = _stg_materialised(spark, sf)
    models = {"weather_report": report(stg), "daily_average": daily_average(stg)}
    return dq.run_suite(spark, models, dq.declared_checks() + dq.range_checks())


def q_layer_counts(spark, sf):
    raw = _raw(spark, sf)
    stg = _stg_materialised(spark, sf)
    layers = [("Raw", raw), ("Staging", stg), ("Mart", daily_average(stg))]
    out = None
    for name, df in layers:
        part = count_rows(df, "n").select(F.lit(name).alias("layer"), "n")
        out = part if out is None else out.unionByName(part)
    return out


# -- step 5: spine, payloads, ids --------------------------------------------------

def q_hourly_spine(spark, sf):
    return forecast_slots(_raw(spark, sf))


def q_hourly_spine_cities(spark, sf):
    """Slots of every listed city; those without readings start from ``AS_OF``."""
    raw = _raw(spark, sf).where(F.col("city") < "M")
    return forecast_slots(raw, cities=city_dim(spark), as_of=AS_OF)


def _payload_docs(spark, sf) -> DataFrame:
    """Reading documents rendered from the observation rows (error events
    carry no description, signup events omit the humidity key)."""
    raw = _raw(spark, sf)
    kind = F.col("weather_description")
    doc = F.to_json(F.struct(
        F.struct(
            F.col("city").alias("name"),
            F.date_format("inserted_at", "yyyy-MM-dd HH:mm").alias("localtime"),
            F.col("utc_offset"),
        ).alias("location"),
        F.struct(
            F.col("temperature"),
            F.when(kind == "error", F.array().cast("array<string>"))
            .otherwise(F.array(kind)).alias("weather_descriptions"),
            F.col("wind_speed"),
            F.when(kind != "signup", F.col("humidity")).alias("humidity"),
            F.col("pressure"),
        ).alias("current"),
    ))
    return raw.select(F.col("id"), doc.alias("payload"))


def _payload_rows(spark, sf) -> DataFrame:
    """The rendered documents parsed back and flattened (exact missing-key mode)."""
    docs = _payload_docs(spark, sf)
    parsed = parse_payload(docs, "payload")
    return payload_rows(parsed, text_col="payload", keep=["id"])


def q_payload_extract(spark, sf):
    return _payload_rows(spark, sf)


def _landed_docs(spark, sf) -> DataFrame:
    """The rendered documents, landed as lines of text and parsed. View events hold a
    ``null`` temperature, purchase events lack the descriptions."""
    raw = _raw(spark, sf).select("id", F.col("weather_description").alias("kind"))
    text = F.col("payload")
    text = F.when(F.col("kind") == "view",
                  F.regexp_replace(text, r'"temperature":[^,}]+', '"temperature":null')) \
        .when(F.col("kind") == "purchase",
              F.regexp_replace(text, r'"weather_descriptions":\[[^\]]*\],', "")) \
        .otherwise(text)
    docs = _payload_docs(spark, sf).join(raw, "id")
    landing = scratch_path(spark, "landing-documents")
    docs.select(text.alias("value")).write.text(landing)
    return parse_payload(spark.read.text(landing), "value")


def q_observation_load(spark, sf):
    """Raw rows of the landed documents that are accepted."""
    return load_observations(_landed_docs(spark, sf), 0, "value", inserted_at=AS_OF)[0]


def q_observation_rejects(spark, sf):
    """City and local time of rejected documents, read again from the text they keep."""
    bad = load_observations(_landed_docs(spark, sf), 0, "value", inserted_at=AS_OF)[1]
    return bad.select(F.get_json_object("value", "$.location.name").alias("city"),
                      F.get_json_object("value", "$.location.localtime").alias("localtime"))


def q_first_element(spark, sf):
    emb = _t(spark, sf, "embeddings")
    return emb.select("vec_id", F.get("embedding", 0).alias("first_value"),
                      F.get("embedding", 10_000).alias("missing_value"), "label")


def q_props_extract(spark, sf):
    ev = _t(spark, sf, "events")
    parsed = F.from_json("props", "k INT, h INT")
    return ev.select(
        "event_id",
        parsed["k"].alias("k"),
        F.coalesce(parsed["h"], F.lit(0)).alias("h_or_default"),
        F.coalesce(F.array_contains(F.json_object_keys("props"), F.lit("k")),
                   F.lit(False)).alias("has_k"),
    )


def q_surrogate_id(spark, sf):
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return assign_ids(orders, ["o_orderdate", "o_orderkey"], "id", base=0)


def q_full_refresh_daily(spark, sf):
    """Two full refreshes into one place; the daily table holds the second one's days only."""
    out = scratch_path(spark, "refresh")
    refresh(spark, _raw(spark, sf), out, as_of=EARLIER_AS_OF)
    refresh(spark, _raw(spark, sf), out, as_of=AS_OF)
    return read_model(spark, out, "daily_average").select(*DAILY_COLUMNS)


# -- step 6: relational shapes ---------------------------------------------------------

def q_star_join_distinct(spark, sf):
    """DISTINCT fact keys whose part and supplier pass the list filters.

    Only fact columns are returned, so the dimension joins are semi joins: a
    fact row is never duplicated, and the filtered key sets are small enough
    for the planner's broadcast size check at most scales."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    part = rel.in_list(_t(spark, sf, "part"), "p_type", STAR_TYPES).select("p_partkey")
    supp = rel.in_list(_t(spark, sf, "supplier"), "s_nationkey", STAR_NATIONS).select("s_suppkey")
    joined = (li.join(part, li["l_partkey"] == part["p_partkey"], "left_semi")
                .join(supp, li["l_suppkey"] == supp["s_suppkey"], "left_semi"))
    return joined.select("l_orderkey").distinct()


def q_bridge_join_count(spark, sf):
    """Rows per (nation, priority) through a five-table chain.

    The region filter runs first and narrows customers and, by a semi join, orders; the
    fact table is collapsed to one row per order before it joins."""
    region = rel.equals(_t(spark, sf, "region"), "r_name", BRIDGE_REGION).select("r_regionkey")
    nation = _t(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    nation = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    cust = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    cust = cust.join(nation, cust["c_nationkey"] == nation["n_nationkey"]) \
        .select("c_custkey", "n_name")
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    orders = orders.join(cust, orders["o_custkey"] == cust["c_custkey"]) \
        .select("o_orderkey", "o_orderpriority", "n_name")
    per_order = rel.pre_count(_t(spark, sf, "lineitem"), "l_orderkey", "_n")
    joined = per_order.join(orders, per_order["l_orderkey"] == orders["o_orderkey"])
    return joined.groupBy("n_name", "o_orderpriority").agg(F.sum("_n").alias("cnt"))


def q_count_distinct_by_key(spark, sf):
    orders = rel.equals(_t(spark, sf, "orders"), "o_orderstatus", DISTINCT_STATUS) \
        .select("o_orderkey", "o_orderpriority")
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    joined = orders.join(li, orders["o_orderkey"] == li["l_orderkey"])
    return rel.count_distinct_by(joined, ["o_orderpriority"], "l_suppkey", "n_suppliers")


def q_two_key_count(spark, sf):
    return rel.count_by(_t(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "cnt")


def q_distinct_pairs(spark, sf):
    return _t(spark, sf, "customer").select("c_nationkey", "c_mktsegment").distinct()


def q_in_list(spark, sf):
    return rel.in_list(_t(spark, sf, "part"), "p_brand", IN_BRANDS) \
        .select("p_partkey", "p_name", "p_brand")


def q_not_in_or(spark, sf):
    o = _t(spark, sf, "orders")
    cond = ((F.col("o_orderstatus").isin(list(KEEP_STATUSES))
             & rel.not_in_list("o_orderpriority", DROP_PRIORITIES))
            | F.col("o_orderpriority").isin(list(ALWAYS_PRIORITIES)))
    return o.filter(cond).select("o_orderkey", "o_orderstatus", "o_orderpriority")


def q_like_pattern(spark, sf):
    cust = _t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment",
                                            "c_acctbal")
    nation = _t(spark, sf, "nation").select("n_nationkey", "n_name")
    named = cust.join(nation, cust["c_nationkey"] == nation["n_nationkey"]).select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0,
               F.concat(F.lit("["), F.col("n_name"), F.lit("].["), F.col("c_mktsegment"),
                        F.lit("](id:"), F.col("c_custkey").cast("string"), F.lit(")")))
        .otherwise(F.concat(F.lit("["), F.col("n_name"), F.lit("](id:"),
                            F.col("c_custkey").cast("string"), F.lit(")")))
        .alias("view_name"),
    )
    return rel.like(named, "view_name", LIKE_DATASET)


def q_equals_const(spark, sf):
    return rel.equals(_t(spark, sf, "orders"), "o_orderstatus", EQUALS_STATUS) \
        .select("o_orderkey", "o_custkey", "o_totalprice")


def _order_slices(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                        "o_totalprice", "o_orderdate", "o_orderpriority")
    target = o.filter(F.col("o_orderdate") < F.lit(TARGET_BEFORE).cast("timestamp_ntz"))
    incoming = o.filter(F.col("o_orderdate") >= F.lit(INCOMING_FROM).cast("timestamp_ntz")) \
        .withColumn("o_orderstatus", F.lit("U")) \
        .withColumn("o_totalprice", F.col("o_totalprice") + F.lit(1.0))
    return target, incoming


def q_upsert_by_key(spark, sf):
    target, incoming = _order_slices(spark, sf)
    return upsert(target, incoming, ["o_orderkey"])


def q_insert_if_absent(spark, sf):
    target, incoming = _order_slices(spark, sf)
    return insert_if_absent(target, incoming, ["o_orderkey"])


def q_delete_by_key(spark, sf):
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                            "o_totalprice", "o_orderdate", "o_orderpriority")
    return delete_where_equal(orders, "o_orderpriority", DELETE_PRIORITY)


def _keyed_orders(spark, sf, df) -> KeyedTable:
    table = KeyedTable(spark, scratch_path(spark, "orders-table"), ["o_orderkey"])
    table.create(df)
    return table


def q_table_upsert(spark, sf):
    """``upsert_by_key`` as a commit on a bucketed table."""
    target, incoming = _order_slices(spark, sf)
    table = _keyed_orders(spark, sf, target)
    table.upsert(incoming)
    return table.read()


def q_table_insert(spark, sf):
    """``insert_if_absent`` as a commit on a bucketed table."""
    target, incoming = _order_slices(spark, sf)
    table = _keyed_orders(spark, sf, target)
    table.insert_if_absent(incoming)
    return table.read()


def q_table_delete(spark, sf):
    """``delete_by_key`` as a commit on a bucketed table."""
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                            "o_totalprice", "o_orderdate", "o_orderpriority")
    table = _keyed_orders(spark, sf, orders)
    table.delete_where("o_orderpriority", DELETE_PRIORITY)
    return table.read()


def q_table_changes(spark, sf):
    """One table after an upsert, a delete, an insert of the upserted rows and a compaction:
    the deleted ones among them come back."""
    target, incoming = _order_slices(spark, sf)
    table = _keyed_orders(spark, sf, target)
    table.upsert(incoming)
    table.delete_where("o_orderpriority", DELETE_PRIORITY)
    table.insert_if_absent(incoming.withColumn("o_orderstatus", F.lit("N")))
    table.compact(least=3)
    return table.read()


def q_observation_append(spark, sf):
    """Two batches of landed documents appended to one raw table. Both reserve ids from the
    same state; the second one is sent twice."""
    docs = _landed_docs(spark, sf)
    table = RawTable(spark, scratch_path(spark, "raw-table"))
    west = F.col("location.name") < "M"
    for batch, chosen in (("west", west), ("east", ~west), ("east", ~west)):
        append_observations(table, batch, docs.where(chosen), "value", inserted_at=AS_OF)
    return table.read()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "offset_parse": q_offset_parse,
    "offset_parse_odd": q_offset_parse_odd,
    "daily_mean_fine": q_daily_mean_fine,
    "local_shift": q_local_shift,
    "hour_truncate": q_hour_truncate,
    "raw_projection": q_raw_projection,
    "raw_wildcard": q_raw_wildcard,
    "retention_filter": q_retention_filter,
    "dedup_latest": q_dedup_latest,
    "dedup_latest_agg": q_dedup_latest_agg,
    "dedup_first": q_dedup_first,
    "staging": q_staging,
    "staging_legacy": q_staging_legacy,
    "staging_legacy_top100": q_staging_legacy_top100,
    "report": q_report,
    "daily_average": q_daily_average,
    "daily_flag": q_daily_flag,
    "daily_minmax": q_daily_minmax,
    "top10_latest": q_top10_latest,
    "row_cap": q_row_cap,
    "daily_newest_first": q_daily_newest_first,
    "sort_mixed": q_sort_mixed,
    "staging_sorted": q_staging_sorted,
    "dq_not_null": q_dq_not_null,
    "dq_unique": q_dq_unique,
    "dq_accepted": q_dq_accepted,
    "dq_accepted_where": q_dq_accepted_where,
    "dq_range": q_dq_range,
    "dq_suite": q_dq_suite,
    "layer_counts": q_layer_counts,
    "hourly_spine": q_hourly_spine,
    "hourly_spine_cities": q_hourly_spine_cities,
    "payload_extract": q_payload_extract,
    "observation_load": q_observation_load,
    "observation_rejects": q_observation_rejects,
    "first_element": q_first_element,
    "props_extract": q_props_extract,
    "surrogate_id": q_surrogate_id,
    "full_refresh_daily": q_full_refresh_daily,
    "star_join_distinct": q_star_join_distinct,
    "bridge_join_count": q_bridge_join_count,
    "count_distinct_by_key": q_count_distinct_by_key,
    "two_key_count": q_two_key_count,
    "distinct_pairs": q_distinct_pairs,
    "in_list": q_in_list,
    "not_in_or": q_not_in_or,
    "like_pattern": q_like_pattern,
    "equals_const": q_equals_const,
    "upsert_by_key": q_upsert_by_key,
    "insert_if_absent": q_insert_if_absent,
    "delete_by_key": q_delete_by_key,
    "table_upsert": q_table_upsert,
    "table_insert": q_table_insert,
    "table_delete": q_table_delete,
    "table_changes": q_table_changes,
    "observation_append": q_observation_append,
}
