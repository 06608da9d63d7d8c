"""Reference SQL (DuckDB dialect) for every registered query.

Written independently of the DataFrame code as plain SQL over the driver's
pre-registered views, so the two can be compared at sf0.01. The parameters of the queries are
written here again; only the fixed lists of ``schemas`` and the list of declared
checks (which column, which test) are shared.
"""

from __future__ import annotations

from tidemark.operators.quality import Check, declared_checks, range_checks
from tidemark.schemas import (
    CITY_UTC_OFFSETS, WEATHER_DESCRIPTIONS,
)

AS_OF = "2024-01-20 12:00:00"
LEGACY_TOP_K, LEGACY_SMALL_K, TOP_LATEST_K, RESULT_ROW_CAP = 2000, 100, 10, 10_000
STAR_TYPES = ["ECONOMY", "SMALL", "PROMO"]
STAR_NATIONS = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12]
BRIDGE_REGION, DISTINCT_STATUS, EQUALS_STATUS = "EUROPE", "F", "P"
IN_BRANDS = ["Brand#1", "Brand#7", "Brand#13", "Brand#22"]
KEEP_STATUSES, DROP_PRIORITIES, ALWAYS_PRIORITIES = ["O", "F"], ["1-URGENT", "2-HIGH"], ["5-LOW"]
LIKE_DATASET = "[%].[%](id:%)"
TARGET_BEFORE, INCOMING_FROM, DELETE_PRIORITY = "1999-01-01", "1998-01-01", "1-URGENT"


def _lit(v) -> str:
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def _list(values) -> str:
    return ", ".join(_lit(v) for v in values)


def rounded_mean(c: str, scale: int = 2) -> str:
    """Whole units of 1e-16 as HUGEINT, then one rounding half away from zero."""
    units = (f"CAST(CAST(CAST({c} AS VARCHAR) AS DECIMAL(21,16)) "
             "* CAST(10000000000000000 AS DECIMAL(17,0)) AS HUGEINT)")
    s, n = f"sum({units})", f"CAST(count({c}) AS HUGEINT)"
    one = 10 ** 16
    q = f"((2 * abs({s}) * {10 ** scale} + {n} * {one}) // (2 * {n} * {one}))"
    return f"CAST(CASE WHEN {s} < 0 THEN -{q} ELSE {q} END AS DOUBLE) / {10 ** scale}"


CITY_VALUES = ", ".join(f"({k}, {_lit(c)}, {_lit(o)})" for k, (c, o) in enumerate(CITY_UTC_OFFSETS))

def offset_seconds(c: str) -> str:
    """Seconds of an offset text, read by its parts; NULL unless all of it is an offset."""
    bare = f"ltrim(trim({c}), '+-')"
    hours = f"TRY_CAST(split_part({bare}, ':', 1) AS DECIMAL(18,9))"
    minutes = f"COALESCE(TRY_CAST(NULLIF(split_part({bare}, ':', 2), '') AS INTEGER), 0)"
    return (f"(CASE WHEN regexp_full_match(trim({c}), '[+-]?[0-9][0-9]?([.][0-9]+)?(:[0-5]?[0-9])?') "
            f"AND {hours} < 24 THEN (CASE WHEN starts_with(trim({c}), '-') THEN -1 ELSE 1 END) "
            f"* ({hours} * 3600 + {minutes} * 60) END)")


OFFSET_SECONDS = offset_seconds("utc_offset")

RAW_COLS = ("id, city, temperature, weather_description, wind_speed, humidity, pressure, "
            "time, inserted_at, utc_offset, is_forecast")
STG_COLS = ("id, city, temperature, weather_description, wind_speed, humidity, pressure, "
            "weather_time_utc, weather_time_local, inserted_at_local, is_forecast")
REPORT_COLS = ("id, city, temperature, weather_description, wind_speed, humidity, pressure, "
               "weather_time_local, weather_time_utc, is_forecast")


BASE = f"""
WITH city_dim(k, city, utc_offset) AS (VALUES {CITY_VALUES}),
raw AS (
  SELECT e.event_id AS id, d.city, e.value AS temperature, e.event_type AS weather_description,
         e.value / 10 AS wind_speed, e.value * 2 AS humidity, 1000 + e.value AS pressure,
         date_trunc('hour', e.ts) AS time, e.ts AS inserted_at, d.utc_offset,
         e.event_type <> 'error' AS is_forecast
  FROM events e JOIN city_dim d ON e.user_id % 10 = d.k
),
raw_off AS (SELECT *, {OFFSET_SECONDS} AS off_s FROM raw),
with_local AS (SELECT *, time + to_seconds(CAST(off_s AS DOUBLE)) AS time_local_tz FROM raw_off),
filtered AS (
  SELECT * FROM with_local
  WHERE is_forecast = TRUE
     OR (is_forecast = FALSE
         AND time_local_tz > TIMESTAMP '{AS_OF}' - INTERVAL 12 HOUR)
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY city, time
                               ORDER BY inserted_at DESC NULLS FIRST, id DESC) AS rn
  FROM filtered
),
stg AS (
  SELECT id, city, temperature, weather_description, wind_speed, humidity, pressure,
         time AS weather_time_utc, time_local_tz AS weather_time_local,
         inserted_at + to_seconds(CAST(off_s AS DOUBLE)) AS inserted_at_local, is_forecast
  FROM ranked WHERE rn = 1
),
report AS (SELECT {REPORT_COLS} FROM stg),
daily AS (
  SELECT city, CAST(weather_time_local AS DATE) AS date,
         {rounded_mean('temperature')} AS avg_temperature,
         {rounded_mean('wind_speed')} AS avg_wind_speed,
         {rounded_mean('humidity')} AS avg_humidity,
         {rounded_mean('pressure')} AS avg_pressure,
         max(CAST(is_forecast AS INTEGER)) AS has_forecast_data
  FROM stg GROUP BY 1, 2
),
starts AS (
  SELECT city, utc_offset, date_trunc('hour', max(inserted_at)) AS start
  FROM raw GROUP BY city, utc_offset
),
spine AS (
  SELECT city, utc_offset, start + to_hours(CAST(h AS BIGINT)) AS time
  FROM starts CROSS JOIN range(0, {24 * 7}) AS t(h)
),
prow AS (
  SELECT r.id, r.city, r.temperature,
         CASE WHEN e.event_type = 'error' THEN NULL ELSE e.event_type END
           AS weather_description,
         r.wind_speed,
         CASE WHEN e.event_type = 'signup' THEN 0.0 ELSE r.humidity END AS humidity,
         r.pressure, date_trunc('minute', e.ts) AS time, r.utc_offset,
         FALSE AS is_forecast
  FROM raw r JOIN events e ON r.id = e.event_id
),
target AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate < TIMESTAMP '{TARGET_BEFORE}'
),
incoming AS (
  SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 1.0 AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '{INCOMING_FROM}'
)
"""


def _legacy(k: int) -> str:
    return f"""{BASE}
SELECT id, city, temperature, weather_description, wind_speed,
       time AS weather_time_local,
       inserted_at + to_seconds(CAST(off_s AS DOUBLE)) AS inserted_at_local
FROM (SELECT *, row_number() OVER (PARTITION BY time ORDER BY inserted_at ASC NULLS LAST,
                                   id ASC) AS rn FROM raw_off)
WHERE rn = 1
ORDER BY inserted_at DESC NULLS FIRST, id DESC
LIMIT {k}"""


def _count_check_sql(idx: int, ch: Check, table: str) -> str:
    c = ch.column
    where = f"({ch.where}) AND " if ch.where else ""
    if ch.test == "not_null":
        n = f"(SELECT count(*) FROM {table} WHERE {where}{c} IS NULL)"
    elif ch.test == "in_range":
        n = (f"(SELECT count(*) FROM {table} WHERE {where}{c} IS NOT NULL "
             f"AND NOT ({c} BETWEEN {ch.low!r} AND {ch.high!r}))")
    elif ch.test == "accepted_values":
        n = (f"(SELECT count(*) FROM (SELECT {c} FROM {table} WHERE {where}{c} IS NOT NULL "
             f"AND {c} NOT IN ({_list(ch.values)}) GROUP BY {c}))")
    elif ch.test == "unique":
        n = (f"(SELECT count(*) FROM (SELECT {c} FROM {table} WHERE {where}{c} IS NOT NULL "
             f"GROUP BY {c} HAVING count(*) > 1))")
    else:
        raise ValueError(ch.test)
    return (f"SELECT CAST({idx} AS INTEGER) AS check_id, {_lit(ch.model)} AS model, "
            f"{_lit(ch.test)} AS test, {_lit(c)} AS column_name, "
            f"CAST({n} AS BIGINT) AS n_failed, {n} = 0 AS passed")


_TABLE_OF = {"weather_report": "report", "daily_average": "daily"}


def _suite(checks: list[Check], cols: str = "*") -> str:
    body = "\nUNION ALL\n".join(
        _count_check_sql(i, ch, _TABLE_OF[ch.model]) for i, ch in enumerate(checks, start=1)
    )
    return f"{BASE}\nSELECT {cols} FROM (\n{body}\n)"


def _null_counts() -> str:
    cols = [("id", False), ("city", False), ("temperature", True),
            ("weather_description", False), ("wind_speed", True), ("humidity", True),
            ("pressure", True), ("time", False), ("utc_offset", False), ("is_forecast", False)]
    parts = []
    for name, is_double in cols:
        nan = f"count(*) FILTER (WHERE isnan({name}))" if is_double else "CAST(0 AS BIGINT)"
        parts.append(f"SELECT '{name}' AS column_name, count(*) FILTER (WHERE {name} IS NULL) "
                     f"AS n_null, {nan} AS n_nan FROM prow")
    return BASE + "\n" + "\nUNION ALL\n".join(parts)


def _like_names() -> str:
    return """
SELECT c_custkey, view_name FROM (
  SELECT c.c_custkey,
         CASE WHEN c.c_acctbal >= 0
              THEN '[' || n.n_name || '].[' || c.c_mktsegment || '](id:'
                   || CAST(c.c_custkey AS VARCHAR) || ')'
              ELSE '[' || n.n_name || '](id:' || CAST(c.c_custkey AS VARCHAR) || ')'
         END AS view_name
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
) WHERE view_name LIKE """ + _lit(LIKE_DATASET)


# Arrival in three steps; of the first, every 40th id comes with the last. The mark of a step is
# the newest arrival of the steps before it, less twelve hours.
LATE_STEPS = """steps AS (
  SELECT *, CASE WHEN inserted_at < TIMESTAMP '2024-01-10' THEN CASE WHEN id % 40 = 7 THEN 3 ELSE 1 END
                 WHEN inserted_at < TIMESTAMP '2024-01-20' THEN 2 ELSE 3 END AS step
  FROM raw
), marked AS (
  SELECT s.*, (SELECT max(p.inserted_at) FROM steps p WHERE p.step < s.step) - INTERVAL 12 HOUR AS mark
  FROM steps s
)"""

ORACLE_SQL: dict[str, str] = {
    "offset_parse": f"{BASE} SELECT id, city, utc_offset, CAST(off_s AS DOUBLE) AS offset_seconds FROM raw_off",
    "local_shift": f"""{BASE}
SELECT id, city, time, time + to_seconds(CAST(off_s AS DOUBLE)) AS weather_time_local,
       inserted_at + to_seconds(CAST(off_s AS DOUBLE)) AS inserted_at_local
FROM raw_off""",
    "hour_truncate": "SELECT event_id, ts, date_trunc('hour', ts) AS hour FROM events",
    "raw_projection": f"{BASE} SELECT {RAW_COLS} FROM raw",
    "raw_wildcard": f"{BASE} SELECT {RAW_COLS}, time_local_tz FROM with_local",
    "retention_filter": f"{BASE} SELECT {RAW_COLS}, time_local_tz FROM filtered",
    "dedup_latest": f"""{BASE}
SELECT {RAW_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY city, time
                               ORDER BY inserted_at DESC NULLS FIRST, id DESC) AS rn
  FROM raw) WHERE rn = 1""",
    "dedup_first": f"""{BASE}
SELECT {RAW_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY time
                               ORDER BY inserted_at ASC NULLS LAST, id ASC) AS rn
  FROM raw) WHERE rn = 1""",
    "staging": f"{BASE} SELECT {STG_COLS} FROM stg",
    "staging_legacy": _legacy(LEGACY_TOP_K),
    "staging_legacy_top100": _legacy(LEGACY_SMALL_K),
    "report": f"{BASE} SELECT {REPORT_COLS} FROM report",
    "daily_average": f"{BASE} SELECT * FROM daily",
    "daily_flag": f"""{BASE}
SELECT city, CAST(weather_time_local AS DATE) AS date,
       max(CAST(is_forecast AS INTEGER)) AS has_forecast_data, count(*) AS n_rows
FROM stg GROUP BY 1, 2""",
    "daily_minmax": f"""{BASE}
SELECT city, CAST(weather_time_local AS DATE) AS date,
       {rounded_mean('temperature')} AS avg_temp,
       max(temperature) AS max_temp, min(temperature) AS min_temp
FROM stg GROUP BY 1, 2""",
    "top10_latest": f"""{BASE}
SELECT * FROM report ORDER BY weather_time_local DESC NULLS FIRST, id DESC
LIMIT {TOP_LATEST_K}""",
    "row_cap": f"""SELECT * FROM orders ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey ASC
LIMIT {RESULT_ROW_CAP}""",
    "daily_newest_first": f"{BASE} SELECT * FROM daily ORDER BY city, date DESC",
    "sort_mixed": f"{BASE} SELECT * FROM report ORDER BY city, weather_time_local DESC, id DESC",
    "staging_sorted": f"{BASE} SELECT {STG_COLS} FROM stg ORDER BY city, weather_time_utc",
    "dq_not_null": _null_counts(),
    "dq_unique": """
SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY 1, 2 HAVING count(*) > 1""",
    "dq_accepted": f"""{BASE}
SELECT weather_description AS value, count(*) AS n_records FROM report
WHERE weather_description IS NOT NULL
  AND weather_description NOT IN ({_list(WEATHER_DESCRIPTIONS)})
GROUP BY 1""",
    "dq_accepted_where": f"""{BASE}
SELECT avg_humidity AS value, count(*) AS n_records FROM daily
WHERE (avg_humidity >= 0 AND avg_humidity <= 100)
  AND avg_humidity IS NOT NULL AND avg_humidity NOT IN (0, 100)
GROUP BY 1""",
    "dq_range": _suite([c for c in range_checks() if c.model == "weather_report"],
                       "column_name, n_failed, passed"),
    "dq_suite": _suite(declared_checks() + range_checks()),
    "layer_counts": f"""{BASE}
SELECT 'Raw' AS layer, count(*) AS n FROM raw
UNION ALL SELECT 'Staging', count(*) FROM stg
UNION ALL SELECT 'Mart', count(*) FROM daily""",
    "hourly_spine": f"{BASE} SELECT city, utc_offset, time FROM spine",
    "hourly_spine_cities": f"""{BASE}, listed AS (
  SELECT c.city, c.utc_offset, date_trunc('hour', coalesce(
           (SELECT max(r.inserted_at) FROM raw r WHERE r.city = c.city AND r.city < 'M'),
           TIMESTAMP '2024-01-20 12:00:00')) AS start
  FROM (VALUES {CITY_VALUES}) AS c(k, city, utc_offset)
)
SELECT city, utc_offset, start + to_hours(CAST(h AS BIGINT)) AS time
FROM listed CROSS JOIN range(0, 168) AS t(h)""",
    "payload_extract": f"{BASE} SELECT * FROM prow",
    "observation_load": f"""{BASE}
, landed AS (
  SELECT p.city, CASE WHEN e.event_type = 'view' THEN NULL ELSE p.temperature END AS temperature,
         p.weather_description, p.wind_speed, p.humidity, p.pressure, p.time,
         TIMESTAMP '2024-01-20 12:00:00' AS inserted_at, p.utc_offset, FALSE AS is_forecast
  FROM prow p JOIN events e ON p.id = e.event_id
  WHERE e.event_type <> 'purchase'
)
SELECT row_number() OVER (
         ORDER BY city NULLS FIRST, time NULLS FIRST, temperature NULLS FIRST,
                  weather_description NULLS FIRST, wind_speed NULLS FIRST,
                  humidity NULLS FIRST, pressure NULLS FIRST, utc_offset NULLS FIRST) AS id,
       *
FROM landed""",
    "observation_rejects": f"""{BASE}
SELECT p.city, strftime(p.time, '%Y-%m-%d %H:%M') AS localtime
FROM prow p JOIN events e ON p.id = e.event_id
WHERE e.event_type = 'purchase'""",
    "first_element": """
SELECT vec_id, embedding[1] AS first_value, embedding[10001] AS missing_value, label
FROM embeddings""",
    "props_extract": """
SELECT event_id, CAST(props->>'k' AS INTEGER) AS k,
       COALESCE(CAST(props->>'h' AS INTEGER), 0) AS h_or_default,
       COALESCE(list_contains(json_keys(props), 'k'), FALSE) AS has_k
FROM events""",
    "surrogate_id": """
SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id
FROM orders""",
    "full_refresh_daily": f"{BASE} SELECT * FROM daily",
    "star_join_distinct": f"""
SELECT DISTINCT l.l_orderkey
FROM lineitem l
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
WHERE p.p_type IN ({_list(STAR_TYPES)}) AND s.s_nationkey IN ({_list(STAR_NATIONS)})""",
    "bridge_join_count": f"""
SELECT n.n_name, o.o_orderpriority, count(*) AS cnt
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE r.r_name = {_lit(BRIDGE_REGION)}
GROUP BY 1, 2""",
    "count_distinct_by_key": f"""
SELECT o.o_orderpriority, count(DISTINCT l.l_suppkey) AS n_suppliers
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE o.o_orderstatus = {_lit(DISTINCT_STATUS)}
GROUP BY 1""",
    "two_key_count": """
SELECT l_returnflag, l_linestatus, count(*) AS cnt FROM lineitem GROUP BY 1, 2""",
    "distinct_pairs": "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer",
    "in_list": f"""
SELECT p_partkey, p_name, p_brand FROM part WHERE p_brand IN ({_list(IN_BRANDS)})""",
    "not_in_or": f"""
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE (o_orderstatus IN ({_list(KEEP_STATUSES)})
       AND o_orderpriority NOT IN ({_list(DROP_PRIORITIES)}))
   OR o_orderpriority IN ({_list(ALWAYS_PRIORITIES)})""",
    "like_pattern": _like_names(),
    "equals_const": f"""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderstatus = {_lit(EQUALS_STATUS)}""",
    "upsert_by_key": f"""{BASE}
SELECT * FROM target t
WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM incoming""",
    "insert_if_absent": f"""{BASE}
SELECT * FROM target
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey
                                   ORDER BY o_orderkey, o_custkey, o_orderstatus, o_totalprice,
                                            o_orderdate, o_orderpriority) AS rn
      FROM incoming) i
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM target t WHERE t.o_orderkey = i.o_orderkey)""",
    "offset_parse_odd": f"""{BASE}, odd_rows AS (
  SELECT id, CASE weather_description
      WHEN 'error' THEN utc_offset || 'x'
      WHEN 'signup' THEN utc_offset || ':30:15'
      WHEN 'purchase' THEN '12345678'
      WHEN 'view' THEN ' ' || utc_offset END AS odd
  FROM raw)
SELECT id, odd, CAST({offset_seconds('odd')} AS DOUBLE) AS offset_seconds FROM odd_rows""",
    "daily_mean_fine": f"""{BASE}, fine AS (
  SELECT city, CAST(weather_time_local AS DATE) AS date, temperature / 7.0 - 3.0 AS fine FROM stg)
SELECT city, date, {rounded_mean('fine')} AS avg_fine, max(fine) AS max_fine, min(fine) AS min_fine
FROM fine GROUP BY 1, 2""",
    "observation_append": f"""{BASE}
, landed AS (
  SELECT p.city, CASE WHEN e.event_type = 'view' THEN NULL ELSE p.temperature END AS temperature,
         p.weather_description, p.wind_speed, p.humidity, p.pressure, p.time,
         TIMESTAMP '2024-01-20 12:00:00' AS inserted_at, p.utc_offset, FALSE AS is_forecast
  FROM prow p JOIN events e ON p.id = e.event_id
  WHERE e.event_type <> 'purchase'
)
SELECT row_number() OVER (
         ORDER BY city >= 'M', city NULLS FIRST, time NULLS FIRST, temperature NULLS FIRST,
                  weather_description NULLS FIRST, wind_speed NULLS FIRST,
                  humidity NULLS FIRST, pressure NULLS FIRST, utc_offset NULLS FIRST) AS id,
       *
FROM landed""",
    "table_changes": f"""{BASE}, upserted AS (
  SELECT * FROM target t
  WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i.o_orderkey = t.o_orderkey)
  UNION ALL SELECT * FROM incoming
), kept AS (
  SELECT * FROM upserted WHERE o_orderpriority IS DISTINCT FROM '1-URGENT'
)
SELECT * FROM kept
UNION ALL
SELECT o_orderkey, o_custkey, 'N' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM incoming i WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.o_orderkey = i.o_orderkey)""",
    "stream_windowed_latest": f"""{BASE}, {LATE_STEPS}
SELECT * EXCLUDE (step, mark, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY city, time
                               ORDER BY inserted_at DESC NULLS FIRST, id DESC) AS rn
  FROM marked WHERE mark IS NULL OR date_trunc('hour', inserted_at) + INTERVAL 1 HOUR > mark)
WHERE rn = 1""",
    "stream_late_rows": f"""{BASE}, {LATE_STEPS}
SELECT * EXCLUDE (step, mark) FROM marked
WHERE date_trunc('hour', inserted_at) + INTERVAL 1 HOUR <= mark""",
    "delete_by_key": f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderpriority IS DISTINCT FROM {_lit(DELETE_PRIORITY)}""",
}

# Changes committed to a table give what the plain forms give.
for _table, _plain in (("table_upsert", "upsert_by_key"), ("table_insert", "insert_if_absent"),
                       ("table_delete", "delete_by_key")):
    ORACLE_SQL[_table] = ORACLE_SQL[_plain]

# Streaming queries end in the same tables as their batch forms.
ORACLE_SQL["dedup_latest_agg"] = ORACLE_SQL["dedup_latest"]
