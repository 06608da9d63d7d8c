"""Table schemas and the fixed values the pipeline semantics depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source pipeline's, kept in its order).
# City -> UTC offset text, winter time:
CITY_UTC_OFFSETS: list[tuple[str, str]] = [
    ("London", "+0"),
    ("New York", "-5"),
    ("Tokyo", "+9"),
    ("Paris", "+1"),
    ("Sydney", "+10"),
    ("Berlin", "+1"),
    ("Toronto", "-5"),
    ("Mumbai", "+5:30"),
    ("Dubai", "+4"),
    ("Singapore", "+8"),
]
# Weather descriptions, also the accepted values of the description check:
WEATHER_DESCRIPTIONS: list[str] = [
    "Clear", "Cloudy", "Rainy", "Snowy", "Sunny", "Foggy",
    "Windy", "Partly Cloudy", "Thunderstorm", "Drizzle", "Hail", "Sleet",
]
# Generator ranges (low, high, decimals) for forecast measures:
MEASURE_RANGES: dict[str, tuple[float, float, int]] = {
    "temperature": (-5.0, 35.0, 1),
    "humidity": (30.0, 95.0, 1),
    "pressure": (1000.0, 1025.0, 2),
    "wind_speed": (0.0, 25.0, 1),
}
# Documented ranges of the mart columns (used by the range checks):
DOCUMENTED_RANGES: dict[str, tuple[float, float]] = {
    "temperature": (-50.0, 60.0),
    "wind_speed": (0.0, 25.0),
    "humidity": (0.0, 100.0),
    "pressure": (1000.0, 1025.0),
}
# Observed rows older than this (local time vs UTC now) are dropped:
RETENTION_HOURS = 12
# Legacy staging keeps this many newest rows:
LEGACY_TOP_K = 2000
# Ad-hoc result row cap:
RESULT_ROW_CAP = 10000
# Forecast horizon of one generator run, in days:
FORECAST_DAYS_AHEAD = 7
# Names of data sets in the permission lists:
LIKE_DATASET = "[%].[%](id:%)"
# ---------------------------------------------------------------------------

CITIES: list[str] = [city for city, _ in CITY_UTC_OFFSETS]

RAW_COLUMNS = [
    "id", "city", "temperature", "weather_description", "wind_speed",
    "humidity", "pressure", "time", "inserted_at", "utc_offset", "is_forecast",
]

RAW = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("city", T.StringType(), True),
    T.StructField("temperature", T.DoubleType(), True),
    T.StructField("weather_description", T.StringType(), True),
    T.StructField("wind_speed", T.DoubleType(), True),
    T.StructField("humidity", T.DoubleType(), True),
    T.StructField("pressure", T.DoubleType(), True),
    T.StructField("time", T.TimestampNTZType(), True),
    T.StructField("inserted_at", T.TimestampNTZType(), True),
    T.StructField("utc_offset", T.StringType(), True),
    T.StructField("is_forecast", T.BooleanType(), True),
])

STAGING_COLUMNS = [
    "id", "city", "temperature", "weather_description", "wind_speed",
    "humidity", "pressure", "weather_time_utc", "weather_time_local",
    "inserted_at_local", "is_forecast",
]

REPORT_COLUMNS = [
    "id", "city", "temperature", "weather_description", "wind_speed",
    "humidity", "pressure", "weather_time_local", "weather_time_utc",
    "is_forecast",
]

DAILY_COLUMNS = [
    "city", "date", "avg_temperature", "avg_wind_speed", "avg_humidity",
    "avg_pressure", "has_forecast_data",
]

LEGACY_COLUMNS = [
    "id", "city", "temperature", "weather_description", "wind_speed",
    "weather_time_local", "inserted_at_local",
]

# The readings document as delivered by the weather service.
PAYLOAD_DDL = (
    "request STRUCT<type: STRING, query: STRING, language: STRING, unit: STRING>, "
    "location STRUCT<name: STRING, country: STRING, region: STRING, lat: STRING, "
    "lon: STRING, timezone_id: STRING, localtime: STRING, localtime_epoch: BIGINT, "
    "utc_offset: STRING>, "
    "current STRUCT<observation_time: STRING, temperature: DOUBLE, weather_code: INT, "
    "weather_icons: ARRAY<STRING>, weather_descriptions: ARRAY<STRING>, "
    "astro: STRUCT<sunrise: STRING, sunset: STRING, moonrise: STRING, moonset: STRING, "
    "moon_phase: STRING, moon_illumination: INT>, "
    "air_quality: STRUCT<co: STRING, no2: STRING, o3: STRING, so2: STRING, "
    "pm2_5: STRING, pm10: STRING, `us-epa-index`: STRING, `gb-defra-index`: STRING>, "
    "wind_speed: DOUBLE, wind_degree: INT, wind_dir: STRING, pressure: DOUBLE, "
    "precip: DOUBLE, humidity: DOUBLE, cloudcover: INT, feelslike: DOUBLE, "
    "uv_index: INT, visibility: DOUBLE, is_day: STRING>"
)
