import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tidemark.schemas import RAW  # noqa: E402
from tidemark.session import DEFAULT_CONF, checkpoint_dir  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[*]").appName("tidemark-tests") \
        .config("spark.sql.shuffle.partitions", "8") \
        .config("spark.ui.showConsoleProgress", "false")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(session)
    yield session


def ts(text):
    return dt.datetime.fromisoformat(text) if text is not None else None


def raw_df(spark, rows):
    """Raw rows as dicts with defaults; times given as ISO strings."""
    base = dict(id=1, city="London", temperature=10.0, weather_description="Clear",
                wind_speed=5.0, humidity=50.0, pressure=1010.0, time="2026-01-01 00:00:00",
                inserted_at="2026-01-01 00:00:00", utc_offset="+0", is_forecast=True)
    out = []
    for r in rows:
        d = {**base, **r}
        d["time"] = ts(d["time"])
        d["inserted_at"] = ts(d["inserted_at"])
        out.append(tuple(d[f.name] for f in RAW.fields))
    return spark.createDataFrame(out, RAW)
