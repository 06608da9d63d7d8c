import json

from tidemark.sources.payload import (
    parse_payload, payload_rows, read_payloads, split_documents, split_rejects,
)


def doc(**current):
    base = {"temperature": 6, "weather_descriptions": ["Mist"], "wind_speed": 9,
            "humidity": 96, "pressure": 1028}
    base.update(current)
    base = {k: v for k, v in base.items() if v is not Ellipsis}
    return json.dumps({
        "request": {"type": "City", "query": "New York", "language": "en", "unit": "m"},
        "location": {"name": "New York", "localtime": "2026-04-03 09:14", "utc_offset": "-4.0",
                     "localtime_epoch": 1775207640},
        "current": base,
    })


def rows_for(spark, docs, exact=True):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i INT, payload STRING")
    parsed = parse_payload(df, "payload")
    return payload_rows(parsed, "payload" if exact else None, keep=["i"]).orderBy("i").collect()


def test_fields_and_types(spark):
    (row,) = rows_for(spark, [doc()])
    assert row.city == "New York" and row.temperature == 6.0 and row.weather_description == "Mist"
    assert row.utc_offset == "-4.0" and row.is_forecast is False
    assert str(row.time) == "2026-04-03 09:14:00"


def test_empty_description_array_is_null(spark):
    (row,) = rows_for(spark, [doc(weather_descriptions=[])])
    assert row.weather_description is None


def test_missing_key_defaults_to_zero_and_null_stays_null_in_exact_mode(spark):
    missing, explicit_null = rows_for(spark, [doc(humidity=...), doc(humidity=None)])
    assert missing.humidity == 0.0
    assert explicit_null.humidity is None
    simple = rows_for(spark, [doc(humidity=None)], exact=False)[0]
    assert simple.humidity == 0.0


def test_missing_temperature_is_rejected(spark):
    df = spark.createDataFrame([(0, doc(temperature=...)), (1, doc())], "i INT, payload STRING")
    rows = payload_rows(parse_payload(df, "payload"), "payload", keep=["i"])
    good, bad = split_rejects(rows)
    assert [r.i for r in good.collect()] == [1]
    assert [r.i for r in bad.collect()] == [0]


def test_bulk_read_of_landed_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(doc() + "\n" + doc(temperature=7) + "\n")
    df = read_payloads(spark, str(tmp_path))
    temps = sorted(r.temperature for r in payload_rows(df).collect())
    assert temps == [6.0, 7.0]
    assert df.select("current.air_quality.`us-epa-index`").count() == 2


def test_normalize_to_utc_subtracts_offset(spark):
    df = spark.createDataFrame([(doc(),)], "payload STRING")
    parsed = parse_payload(df, "payload")
    kept = payload_rows(parsed, "payload").first()
    utc = payload_rows(parsed, "payload", normalize_to_utc=True).first()
    assert str(kept.time) == "2026-04-03 09:14:00"
    assert str(utc.time) == "2026-04-03 13:14:00"  # offset -4.0


def test_documents_are_rejected_by_absent_keys_and_keep_their_text(spark):
    docs = [doc(), doc(temperature=None), doc(weather_descriptions=None), doc(humidity=...),
            doc(temperature=...), doc(weather_descriptions=...), doc(wind_speed=...),
            doc(temperature="warm"), doc().replace("2026-04-03 09:14", "noon"), "{broken", "", None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i INT, payload STRING")
    good, bad = split_documents(parse_payload(df, "payload"), "payload")
    rows = {r.i: r for r in payload_rows(good, "payload", keep=["i"]).collect()}
    assert sorted(rows) == [0, 1, 2, 3]
    assert rows[1].temperature is None and rows[2].weather_description is None
    assert {r.i: r.payload for r in bad.collect()} == dict(list(enumerate(docs))[4:])
