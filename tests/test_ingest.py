"""File ingest on generated edge-case payloads."""

import datetime as dt
import io
import json
import zipfile

from pyspark.sql import functions as F

from wattlake.sources import ingest


def _zip(path, name, text, bom=True):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr(name, ("﻿" if bom else "") + text)
    path.write_bytes(buf.getvalue())


REPORT = "\n".join(
    [
        "C,NEMP.WORLD,DISPATCHIS,AEMO",
        "I,DISPATCH,PRICE,1,SETTLEMENTDATE,REGIONID,RRP",
        "D,DISPATCH,PRICE,1,2026/01/15 10:05:00,NSW1,55.0",
        "I,DISPATCH,REGIONSUM,6,SETTLEMENTDATE,RUNNO,REGIONID,INTERVENTION,TOTALDEMAND",
        "D,DISPATCH,REGIONSUM,6,2026/01/15 10:05:00,1,NSW1,0,8000.5",
        "D,DISPATCH,REGIONSUM,6,2026-01-15 10:05:00,1,queensland ,0,6000",
        "D,DISPATCH,REGIONSUM,6,2026/01/15 10:05:00,1,SA1,0,-5",
        "D,DISPATCH,REGIONSUM,6,2026/01/15 10:05:00,1,TAS1,0,",
        "D,DISPATCH,REGIONSUM,6,2026/01/15 10:05:00,1,VIC1,0,NaN",
        "D,DISPATCH,REGIONSUM,6,2026/01/15 10:05:00,1,XXX1,0,100",
        "D,DISPATCH,REGIONSUM,6,2026/01/15 10:05:00,1,VIC1,0",
        "D,DISPATCH,INTERCONNECTOR,6,2026/01/15 10:05:00,1,VIC1,0,1",
        "F,END",
    ]
)


def test_dispatch_zip_edge_cases(spark, tmp_path):
    _zip(tmp_path / "PUBLIC_DISPATCHIS_202601151005_0000000001.zip", "a.CSV", REPORT)
    (tmp_path / "PUBLIC_DISPATCHIS_202601151010_0000000002.zip").write_bytes(b"not a zip")
    rows = ingest.read_dispatch(spark, str(tmp_path)).orderBy("region_id").collect()
    got = {r.region_id: (r.time, r.demand_mw) for r in rows}
    assert set(got) == {"NSW1", "QLD1", "VIC1"}
    # Sydney summer time is UTC+11: 10:05 local -> 23:05 the day before
    assert got["NSW1"] == (dt.datetime(2026, 1, 14, 23, 5), 8000.5)
    assert got["QLD1"][1] == 6000.0
    assert got["VIC1"][1] != got["VIC1"][1]  # NaN kept


def test_select_new_files(spark):
    names = spark.createDataFrame(
        [("PUBLIC_DISPATCHIS_202601151005_1.zip",), ("PUBLIC_DISPATCHIS_202601151010_2.zip",), ("junk.zip",)], "name string"
    )
    newest = ingest.select_new_files(names).collect()
    assert [r.name for r in newest] == ["PUBLIC_DISPATCHIS_202601151010_2.zip"]
    newer = ingest.select_new_files(names, dt.datetime(2026, 1, 14, 23, 6)).collect()
    assert [r.name for r in newer] == ["PUBLIC_DISPATCHIS_202601151010_2.zip"]
    both = ingest.select_new_files(names, dt.datetime(2026, 1, 14, 0, 0)).collect()
    assert [r.name for r in both][0].endswith("1010_2.zip") and len(both) == 2


def test_market_flatten(spark, tmp_path):
    payload = {
        "data": [
            {
                "results": [
                    {"name": "demand_NSW1", "data": [["2026-01-15T10:00:00+10:00", 7000.0], ["2026-01-15T10:05:00+10:00", None]]},
                    {"name": "demand_XYZ9", "data": [["2026-01-15T10:00:00+10:00", 1.0]]},
                    {"name": "demand_VIC1", "data": []},
                ]
            }
        ]
    }
    p = tmp_path / "m.json"
    p.write_text(json.dumps(payload))
    df = spark.read.schema(ingest.MARKET_SCHEMA).json(str(p))
    rows = ingest.flatten_market(df).orderBy("time").collect()
    assert [(r.time, r.region_id, r.demand_mw) for r in rows] == [
        (dt.datetime(2026, 1, 15, 0, 0), "NSW1", 7000.0),
        (dt.datetime(2026, 1, 15, 0, 5), "NSW1", None),
    ]


def test_weather_flatten_short_and_missing_arrays(spark, tmp_path):
    payload = {"hourly": {"time": ["2026-01-15T00:00", "2026-01-15T01:00", "2026-01-15T02:00"],
                          "temperature_2m": [20.0, 21.0], "precipitation": [0.0, 0.1, 0.2]}}
    p = tmp_path / "w.json"
    p.write_text(json.dumps(payload))
    df = spark.read.schema(ingest.weather_schema()).json(str(p))
    rows = ingest.flatten_weather(df, "QLD1", "Australia/Brisbane").orderBy("time").collect()
    assert len(rows) == 3
    assert rows[0].time == dt.datetime(2026, 1, 14, 14, 0)  # Brisbane = UTC+10
    assert rows[2].temperature_2m is None and rows[2].precipitation == 0.2
    assert rows[0].cloud_cover is None
