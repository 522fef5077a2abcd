"""Stops and restarts: polls, backfills, streams; bounded zip lines; metrics sketches; global order."""

import datetime as dt
import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from wattlake.operators import incremental as INC
from wattlake.operators.ordering import with_position
from wattlake.sources import ingest, sinks
from wattlake.streaming.harness import run_with_stops
from wattlake.streaming.polling import PollSource

T0 = dt.datetime(2024, 1, 1)
DEMAND = "time timestamp_ntz, region_id string, demand_mw double"
KEYS = ["time", "region_id"]


def _zip(text: bytes) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("r.csv", text)
    return out.getvalue()


def test_zip_lines_come_in_bounded_batches_and_broken_files_give_none():
    import pyarrow as pa

    long = "".join(f"D,a,{i}\n" for i in range(10_000)).encode()
    files = {"long": _zip(long), "bom": _zip("﻿I,x\r\n\r\nD,\"q,r\"\n".encode()), "cut": _zip(long)[:900], "none": None,
             "empty": _zip(b""), "late": _zip(long + b"\xff\n"), "no member": b"PK\x05\x06" + bytes(18)}
    batch = pa.RecordBatch.from_pydict({"path": list(files), "content": pa.array(files.values(), pa.binary())})
    out = list(ingest._unzip_lines(iter([batch])))
    assert max(b.num_rows for b in out) == ingest.LINES
    rows = [r for b in out for r in b.to_pylist()]
    assert [r["pos"] for r in rows if r["file"] == "long"] == list(range(10_000))
    assert [(r["pos"], r["fields"]) for r in rows if r["file"] == "bom"] == [(0, ["I", "x"]), (2, ["D", "q,r"])]
    assert {r["file"]: r["error"].split(":")[0] for r in rows if r["error"]} == {
        "cut": "BadZipFile", "none": "BadZipFile", "late": "UnicodeDecodeError", "no member": "IndexError"}
    assert not [r for r in rows if r["file"] in ("late", "cut") and r["fields"]] and not [r for r in rows if r["file"] == "empty"]


def test_backfill_goes_on_from_its_ledger(spark, tmp_path):
    rows = spark.createDataFrame([(T0 + dt.timedelta(hours=7 * i), "NSW1", float(i)) for i in range(120)], DEMAND)
    end = T0 + dt.timedelta(days=36)
    asked = []

    def load(a, b, broken=None):
        asked.append((a, b))
        if broken == len(asked):
            raise RuntimeError("gone")
        return rows.where((F.col("time") >= F.lit(a).cast("timestamp_ntz")) & (F.col("time") < F.lit(b).cast("timestamp_ntz")))

    base = str(tmp_path / "b")
    with pytest.raises(RuntimeError):
        INC.run_backfill(spark, base, KEYS, lambda a, b: load(a, b, 3), T0, end)
    ledger = sinks.read_table(spark, f"{base}/ledger", INC.LEDGER).orderBy("number").collect()
    assert [r.number for r in ledger] == [0, 1] and ledger[1].slice_end == T0 + dt.timedelta(days=14)
    del asked[:]
    INC.run_backfill(spark, base, KEYS, load, T0, end)
    assert asked[0][0] == ledger[1].last_time - dt.timedelta(days=1)  # not from the start
    got = {(r.time, r.demand_mw) for r in sinks.read_table(spark, f"{base}/rows").collect()}
    assert got == {(r.time, r.demand_mw) for r in rows.collect()}
    assert INC.run_backfill(spark, base, KEYS, load, T0, end) == 0


def test_poll_source_goes_on_from_the_checkpoint(spark, tmp_path):
    spark.dataSource.register(PollSource)
    service, out = f"{tmp_path}/service", f"{tmp_path}/out"
    hour = lambda h: T0 + dt.timedelta(hours=h)
    add = lambda hours: spark.createDataFrame([(hour(h), "NSW1", float(h)) for h in hours], DEMAND).write.mode("append").parquet(service)

    def poll(as_of, lookback):
        rows = spark.readStream.format("wattlake_poll").schema(DEMAND).option("path", service).option("asOf", as_of.isoformat())
        q = rows.option("lookbackMinutes", lookback).load().writeStream.option("checkpointLocation", f"{tmp_path}/ckpt")
        q = q.trigger(processingTime="0 seconds").start(out)
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        return sorted(r.demand_mw for r in spark.read.schema(DEMAND).parquet(out).collect())

    add(range(10))
    assert poll(hour(5), 120) == [3.0, 4.0, 5.0]  # the first poll sees its look-back window only
    assert poll(hour(5), 120) == [3.0, 4.0, 5.0]
    add([10, 11])
    assert poll(hour(7), 6000) == [3.0, 4.0, 5.0, 6.0, 7.0]  # not the rows before its position
    assert poll(hour(30), 6000) == [float(i) for i in range(3, 12)]


def test_stopped_stream_equals_one_run_and_batches_do_not_overlap(spark, tmp_path):
    rows = [(T0 + dt.timedelta(minutes=i), "NSW1", float(i)) for i in range(60)]
    spark.createDataFrame(rows, DEMAND).repartitionByRange(4, "time").write.parquet(f"{tmp_path}/feed")
    stream = lambda: spark.readStream.schema(DEMAND).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/feed")
    tables = {}
    for name, stops in (("once", ()), ("stopped", (0, 2))):
        spans = run_with_stops(stream, lambda b, e: sinks.append(b, f"{tmp_path}/{name}", e, "w"), f"{tmp_path}/{name}-ckpt", stops)
        assert all(a[2] <= b[1] for a, b in zip(spans, spans[1:]))
        assert [e for e, _, _ in spans] == sorted([*range(4), *stops])
        tables[name] = sorted(tuple(r) for r in sinks.read_table(spark, f"{tmp_path}/{name}").collect())
    assert tables["once"] == tables["stopped"] == sorted(rows)


def test_a_batch_of_the_feed_has_files_for_all_cores(spark, tmp_path):
    from wattlake.plans.q_restart import BATCHES, _feed

    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(4000).selectExpr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id) AS ts", "id")
    assert _feed(rows, f"{tmp_path}/feed") == cores
    written = spark.read.parquet(f"{tmp_path}/feed").groupBy(F.input_file_name()).count().collect()
    assert len(written) == BATCHES * cores and max(r["count"] for r in written) < 4 * 4000 / len(written)
    assert _feed(rows.limit(3), f"{tmp_path}/few") == 1 and _feed(rows.limit(0), f"{tmp_path}/none") == 1
    # a column of one value is one range
    assert _feed(rows.withColumn("ts", F.lit(T0).cast("timestamp_ntz")), f"{tmp_path}/one") == 1


def test_sketched_latency_is_near_the_true_ranks(spark, tmp_path):
    from wattlake.streaming.counters import ChangeCounters, metrics_summary

    rng = random.Random(0)
    late = [rng.expovariate(1 / 300) for _ in range(20_000)]
    counters = ChangeCounters()
    for i in range(4):
        part = late[i * 5000:(i + 1) * 5000]
        sketch = spark.createDataFrame([(x,) for x in part], "v double").agg(F.kll_sketch_agg_double("v")).first()[0]
        counters.rows.append({"run_id": "r", "batch_id": i, "received": 5000, "decoded": 5000, "skipped_bad_json": 0, "skipped_deleted": 0,
                              "skipped_no_time": 0, "skipped_unknown_region": 0, "skipped_bad_time": 0, "latency_sum": int(sum(part)),
                              "latency_max": int(max(part)), "latency_sketch": sketch})
        counters.write(spark, f"{tmp_path}/m")
    r = metrics_summary(spark.read.parquet(f"{tmp_path}/m")).first()
    assert r.batches == 4 and r.received == 20_000 and counters.rows == []
    for q, got in ((0.5, r.latency_p50), (0.95, r.latency_p95), (0.99, r.latency_p99)):
        assert abs(sum(x <= got for x in late) / len(late) - q) < 0.0133 * 2


def test_positions_are_the_sorted_order(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(5)]), i, rng.random()) for i in range(500)]
    frame = spark.createDataFrame(rows, "k int, i int, v double").repartition(7)
    got = sorted((r.position, r.k, r.i) for r in with_position(frame, ["k", "i"]).collect())
    want = sorted(((k, i) for k, i, _ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert got == [(n, k, i) for n, (k, i) in enumerate(want, 1)]
    assert with_position(frame.limit(0), ["k", "i"]).count() == 0
