"""Sinks (idempotence, first/last write wins), change decoding, DQ on known violations."""

import datetime as dt
import json
import os
import pathlib
import shutil

import pytest

from wattlake.operators import quality as Q
from wattlake.sources import sinks
from wattlake.streaming.changes import decode_changes
from wattlake.streaming.refresh import hour_trigger

T0 = dt.datetime(2024, 1, 1, 10, 0)


def test_upsert_is_idempotent_and_last_write_wins(spark, tmp_path):
    base = str(tmp_path / "bronze")
    schema = "time timestamp_ntz, region_id string, demand_mw double, seq int"
    first = spark.createDataFrame([(T0, "NSW1", 1.0, 1), (T0, "QLD1", 2.0, 1)], schema)
    batch = spark.createDataFrame([(T0, "NSW1", 5.0, 1), (T0, "NSW1", 6.0, 2)], schema)
    sinks.upsert_table(first, base, ["time", "region_id"], order_by="seq")
    sinks.upsert_table(batch, base, ["time", "region_id"], order_by="seq")
    once = sorted(tuple(r) for r in sinks.read_table(spark, base).collect())
    sinks.upsert_table(batch, base, ["time", "region_id"], order_by="seq")
    twice = sorted(tuple(r) for r in sinks.read_table(spark, base).collect())
    assert once == twice == [(T0, "NSW1", 6.0), (T0, "QLD1", 2.0)]


def test_insert_absent_first_write_wins(spark, tmp_path):
    base = str(tmp_path / "pred")
    schema = "created_at timestamp_ntz, region_id string, v double"
    sinks.insert_absent_table(spark.createDataFrame([(T0, "NSW1", 1.0)], schema), base, ["created_at", "region_id"])
    sinks.insert_absent_table(spark.createDataFrame([(T0, "NSW1", 9.0), (T0, "SA1", 3.0)], schema), base, ["created_at", "region_id"])
    got = sorted(tuple(r) for r in sinks.read_table(spark, base).collect())
    assert got == [(T0, "NSW1", 1.0), (T0, "SA1", 3.0)]


def test_decode_change_edge_cases(spark):
    def env(after):
        return json.dumps({"payload": {"after": after, "op": "c"}})

    micros = int(dt.datetime(2024, 1, 1, 11, 0, tzinfo=dt.timezone.utc).timestamp() * 1_000_000)
    msgs = [
        "{not json",
        json.dumps({"payload": {"after": None, "op": "d"}}),
        env({"time": micros, "region_id": "NSW1", "demand_mw": "100.5"}),
        env({"time": "2024-01-01T12:00:00+10:00", "region_id": "QLD1", "demand_mw": 7}),
        env({"time": "2024-01-01T13:00:00", "region_id": "SA1", "demand_mw": "x"}),
        env({"time": "2024-01-01T13:00:00", "region_id": "ZZZ1", "demand_mw": 1}),
        env({"time": "garbage", "region_id": "VIC1", "demand_mw": 1}),
    ]
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    got = sorted((r.region_id, r.time, r.demand_mw) for r in decode_changes(df).collect())
    assert got == [
        ("NSW1", dt.datetime(2024, 1, 1, 11, 0), 100.5),
        ("QLD1", dt.datetime(2024, 1, 1, 2, 0), 7.0),
        ("SA1", dt.datetime(2024, 1, 1, 13, 0), None),
    ]


def test_quality_suite_known_violations(spark):
    rows = [(T0, "NSW1", 100.0), (T0, "NSW1", 25000.0), (T0, "XXX", None), (None, "QLD1", 5.0)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, region_id string, demand_mw double")
    res = {r.rule_id: r for r in Q.run_suite(df, Q.default_suites()["silver.demand_5min"]).collect()}
    assert res[1].success  # row count
    assert not res[2].success and res[2].unexpected == 1  # time not null
    assert not res[4].success and res[4].unexpected == 1  # demand not null
    assert not res[5].success and res[5].unexpected == 1  # region in set
    assert res[6].unexpected == 1 and not res[6].success  # 2/3 in range < 0.95
    assert not res[7].success and res[7].unexpected == 2  # the (T0, NSW1) pair


def test_change_counters_by_reason(spark):
    from wattlake.streaming.changes import change_counters

    def env(after):
        return json.dumps({"payload": {"after": after, "op": "c"}})

    msgs = [
        "{not json",
        json.dumps({"payload": {"after": None, "op": "d"}}),
        env({"region_id": "NSW1", "demand_mw": 1}),
        env({"time": "2024-01-01T00:00:00", "region_id": "ZZZ1", "demand_mw": 1}),
        env({"time": "garbage", "region_id": "VIC1", "demand_mw": 1}),
        env({"time": "2024-01-01T00:00:00", "region_id": "VIC1", "demand_mw": 1}),
    ]
    r = change_counters(spark.createDataFrame([(m,) for m in msgs], "value string")).first()
    assert (r.received, r.decoded) == (6, 1)
    assert (r.skipped_bad_json, r.skipped_deleted, r.skipped_no_time, r.skipped_unknown_region, r.skipped_bad_time) == (1, 1, 1, 1, 1)


def test_high_water_global_vs_per_key(spark):
    """One late region is lost with the global mark, kept with per-key marks."""
    from wattlake.operators.incremental import newer_than

    schema = "time timestamp_ntz, region_id string, demand_mw double"
    sink = spark.createDataFrame([(T0, "NSW1", 1.0), (T0 - dt.timedelta(hours=2), "QLD1", 1.0)], schema)
    late = spark.createDataFrame([(T0 - dt.timedelta(hours=1), "QLD1", 2.0), (T0 + dt.timedelta(hours=1), "NSW1", 3.0)], schema)
    assert sorted(r.region_id for r in newer_than(late, sink).collect()) == ["NSW1"]
    assert sorted(r.region_id for r in newer_than(late, sink, per_key="region_id").collect()) == ["NSW1", "QLD1"]
    back = newer_than(late, sink, lookback_hours=2).collect()
    assert sorted(r.region_id for r in back) == ["NSW1", "QLD1"]


def test_stamp_updated_at(spark):
    from wattlake.operators.clean import stamp

    df = spark.createDataFrame([(1,)], "x int")
    assert stamp(df, dt.datetime(2024, 5, 1)).first().updated_at == dt.datetime(2024, 5, 1)


DEMAND = "time timestamp_ntz, region_id string, demand_mw double"
KEYS = ["time", "region_id"]


def _files(base):
    return {str(p.relative_to(base)) for p in base.rglob("*.parquet")}


def test_two_updates_of_a_key_in_one_batch(spark, tmp_path):
    rows = spark.createDataFrame([(T0, "NSW1", 1.0), (T0, "NSW1", 2.0)], DEMAND)
    for name in (sinks.upsert_table, sinks.delete_insert_table, sinks.insert_absent_table):
        base = str(tmp_path / name.__name__)
        assert name(rows, base, KEYS) == 1
        assert [tuple(r) for r in sinks.read_table(spark, base).collect()] == [(T0, "NSW1", 2.0)]


def test_null_order_keeps_the_row(spark):
    from wattlake.operators.incremental import dedupe_last

    rows = spark.createDataFrame([(T0, "NSW1", 1.0, None), (T0, "SA1", 2.0, None), (T0, "SA1", 1.0, 3)], DEMAND + ", seq int")
    got = sorted((r.region_id, r.demand_mw) for r in dedupe_last(rows, KEYS, "seq").collect())
    assert got == [("NSW1", 1.0), ("SA1", 1.0)]


def test_replayed_epoch_changes_nothing(spark, tmp_path):
    base = str(tmp_path / "t")
    rows = spark.createDataFrame([(T0, "NSW1", 1.0)], DEMAND)
    assert sinks.append(rows, base, epoch=0) == 1
    assert sinks.append(rows, base, epoch=0) == 0
    assert sinks.append(rows, base, epoch=1) == 1
    assert sinks.append(rows, base, epoch=1, writer="other") == 1
    assert sinks.read_table(spark, base).count() == 3
    assert sinks.append(rows.limit(0), base) == 0


def test_untouched_days_keep_their_files(spark, tmp_path):
    base = tmp_path / "t"
    day = lambda n: T0 + dt.timedelta(days=n)
    sinks.upsert_table(spark.createDataFrame([(day(n), "NSW1", float(n)) for n in range(4)], DEMAND), str(base), KEYS)
    before = _files(base / "rows")
    for i in range(4):
        sinks.upsert_table(spark.createDataFrame([(day(2), "NSW1", float(i))], DEMAND), str(base), KEYS)
    after = _files(base / "rows")
    assert before - after == {f for f in before if "_day=2024-01-03" in f}
    assert all("_day=2024-01-03" in f for f in after - before) and len(after) == len(before)
    got = sorted((r.time, r.demand_mw) for r in sinks.read_table(spark, str(base)).collect())
    assert got == [(day(0), 0.0), (day(1), 1.0), (day(2), 3.0), (day(3), 3.0)]


@pytest.mark.parametrize("writer", [sinks.upsert_table, sinks.insert_absent_table, sinks.delete_insert_table])
@pytest.mark.parametrize("broken", ["before the swap", "in the swap", "before the mark"])
def test_a_stop_at_any_step_and_a_replay_give_the_same_table(spark, tmp_path, monkeypatch, writer, broken):
    base = str(tmp_path / "t")
    day = lambda n: T0 + dt.timedelta(days=n)
    first = spark.createDataFrame([(day(n), r, float(n)) for n in range(3) for r in ("NSW1", "SA1")], DEMAND)
    batch = spark.createDataFrame([(day(1), "NSW1", 7.0), (day(2), "VIC1", 8.0), (day(4), "SA1", 9.0)], DEMAND)
    writer(first, base, KEYS, epoch=0)
    whole = {(r.time, r.region_id): r.demand_mw for r in first.collect()}
    for r in batch.collect():
        if writer is not sinks.insert_absent_table or (r.time, r.region_id) not in whole:
            whole[r.time, r.region_id] = r.demand_mw
    real = sinks.overwrite_parts

    def stop(rows, path, *parts):
        if path.endswith("/rows") and broken != "before the mark":
            if broken == "in the swap":  # a day's old files are gone and its new ones not yet there
                shutil.rmtree(f"{path}/_day=2024-01-02")
            raise RuntimeError("killed")
        if path.endswith("/epochs"):
            raise RuntimeError("killed")
        real(rows, path, *parts)

    with monkeypatch.context() as m:
        m.setattr(sinks, "overwrite_parts", stop)
        with pytest.raises(RuntimeError, match="killed"):
            writer(batch, base, KEYS, epoch=1)
    assert writer(batch, base, KEYS, epoch=1) == 3
    assert writer(batch, base, KEYS, epoch=1) == 0
    assert {(r.time, r.region_id): r.demand_mw for r in sinks.read_table(spark, base).collect()} == whole


def test_appended_rows_of_a_replay_overwrite_themselves(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "t")
    rows = spark.createDataFrame([(T0, "NSW1", 1.0), (T0 + dt.timedelta(days=1), "SA1", 1.0)], DEMAND)
    with monkeypatch.context() as m:
        m.setattr(sinks, "_mark", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            sinks.append(rows, base, epoch=0)
    assert sinks.append(rows, base, epoch=0) == 2 and sinks.read_table(spark, base).count() == 2
    with pytest.raises(ValueError, match="appended"):
        sinks.upsert_table(rows, base, KEYS)
    assert sinks.read_table(spark, str(tmp_path / "none")) is None


def test_build_replaces_and_days_select(spark, tmp_path):
    base = str(tmp_path / "t")
    rows = spark.createDataFrame([(T0, "NSW1", 1.0), (T0 + dt.timedelta(days=1), "NSW1", 2.0), (None, "SA1", 3.0)], DEMAND)
    assert sinks.build(rows, base, KEYS) == 3
    assert sinks.read_table(spark, base, days=["2024-01-02"]).count() == 1
    assert sinks.build(rows.limit(1), base, KEYS) == 1
    assert sinks.read_table(spark, base).count() == 1


def test_refresh_ignores_layout_order_and_replay(spark, tmp_path):
    """The chain's tables depend on the rows alone: shuffled, split, repeated batches give the same."""
    import random

    from wattlake.streaming.refresh import refresh_batch

    rng = random.Random(0)
    schema = DEMAND + ", position long"
    rows = [(T0 + dt.timedelta(minutes=5 * rng.randrange(60)), rng.choice(["NSW1", "SA1"]), float(i), i) for i in range(200)]
    weather = spark.createDataFrame([(T0, "NSW1", *[1.0] * 6)], "time timestamp_ntz, region_id string, temperature_2m double, "
                                    "relative_humidity_2m double, precipitation double, cloud_cover double, wind_speed_10m double, shortwave_radiation double")
    results = []
    for run, batches in (("one", [rows]), ("three", None)):
        if batches is None:
            mixed = rows[:]
            rng.shuffle(mixed)
            batches = [mixed[:90], mixed[50:], mixed[:90]]
        base = str(tmp_path / run)
        for epoch, b in enumerate(batches):
            frame = spark.createDataFrame(b, schema)
            refresh_batch(frame, base, epoch, weather)
            refresh_batch(frame, base, epoch, weather)  # replay
        tables = [sorted(map(tuple, sinks.read_table(spark, f"{base}/{t}").collect()), key=str)
                  for t in ("bronze_demand", "silver_demand", "features")]
        results.append(tables)
    assert results[0] == results[1]
    newest = {}
    for t, r, v, p in rows:
        newest[(t, r)] = max(newest.get((t, r), (-1, 0.0)), (p, v))
    assert {(t, r): v for t, r, v in results[0][1]} == {k: v for k, (_, v) in newest.items()}


def test_stream_queries_do_not_depend_on_file_layout(spark, tmp_path):
    from tests.conftest import SF_SMALL
    from wattlake.plans import q_stream

    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    layouts = {"shuffled": events.orderBy("value").repartition(4), "sorted": events.orderBy("ts").coalesce(1)}
    want = None
    for name, frame in layouts.items():
        frame.write.parquet(f"{tmp_path}/{name}/events.parquet")
    for sf in (SF_SMALL, *(f"{tmp_path}/{n}" for n in layouts)):
        got = [sorted(map(tuple, q(spark, sf).collect()))
               for q in (q_stream.stream_latest, q_stream.stream_dedup, q_stream.stream_hour_trigger)]
        want = want or got
        assert got == want and all(got)


def _hour_files(spark, folder, batches):
    """One file a batch, in the order of their names."""
    for i, times in enumerate(batches):
        part = f"{folder}/{i}"
        spark.createDataFrame([(t, "NSW1", 1.0) for t in times], DEMAND).coalesce(1).write.parquet(part)
        for f in pathlib.Path(part).glob("*.parquet"):
            f.rename(pathlib.Path(folder) / f"part-{i:03}.parquet")
            os.utime(pathlib.Path(folder) / f"part-{i:03}.parquet", (1e9 + i, 1e9 + i))


def _fire(spark, src, base, on_hours=None, files=1):
    stream = spark.readStream.schema(DEMAND).option("maxFilesPerTrigger", files).parquet(f"{src}/*.parquet")
    return hour_trigger(stream, f"{base}/state", on_hours, f"{base}/ckpt")


def test_late_hours_never_fire_and_layout_does_not_matter(spark, tmp_path):
    hour = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    batches = [[hour(3), hour(3), hour(5), hour(6, 5)], [hour(4), hour(7)], [hour(7), hour(7, 1)], [hour(2), hour(9), hour(8)]]
    _hour_files(spark, f"{tmp_path}/src", batches)
    _fire(spark, f"{tmp_path}/src", f"{tmp_path}/a").awaitTermination()
    rows = sinks.read_table(spark, f"{tmp_path}/a/state").collect()
    assert sorted((r.hour.hour, r.epoch) for r in rows) == [(3, 0), (5, 0), (7, 1), (8, 3), (9, 3)]
    # an ordered feed fires the same hours in one file or in many
    ordered = [[hour(h, m) for m in (0, 5)] for h in range(12)]
    _hour_files(spark, f"{tmp_path}/many", ordered)
    for name, files in (("one", 100), ("each", 1)):
        _fire(spark, f"{tmp_path}/many", f"{tmp_path}/{name}", files=files).awaitTermination()
        assert sorted(r.hour.hour for r in sinks.read_table(spark, f"{tmp_path}/{name}/state").collect()) == list(range(12))


def test_a_failed_batch_fires_its_own_hours_again(spark, tmp_path):
    """T5: hours whose work failed are not finished and fire again; those of earlier batches don't."""
    hour = lambda h: dt.datetime(2024, 1, 1, h)
    _hour_files(spark, f"{tmp_path}/src", [[hour(1)], [hour(2), hour(3)], [hour(4)]])
    seen, fail = [], [True]

    def on_hours(hours):
        now = sorted(r.hour.hour for r in hours.collect())
        seen.append(now)
        if 2 in now and fail[0]:
            raise RuntimeError("down")

    with pytest.raises(Exception, match="down"):
        _fire(spark, f"{tmp_path}/src", str(tmp_path), on_hours).awaitTermination()
    fail[0] = False
    _fire(spark, f"{tmp_path}/src", str(tmp_path), on_hours).awaitTermination()
    assert seen == [[1], [2, 3], [2, 3], [4]]
    assert sorted(r.hour.hour for r in sinks.read_table(spark, f"{tmp_path}/state").collect()) == [1, 2, 3, 4]


def test_silent_regions_are_reported_with_growing_staleness(spark, tmp_path):
    import time

    from wattlake.streaming.state import rocksdb, staleness_stream

    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    spark.createDataFrame([(now, "NSW1", 1.0)], DEMAND).coalesce(1).write.parquet(f"{tmp_path}/src")
    known = spark.createDataFrame([("NSW1",), ("TAS1",)], "region_id string")
    stream = spark.readStream.schema(DEMAND).parquet(f"{tmp_path}/src")
    reports = staleness_stream(stream, known, every=2)
    with rocksdb(spark):
        q = reports.writeStream.option("checkpointLocation", f"{tmp_path}/ckpt").trigger(processingTime="1 second").start(f"{tmp_path}/out")
    try:
        for _ in range(90):
            time.sleep(1)
            assert q.exception() is None
            got = spark.read.schema("region_id string, last_time timestamp_ntz, reported_at timestamp_ntz, staleness_seconds double").parquet(f"{tmp_path}/out").collect() if os.path.isdir(f"{tmp_path}/out") else []
            if min(sum(r.region_id == k for r in got) for k in ("NSW1", "TAS1")) >= 2:
                break
    finally:
        q.stop()
    for region, last in (("NSW1", now), ("TAS1", None)):
        mine = sorted((r for r in got if r.region_id == region), key=lambda r: r.reported_at)
        assert len(mine) >= 2 and all(r.last_time == last for r in mine)
        ages = [r.staleness_seconds for r in mine]
        assert ages == sorted(ages) and ages[0] < ages[-1] and ages[0] >= 0


def test_poll_saves_its_position(spark, tmp_path):
    from wattlake.streaming.refresh import poll

    base = str(tmp_path / "poll")
    rows = lambda hours: spark.createDataFrame([(T0 + dt.timedelta(hours=h), "NSW1", float(h)) for h in hours], DEMAND)
    assert poll(rows([0, 1]), base, KEYS) == 2
    assert poll(rows([0, 1, 2]), base, KEYS) == 1
    assert poll(rows([0, 1, 2]), base, KEYS) == 0
    assert sinks.read_table(spark, f"{base}/rows").count() == 3


def test_dedupe_by_arrival_keeps_late_events(spark, tmp_path):
    from wattlake.streaming.changes import dedupe_stream

    src = f"{tmp_path}/src"
    times = [T0, T0 - dt.timedelta(days=3), T0, T0 - dt.timedelta(days=3), T0 - dt.timedelta(hours=5)]
    for t in times:
        spark.createDataFrame([(t, "NSW1", 1.0)], DEMAND).coalesce(1).write.mode("append").parquet(src)
    for i, window in enumerate((None, "2 minutes")):
        stream = spark.readStream.schema(DEMAND).option("maxFilesPerTrigger", 1).parquet(src)
        out, ckpt = f"{tmp_path}/out{i}", f"{tmp_path}/ckpt{i}"
        dedupe_stream(stream, window=window).writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True).start(out).awaitTermination()
        assert sorted(r.time for r in spark.read.parquet(out).collect()) == sorted(set(times))


def test_key_rule_shuffles_keys_only(spark):
    rows = spark.createDataFrame([(T0, "NSW1", 100.0)], DEMAND)
    plan = Q.run_suite(rows, Q.default_suites()["silver.demand_5min"])._jdf.queryExecution().optimizedPlan().toString()
    keyed = [line for line in plan.splitlines() if "Aggregate [time" in line]
    assert keyed and all("demand_mw" not in line for line in keyed)


def test_checkpoint_folder_must_be_given_off_local():
    import pytest

    from wattlake import session

    class Context:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_stream_counters_add_up_over_batches(spark, tmp_path):
    import time

    from wattlake.streaming.changes import read_changes
    from wattlake.streaming.counters import ChangeCounters, counted_changes

    def env(**after):
        return json.dumps({"payload": {"after": after, "op": "c"}})

    good = env(time="2024-01-01T00:00:00", region_id="NSW1", demand_mw="1")
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.json").write_text("\n".join([good, "{bad", good]))
    (tmp_path / "src" / "b.json").write_text("\n".join([good, env(time="x", region_id="NSW1", demand_mw="1")]))
    counters = ChangeCounters()
    spark.streams.addListener(counters)
    try:
        raw = read_changes(spark, f"{tmp_path}/src", options={"maxFilesPerTrigger": 1}, start="earliest")
        out, ckpt = f"{tmp_path}/out", f"{tmp_path}/ckpt"
        counted_changes(raw).writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True).start(out).awaitTermination()
        deadline = time.time() + 20
        while not counters.totals["ended"] and time.time() < deadline:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counters)
    t = counters.totals
    assert (t["batches"], t["received"], t["decoded"], t["skipped_bad_json"], t["skipped_bad_time"]) == (2, 5, 3, 1, 1)
    assert counters.latency_mean > 0 and counters.latency_max >= counters.latency_mean
    assert spark.read.parquet(out).count() == 3
