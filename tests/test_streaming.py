"""Streaming jobs drained with availableNow must equal their batch twins."""

import math
import tempfile

from pyspark.sql import functions as F

from velograph.operators import align, serve
from velograph.sources import tables
from velograph.streaming import replay

SF = "/root/testdata/sf0.001"


def _stage(spark):
    r = align.regular_grid(tables.readings(spark, SF), 60).select("edge_id", "timestamp", "speed")
    root = tempfile.mkdtemp(prefix="vg-stream-")
    replay.stage_days(r, f"{root}/days")
    return r, root


def test_stream_state_equals_batch(spark):
    r, root = _stage(spark)
    src = replay.replay_source(spark, f"{root}/days", replay.LONG_SCHEMA)

    latest = replay.StateTable(spark, f"{root}/latest", ["edge_id"])
    replay.run_available(replay.latest_stream(src), f"{root}/ck1", "update", latest.upsert)
    got = {x.edge_id: (x.speed, x.ts) for x in latest.read().collect()}
    want = {x.edge_id: (x.speed, x.ts) for x in serve.latest_state(r).collect()}
    assert got == want

    ema = replay.StateTable(spark, f"{root}/ema", ["edge_id"])
    replay.run_available(replay.ema_stream(src), f"{root}/ck2", "update", ema.upsert)
    got = {x.edge_id: x.ema for x in ema.read().collect()}
    g = r.withColumn("day", F.date_trunc("DAY", "timestamp"))
    want = {x.edge_id: x.ema for x in serve.ema_state(g).collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in got)


def test_stream_forecast_and_freshness(spark):
    r, root = _stage(spark)
    src = replay.replay_source(spark, f"{root}/days", replay.LONG_SCHEMA)
    pred = replay.StateTable(spark, f"{root}/pred", ["edge_id", "horizon"])
    replay.run_available(replay.forecast_stream(src, 60), f"{root}/ck3", "update", pred.upsert)
    got = {(x.edge_id, x.horizon): x.value for x in pred.read().collect()}

    lo, hi = align.grid_bounds(r)
    g = align.regular_grid(r, 60, bounds=(lo, hi))
    h = align.history_arrays(g, 60, 12).where(F.col("timestamp") == F.timestamp_micros(F.lit(hi)))
    want_df = serve.prediction_state(h.withColumnRenamed("timestamp", "ts"), 60, 12,
                                     serve.ema_forecaster("x", 12, 0.3))
    want = {(x.edge_id, x.horizon): x.value for x in want_df.collect()}
    assert got.keys() == want.keys()
    bad = {k: (got[k], want[k]) for k in got
           if not ((got[k] is None and want[k] is None) or
                   (got[k] is not None and want[k] is not None and math.isclose(got[k], want[k], rel_tol=1e-9)))}
    assert not bad

    fresh = {}

    def sink(df, _):
        fresh["v"] = df.collect()[0].last_ts

    replay.run_available(replay.freshness_stream(src), f"{root}/ck4", "complete", sink)
    assert fresh["v"] == r.agg(F.max("timestamp")).collect()[0][0]

    log = replay.capped_log_sink(spark, f"{root}/log", cap=100)
    replay.run_available(src, f"{root}/ck5", "append", log)
    t = replay.StateTable(spark, f"{root}/log", ["timestamp"], "timestamp").read()
    assert t.count() == 100


def test_wide_to_long_and_stream_static_lookup(spark):
    import datetime as dt
    root = tempfile.mkdtemp(prefix="vg-stream2-")
    t0 = dt.datetime(2024, 1, 1)
    wide = spark.createDataFrame([(t0, 1.0, None), (t0 + dt.timedelta(minutes=5), 2.0, 3.0)],
                                 "timestamp timestamp, s0 double, s1 double")
    wide.write.parquet(f"{root}/wide")
    src = replay.replay_source(spark, f"{root}/wide", "timestamp timestamp, s0 double, s1 double")
    long = replay.wide_to_long(src, ["s0", "s1"])
    got = {}

    def sink(df, _):
        got.update({(r.edge_id, r.timestamp): r.speed for r in df.collect()})

    replay.run_available(long, f"{root}/ck", "append", sink)
    assert len(got) == 4 and got[("s1", t0)] is None

    req = spark.createDataFrame([(1, ["s0", "s9"], 15)], "request_id int, edge_ids array<string>, horizon int")
    req.write.json(f"{root}/req")
    req_stream = spark.readStream.schema("request_id int, edge_ids array<string>, horizon int").json(f"{root}/req")
    pred = spark.createDataFrame([("s0", 15, 42.0, t0)], "edge_id string, horizon int, value double, ts timestamp")
    latest = spark.createDataFrame([("s9", 7.0, t0)], "edge_id string, speed double, ts timestamp")
    out = {}

    def sink2(df, _):
        out.update({r.edge_id: (r.value, r.source) for r in df.collect()})

    replay.run_available(serve.lookup(req_stream, pred, latest), f"{root}/ck2", "append", sink2)
    assert out == {"s0": (42.0, "pred"), "s9": (7.0, "speed")}


def test_run_replay_then_lookup(spark):
    r, root = _stage(spark)
    st = replay.run_replay(spark, f"{root}/days", f"{root}/state", 60, days_per_batch=12)
    latest, pred = st["latest"].read(), st["pred"].read()
    assert latest.count() == r.select("edge_id").distinct().count()
    assert pred.select("horizon").distinct().count() == 4
    fresh = st["fresh"].read().collect()[0].last_ts
    assert fresh == r.agg(F.max("timestamp")).collect()[0][0]
    req = spark.createDataFrame([(1, ["click", "nope"], 15)], "request_id int, edge_ids array<string>, horizon int")
    out = {x.edge_id: x.source for x in serve.lookup(req, pred, latest).collect()}
    assert out["nope"] == "none" and out["click"] in ("pred", "speed")


def _ticks(spark, rows):
    return spark.createDataFrame(rows, replay.LONG_SCHEMA)


def _hour(i):
    import datetime as dt
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)


def _drain(spark, parts, job, keys):
    """Write ``parts`` as files one after the other and drain ``job``, a file a batch."""
    root = tempfile.mkdtemp(prefix="vg-stream3-")
    for i, part in enumerate(parts):
        part.coalesce(1).write.parquet(f"{root}/days/date={i}")
    table = replay.StateTable(spark, f"{root}/state", keys)
    replay.run_available(job(replay.replay_source(spark, f"{root}/days", replay.LONG_SCHEMA)), f"{root}/ck", "update", table.upsert)
    return table


def test_forecast_over_gaps_in_small_batches(spark):
    values = [None, 2.0, None, None, 5.0, 6.0, None, 8.0, None, 10.0, 11.0, None, 13.0, None, 15.0, None]
    parts = [_ticks(spark, [("a", _hour(i), values[i]) for i in range(k, k + 4)]) for k in range(0, 16, 4)]
    got = {r.horizon: (r.value, r.ts) for r in _drain(spark, parts, lambda s: replay.forecast_stream(s, 60), ["edge_id", "horizon"]).read().collect()}
    history, last = [], math.nan
    for v in values[4:]:
        last = last if v is None else v
        history.append(last)
    e = history[0]
    for v in history[1:]:
        e = 0.3 * v + 0.7 * e
    assert got.keys() == {15, 30, 45, 60}
    assert all(math.isclose(v, e, rel_tol=1e-12) and t == _hour(15) for v, t in got.values())


def test_ema_orders_ticks_over_arrow_batches(spark):
    import datetime as dt
    import random
    rows = [("a", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), 40.0 + i % 37) for i in range(25_000)]
    want = rows[0][2]
    for _, _, v in rows[1:]:
        want = 0.2 * v + 0.8 * want
    random.Random(4).shuffle(rows)
    got = _drain(spark, [_ticks(spark, rows)], replay.ema_stream, ["edge_id"]).read().collect()
    assert math.isclose(got[0].ema, want, rel_tol=1e-9) and got[0].ts == dt.datetime(2024, 1, 1) + dt.timedelta(minutes=24_999)


def test_latest_breaks_ties_like_its_batch_twin(spark):
    rows = [("a", _hour(1), 2.0), ("a", _hour(1), 4.0), ("a", _hour(0), 9.0), ("b", _hour(2), None), ("b", _hour(1), 3.0)]
    got = _drain(spark, [_ticks(spark, rows)], replay.latest_stream, ["edge_id"]).read()
    assert {tuple(r) for r in got.collect()} == {("a", _hour(1), 4.0), ("b", _hour(1), 3.0)}
    assert {(r.edge_id, r.ts, r.speed) for r in serve.latest_state(_ticks(spark, rows)).collect()} == {("a", _hour(1), 4.0), ("b", _hour(1), 3.0)}


def test_model_forecast_is_normalised_and_turned_back(spark):
    rows = [("a", _hour(i), 30.0 + i) for i in range(12)]
    job = lambda s: replay.forecast_stream(s, 60, predict=lambda x: x[:, -1:] + [[0.0, 0.1, 0.2, 0.3] + [9.0] * 8], stats=(30.0, 10.0))
    got = {r.horizon: r.value for r in _drain(spark, [_ticks(spark, rows)], job, ["edge_id", "horizon"]).read().collect()}
    assert all(math.isclose(got[h], v) for h, v in {15: 41.0, 30: 42.0, 45: 43.0, 60: 44.0}.items())


def test_state_table_survives_a_failed_and_a_replayed_batch(spark):
    import pytest
    root = tempfile.mkdtemp(prefix="vg-state-")
    table = replay.StateTable(spark, f"{root}/t", ["edge_id"])
    make = lambda *r: spark.createDataFrame(list(r), "edge_id string, ts timestamp, speed double")
    assert table.read() is None
    table.upsert(make(("a", _hour(0), 1.0)), 0)
    table.upsert(make(("b", _hour(1), 2.0)), 1)
    make(("half", _hour(9), 9.0)).write.parquet(f"{root}/t/batch_id=7")
    import os
    os.remove(f"{root}/t/batch_id=7/_SUCCESS")  # a writer that never committed
    table.upsert(make(("b", _hour(1), 2.0)), 1)  # the batch again
    assert sorted(r.edge_id for r in table.read().collect()) == ["a", "b"]
    table.upsert(make(("c", _hour(2), 3.0)), 2)
    assert sorted(r.edge_id for r in table.read().collect()) == ["a", "b", "c"] and len(table.versions()) == 2
    newest = next(f for f in os.listdir(f"{root}/t/batch_id=2") if f.endswith(".parquet"))
    with open(f"{root}/t/batch_id=2/{newest}", "wb") as f:
        f.write(b"broken")
    with pytest.raises(Exception):
        table.upsert(make(("d", _hour(3), 4.0)), 3)
    assert table.versions()[-1] == 2  # a failed read writes nothing


def test_day_source_goes_by_day_whatever_the_files_times(spark):
    """Days out of modification order, a day of several files, a column that a file lacks,
    three days a batch; a restarted query goes on behind its checkpoint."""
    import os

    from velograph.sources import days, io
    root = tempfile.mkdtemp(prefix="vg-days-")
    rows = spark.range(24 * 7).select(F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600).alias("timestamp"),
                                      F.concat(F.lit("s"), F.col("id") % 3).alias("edge_id"), F.col("id").cast("double").alias("speed"))
    io.write_partitioned(rows.repartition(3), f"{root}/d")
    rows.where("timestamp < '2024-01-01 05:00:00'").drop("speed").write.mode("append").parquet(f"{root}/d/date=2024-01-04")
    for k, day in enumerate(sorted((d for d in os.listdir(f"{root}/d") if d.startswith("date=")), reverse=True)):
        for f in os.listdir(f"{root}/d/{day}"):
            os.utime(f"{root}/d/{day}/{f}", (1_600_000_000 + k * 100,) * 2)  # newest day oldest
    seen = []

    def sink(df, batch_id):
        r = df.agg(F.date_format(F.max("timestamp"), "dd"), F.count("*"), F.count("speed")).first()
        seen.append((batch_id, *r))

    source = days.day_stream(spark, f"{root}/d", replay.LONG_SCHEMA, 3)
    replay.run_drained(source, f"{root}/ck", "append", sink)
    assert seen == [(0, "03", 72, 72), (1, "06", 77, 72), (2, "07", 24, 24)]
    io.write_partitioned(rows.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 30 DAYS")), f"{root}/d", mode="append")
    replay.run_drained(days.day_stream(spark, f"{root}/d", replay.LONG_SCHEMA, 4), f"{root}/ck", "append", sink)
    assert [s[1:] for s in seen[3:]] == [("03", 96, 96), ("06", 72, 72)]
    replay.run_drained(days.day_stream(spark, f"{root}/d", replay.LONG_SCHEMA, 4), f"{root}/ck", "append", sink)
    assert sum(s[2] for s in seen) == 2 * 24 * 7 + 5


def test_ema_over_days_in_the_wrong_file_order(spark):
    import os

    from velograph.sources import days, io
    root = tempfile.mkdtemp(prefix="vg-days-")
    rows = [("a", _hour(i), float(i * i % 17)) for i in range(96)]
    io.write_partitioned(_ticks(spark, rows), f"{root}/d")
    for k, day in enumerate(sorted((d for d in os.listdir(f"{root}/d") if d.startswith("date=")), reverse=True)):
        for f in os.listdir(f"{root}/d/{day}"):
            os.utime(f"{root}/d/{day}/{f}", (1_600_000_000 + k * 100,) * 2)
    table = replay.StateTable(spark, f"{root}/state", ["edge_id"])
    replay.run_drained(replay.ema_stream(days.day_stream(spark, f"{root}/d", replay.LONG_SCHEMA)), f"{root}/ck", "update", table.upsert)
    want = rows[0][2]
    for _, _, v in rows[1:]:
        want = 0.2 * v + 0.8 * want
    got = table.read().first()
    assert math.isclose(got.ema, want, rel_tol=1e-9) and got.ts == _hour(95)


def test_forecast_is_normalised_by_each_sensor(spark):
    rows = [(s, _hour(i), base + i) for s, base in (("a", 30.0), ("b", 60.0), ("c", 5.0)) for i in range(12)]
    stats = spark.createDataFrame([("a", 30.0, 10.0), ("b", 50.0, 0.0)], "edge_id string, mu double, sigma double")
    job = lambda s: replay.forecast_stream(s, 60, predict=lambda x: 0.5 * x[:, -1:] + [[0.1] * 12], stats=stats)
    got = {(r.edge_id, r.horizon): r.value for r in _drain(spark, [_ticks(spark, rows)], job, ["edge_id", "horizon"]).read().collect()}
    for s, last, mu, sd in (("a", 41.0, 30.0, 10.0), ("b", 71.0, 50.0, 1.0), ("c", 16.0, 0.0, 1.0)):
        assert all(math.isclose(got[s, h], (0.5 * (last - mu) / sd + 0.1) * sd + mu) for h in (15, 30, 45, 60))


def test_live_lookup_sees_the_state_of_its_instant(spark):
    """State moves between and inside batches: nothing, speed, forecast; gaps, ties, a
    horizon without a forecast, rejected and repeated requests, unknown sensors."""
    readings = [("a", _hour(i), None if i in (0, 5, 20) else 10.0 + i) for i in range(30)]
    asked = [(1, _hour(0), ["a", "a", "zz"], 15), (2, _hour(1), ["a"], 15), (3, _hour(5), ["a"], 30), (4, _hour(11), ["a"], 60), (5, _hour(12), ["a"], 15),
             (6, _hour(20), ["a"], 45), (7, _hour(20), ["a"], 20), (8, _hour(20), ["a"], 90), (9, _hour(29), ["a", "b"], 15), (10, _hour(40), ["a"], 15)]
    requests = spark.createDataFrame(asked, "request_id long, timestamp timestamp, edge_ids array<string>, horizon int")
    more = [("b", _hour(i), None) for i in range(30)]
    ticks = _ticks(spark, readings + more).withColumns({"request_id": F.lit(None).cast("long"), "horizon": F.lit(None).cast("int")})
    events = ticks.unionByName(replay.requested(requests))
    answers = {}
    for cuts in ([0, 48], [0, 8, 12, 13, 21, 48]):
        root, got = tempfile.mkdtemp(prefix="vg-live-"), []
        for k, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)):
            part = events.where((F.col("timestamp") >= F.lit(_hour(lo))) & (F.col("timestamp") < F.lit(_hour(hi))))
            part.repartition(2).write.parquet(f"{root}/d/date=2024-01-{k + 1:02d}")
        from velograph.sources import days
        source = days.day_stream(spark, f"{root}/d", replay.LONG_SCHEMA + ", request_id long, horizon int")
        replay.run_drained(replay.live_lookup(source, 60), f"{root}/ck", "append", lambda df, _: got.extend(df.collect()))  # noqa: B023
        answers[len(cuts)] = {(r.request_id, r.edge_id): (None if r.value is None else round(r.value, 9), r.source, r.ts) for r in got}
        assert len(got) == len(answers[len(cuts)])

    def forecast(upto):
        h, last = [], math.nan
        for v in [v for _, _, v in readings[:upto + 1]][-12:]:
            last = last if v is None else v
            h.append(last)
        e = h[0]
        for v in h[1:]:
            e = 0.3 * v + 0.7 * e
        return e

    want = {(1, "a"): (None, "none", _hour(0)), (1, "zz"): (None, "none", None), (2, "a"): (11.0, "speed", _hour(1)), (3, "a"): (14.0, "speed", _hour(5)),
            (4, "a"): (21.0, "speed", _hour(11)),  # twelve ticks, the first missing: no forecast yet
            (5, "a"): (round(forecast(12), 9), "pred", _hour(12)), (6, "a"): (round(forecast(20), 9), "pred", _hour(20)), (7, "a"): (29.0, "speed", _hour(20)),
            (9, "a"): (round(forecast(29), 9), "pred", _hour(29)), (9, "b"): (0.0, "pred", _hour(29)), (10, "a"): (round(forecast(29), 9), "pred", _hour(29))}
    assert answers[2] == want and answers[6] == want


def test_lookup_stream_follows_tables_that_move(spark):
    """Three upserts beside one running lookup query: every batch reads the newest version."""
    root = tempfile.mkdtemp(prefix="vg-move-")
    pred = replay.StateTable(spark, f"{root}/pred", ["edge_id", "horizon"])
    latest = replay.StateTable(spark, f"{root}/latest", ["edge_id"])
    make = lambda i: spark.createDataFrame([(i, ["s0", "s1"], 15)], "request_id int, edge_ids array<string>, horizon int")
    got = {}
    make(0).coalesce(1).write.json(f"{root}/req/0")
    stream = spark.readStream.schema("request_id int, edge_ids array<string>, horizon int").option("recursiveFileLookup", True).json(f"{root}/req")
    sink = replay.lookup_sink(pred, latest, lambda df, _: got.update({(r.request_id, r.edge_id): (r.value, r.source) for r in df.collect()}))
    q = stream.writeStream.option("checkpointLocation", f"{root}/ck").foreachBatch(sink).start()
    try:
        q.processAllAvailable()
        for i in range(1, 5):
            latest.upsert(spark.createDataFrame([("s1", float(i), _hour(i))], "edge_id string, speed double, ts timestamp"), i)
            pred.upsert(spark.createDataFrame([("s0", 15, 10.0 * i, _hour(i))], "edge_id string, horizon int, value double, ts timestamp"), i)
            make(i).coalesce(1).write.json(f"{root}/req/{i}")
            q.processAllAvailable()
    finally:
        q.stop()
    assert got == {(0, "s0"): (None, "none"), (0, "s1"): (None, "none")} | {
        k: v for i in range(1, 5) for k, v in {(i, "s0"): (10.0 * i, "pred"), (i, "s1"): (float(i), "speed")}.items()}
