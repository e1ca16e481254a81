"""Hand-written edge cases (FIXTURES.md §3); expected values follow the reference semantics."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from velograph.functions.columns import clip, linear_weight, parse_epoch_or_iso, safe_double, step_weight
from velograph.operators import align, features, forecast, graph, serve, spatial, windows

T0 = dt.datetime(2024, 1, 1, 0, 0)
NAN = float("nan")


def readings(spark, values, edge="a", freq=5, start=T0):
    rows = [(start + dt.timedelta(minutes=freq * i), edge, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "timestamp timestamp, edge_id string, speed double")


def filled(spark, values, method):
    # grid anchored on the full series: put sentinels only through NULLs
    r = readings(spark, values)
    lo = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)
    hi = lo + (len(values) - 1) * 5 * 60_000_000
    g = align.fill(align.regular_grid(r, 5, bounds=(lo, hi)), method)
    return [row.speed for row in g.orderBy("timestamp").collect()]


def test_ffill_leading_gap(spark):
    assert filled(spark, [None, 1.0, None, 3.0, None], "ffill") == [None, 1.0, 1.0, 3.0, 3.0]


def test_interpolate_both_ends(spark):
    assert filled(spark, [None, 1.0, None, None, 4.0, None], "interpolate") == [1.0, 1.0, 2.0, 3.0, 4.0, 4.0]


def test_ffill_bfill(spark):
    assert filled(spark, [None, 1.0, None, 3.0, None], "ffill_bfill") == [1.0, 1.0, 1.0, 3.0, 3.0]


def test_fill_across_days(spark):
    # one value late on day 1, gaps until day 2: the carry crosses the day boundary
    start = dt.datetime(2024, 1, 1, 23, 50)
    r = readings(spark, [7.0, None, None, None, 9.0], start=start)
    lo = int(start.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)
    g = align.fill(align.regular_grid(r, 5, bounds=(lo, lo + 4 * 300_000_000)), "ffill")
    assert [x.speed for x in g.orderBy("timestamp").collect()] == [7.0, 7.0, 7.0, 7.0, 9.0]


def test_history_fill_all_missing(spark):
    r = readings(spark, [5.0, None, None, None, 6.0])
    lo = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)
    g = align.regular_grid(r, 5, bounds=(lo, lo + 4 * 300_000_000))
    h = align.history_arrays(g.withColumn("speed", F.when(F.col("timestamp") < F.lit(T0 + dt.timedelta(minutes=20)),
                                                           F.lit(None).cast("double")).otherwise(F.col("speed"))),
                             5, 3).orderBy("timestamp").collect()
    assert [list(x.x) for x in h] == [[0.0, 0.0, 0.0], [0.0, 0.0, 0.0], [None, None, 6.0]]


def test_exact_grid_drops_off_grid(spark):
    rows = [(T0, "a", 1.0), (T0 + dt.timedelta(minutes=3), "a", 2.0), (T0 + dt.timedelta(minutes=10), "a", 3.0)]
    r = spark.createDataFrame(rows, "timestamp timestamp, edge_id string, speed double")
    g = align.regular_grid(r, 5).orderBy("timestamp").collect()
    assert [x.speed for x in g] == [1.0, None, 3.0]


def test_duplicates_average(spark):
    rows = [(T0, "a", 2.0), (T0, "a", 4.0)]
    r = spark.createDataFrame(rows, "timestamp timestamp, edge_id string, speed double")
    d = align.dedup_mean(r).collect()
    assert d[0].speed == 3.0 and d[0].n_obs == 2


def test_all_missing_sensor_vanishes(spark):
    rows = [(T0, "a", 1.0), (T0, "b", None), (T0 + dt.timedelta(minutes=5), "a", 2.0)]
    r = spark.createDataFrame(rows, "timestamp timestamp, edge_id string, speed double")
    assert {x.edge_id for x in align.regular_grid(r, 5).collect()} == {"a"}


def test_clip(spark):
    df = spark.createDataFrame([(-5.0,), (20.0,), (200.0,), (None,), (NAN,)], "x double")
    assert [r[0] for r in df.select(clip("x")).collect()] == [0.0, 20.0, 150.0, None, None]


def test_non_numeric_wide_cell(spark):
    df = spark.createDataFrame([("abc",), ("12.5",)], "s string")
    assert [r[0] for r in df.select(safe_double("s")).collect()] == [None, 12.5]


def test_percentile(spark):
    df = spark.createDataFrame([("a", v) for v in (1.0, 2.0, 3.0, 4.0, 10.0, None)], "edge_id string, speed double")
    st = features.sensor_stats(df, percentile=True).collect()[0]
    assert math.isclose(st.p90, 7.6)


def test_step_and_linear_weights(spark):
    df = spark.createDataFrame([(39.0,), (40.0,), (None,)], "v double")
    assert [r[0] for r in df.select(step_weight("v", F.lit(100.0))).collect()] == [2.0, 1.0, 1.0]
    df = spark.createDataFrame([(0.0,), (65.0,), (130.0,), (None,)], "v double")
    assert [r[0] for r in df.select(linear_weight("v")).collect()] == [5.0, 1.0, 1.0, None]


def test_constant_sensor_zscore(spark):
    r = readings(spark, [7.0, 7.0, 7.0])
    z = features.normalize(r, features.norm_params(features.sensor_stats(r)))
    assert [x.value for x in z.collect()] == [0.0, 0.0, 0.0]


def test_calendar(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 6),)], "timestamp timestamp")
    out = features.with_calendar(df).orderBy("timestamp").collect()
    assert [(r.day_of_week, r.is_weekend) for r in out] == [(0, 0), (5, 1)]


def test_ema(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "x array<double>")
    assert math.isclose(df.select(windows.ema("x", 0.3)).collect()[0][0], 1.81)


def test_ema_state_skips_missing(spark):
    r = readings(spark, [10.0, None, 20.0])
    lo = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)
    g = align.regular_grid(r, 5, bounds=(lo, lo + 600_000_000))
    assert math.isclose(serve.ema_state(g, 0.2).collect()[0].ema, 12.0)


@pytest.mark.parametrize("n,train,val", [(10, 7, 1), (20, 14, 3), (100, 70, 15)])
def test_split_bounds(n, train, val):
    a, b = features.split_bounds(n)
    assert (a, b - a) == (train, val)


def test_full_day():
    lo = int(dt.datetime(2024, 1, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1e6)
    hi = int(dt.datetime(2024, 1, 2, 23, tzinfo=dt.timezone.utc).timestamp() * 1e6)
    assert [align.day_ticks(lo, hi, 60, d) for d in (lo - 3600 * 10**6, lo + 23 * 3600 * 10**6)] == [23, 24]
    assert align.last_full_day_us(lo, hi, 60) == lo + 23 * 3600 * 10**6
    with pytest.raises(RuntimeError):
        align.last_full_day_us(lo, lo + 3600 * 10**6, 60)


def _two_days(spark, sensors=("a", "b"), missing=None):
    rows = []
    for i in range(2 * 288):
        t = T0 + dt.timedelta(minutes=5 * i)
        for s in sensors:
            v = None if missing == (s, i) else 50.0 + (i % 7)
            rows.append((t, s, v))
    return spark.createDataFrame(rows, "timestamp timestamp, edge_id string, speed double")


def test_window_counts(spark):
    r = _two_days(spark)
    lo = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)
    day = lo + 86_400_000_000
    g = align.regular_grid(r, 5)
    w12 = windows.sliding_windows(g, 5, 12, 12, label_day=F.timestamp_micros(F.lit(day)))
    w13 = windows.sliding_windows(g, 5, 12, 12, label_day=F.timestamp_micros(F.lit(day)),
                                  all_within_day=True, drop_missing=False)
    s12 = {r.label_start for r in w12.select("label_start").distinct().collect()}
    s13 = {r.label_start for r in w13.select("label_start").distinct().collect()}
    assert len(s12) == 277 and len(s13) == 265 and s13 <= s12


def test_one_missing_value_drops_for_all_sensors(spark):
    r = _two_days(spark, missing=("b", 300))
    lo = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)
    g = align.regular_grid(r, 5)
    w = windows.sliding_windows(g, 5, 12, 12, label_day=F.timestamp_micros(F.lit(lo + 86_400_000_000)))
    starts = {x.label_start for x in w.select("label_start").distinct().collect()}
    assert len(starts) == 277 - 24
    assert w.groupBy("label_start").count().where("count != 2").count() == 0


def test_prefix_steps_and_point_index():
    assert [windows.prefix_steps(12, h) for h in (15, 30, 45, 60)] == [3, 6, 9, 12]
    assert windows.prefix_steps(1, 60) == 1
    assert [i for _, i in windows.point_index(5, 12)] == [3, 6, 9, 12]
    assert [i for _, i in windows.point_index(15, 12)] == [1, 2, 3, 4]


def test_mean_of_rmses(spark):
    ts = [T0, T0 + dt.timedelta(hours=1)]
    w = spark.createDataFrame([(ts[0], "a", [0.0], [3.0, 3.0]), (ts[1], "a", [0.0], [1.0, 1.0])],
                              "label_start timestamp, edge_id string, x array<double>, y array<double>")
    per = forecast.window_metrics(w.withColumn("pred", F.lit(0.0)), 2, horizons=[60])
    rep = forecast.horizon_report(per).collect()[0]
    assert math.isclose(rep.rmse, 2.0)


def test_lookup_fallback(spark):
    req = spark.createDataFrame([(1, ["p", "s", "n", "p"], 15)], "request_id int, edge_ids array<string>, horizon int")
    pred = spark.createDataFrame([("p", 15, 1.5, T0)], "edge_id string, horizon int, value double, ts timestamp")
    latest = spark.createDataFrame([("p", 9.0, T0), ("s", 2.5, T0)], "edge_id string, speed double, ts timestamp")
    out = {r.edge_id: (r.value, r.source) for r in serve.lookup(req, pred, latest).collect()}
    assert out == {"p": (1.5, "pred"), "s": (2.5, "speed"), "n": (None, "none")}


def test_timestamp_parse(spark):
    df = spark.createDataFrame([("1704067200",), ("2024-01-01T00:00:00Z",), ("bad",)], "s string")
    assert [r[0] for r in df.select(parse_epoch_or_iso("s")).collect()] == [1704067200.0, 1704067200.0, None]


def test_health(spark):
    st = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0),)], "ts timestamp")
    now = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp()
    assert serve.freshness(st, now + 4).collect()[0].healthy is True
    assert serve.freshness(st, now + 6).collect()[0].healthy is False
    empty = spark.createDataFrame([], "ts timestamp")
    assert serve.freshness(empty, now).collect()[0].healthy is False


def test_edge_list_clean(spark):
    raw = spark.createDataFrame([("0", "1", "2"), ("0", "1", "5"), ("0", "9", "1"), ("1", "1", "7"), ("1", "0", "")],
                                "src string, dst string, w string")
    g = graph.with_self_loops(graph.clean_edges(graph.parse_edge_list(raw), 2), 2)
    assert {(r.src, r.dst, r.w) for r in g.collect()} == {(0, 1, 5.0), (1, 0, 1.0), (0, 0, 1.0), (1, 1, 1.0)}


def test_row_normalize(spark):
    e = spark.createDataFrame([(0, 1, 1.0), (0, 2, 3.0)], "src int, dst int, w double")
    assert sorted(r.w for r in graph.row_normalize(e).collect()) == [0.25, 0.75]


def test_neighbour_mix_ln2(spark):
    e = spark.createDataFrame([(0, 1, 1.0), (0, 0, 1.0), (1, 1, 1.0)], "src int, dst int, w double")
    v = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0)], "t int, node int, x double")
    out = {r.node: r.y for r in graph.neighbour_mix(v, e).collect()}
    assert math.isclose(out[0], 1.0 * (math.log(2) + 1))
    assert math.isclose(out[1], 1.0 * math.log(2) + 2.0 * (math.log(2) + 1))


def _line(spark, rows):
    return spark.createDataFrame(rows, "edge_id long, highway string, bearing double, "
                                       "geom array<struct<lon:double,lat:double>>")


def test_direction_filter(spark):
    sensors = spark.createDataFrame([(1, 37.5, -122.0, "H", "North")],
                                    "sensor_id long, latitude double, longitude double, highway string, direction string")
    edges = _line(spark, [(10, "m", -1.0, [(-122.0001, 37.49), (-122.0001, 37.51)]),
                          (11, "m", 1.0, [(-121.9995, 37.49), (-121.9995, 37.51)])])
    m = spatial.map_sensors(sensors, edges)["mapping"].collect()
    assert [(r.sensor_id, r.edge_id) for r in m] == [(1, 11)]


def test_idw_weights(spark):
    s = spark.createDataFrame([(1, 0.0, 0.01), (2, 0.0, 0.0199), (3, 0.0, 0.03), (4, 0.0, 0.0)],
                              "sensor_id long, latitude double, longitude double")
    t = spark.createDataFrame([(7, 0.0, 0.0)], "edge_id long, cx double, cy double")
    w = {r.sensor_id: r.weight for r in spatial.knn_idw(s.where("sensor_id != 4"), t).collect()}
    assert set(w) == {1, 2} and math.isclose(sum(w.values()), 1.0) and w[1] > 0.79
    w0 = {r.sensor_id: r.weight for r in spatial.knn_idw(s.where("sensor_id in (1, 4)"), t).collect()}
    assert w0 == {4: 1.0, 1: 0.0}


def test_unbounded_nearest(spark):
    s = spark.createDataFrame([(1, 37.5, -122.0)], "sensor_id long, latitude double, longitude double")
    edges = _line(spark, [(5, "m", 1.0, [(-121.9, 37.5), (-121.9, 37.6)]),
                          (6, "m", 1.0, [(-121.5, 37.5), (-121.5, 37.6)])])
    n = spatial.nearest_edge_unbounded(s, edges).collect()
    assert n[0].edge_id == 5 and math.isclose(n[0].dist, 0.1)


def test_top_k_salted(spark):
    rows = [(1, i, float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "edge_id long, sensor_id long, dist double")
    top = spatial.top_k(df, "edge_id", [F.col("dist"), F.col("sensor_id")], 5, "sensor_id", 8)
    assert sorted(r.sensor_id for r in top.collect()) == [0, 1, 2, 3, 4]


def test_identity_graph(spark):
    g = graph.identity_graph(spark, 3)
    assert {(r.src, r.dst, r.w) for r in g.collect()} == {(0, 0, 1.0), (1, 1, 1.0), (2, 2, 1.0)}


def test_exact_percentile_hot_key(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    hot = rng.normal(50, 10, 20000).round(2)
    rows = [("hot", float(v)) for v in hot] + [("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 4.0), ("a", 10.0),
                                               ("b", 5.0)]
    df = spark.createDataFrame(rows, "edge_id string, speed double").repartition(8)
    got = {r.edge_id: r.p for r in features.exact_percentile(df, "edge_id", "speed", 0.9).collect()}
    assert math.isclose(got["hot"], float(np.percentile(hot, 90)), rel_tol=1e-12)
    assert math.isclose(got["a"], 7.6) and got["b"] == 5.0


def test_halo_longer_than_a_day_is_refused(spark):
    r = readings(spark, [1.0, 2.0])
    with pytest.raises(ValueError):
        align.with_halo(align.regular_grid(r, 60).select("edge_id", "day", "timestamp", "speed"), 60, 30)


def test_ordered_split_irregular(spark):
    # 10 distinct irregular instants, two sensors each → 7 / 1 / 2 instants
    times = [T0 + dt.timedelta(minutes=m) for m in (0, 3, 4, 10, 11, 30, 31, 50, 90, 91)]
    rows = [(t, e, 1.0) for t in times for e in ("a", "b")]
    df = spark.createDataFrame(rows, "timestamp timestamp, edge_id string, speed double")
    out = features.ordered_split(df)
    per = {r.split: r["count"] for r in out.select("timestamp", "split").distinct().groupBy("split").count().collect()}
    assert per == {"train": 7, "val": 1, "test": 2}
    first_test = min(r.timestamp for r in out.where("split = 'test'").collect())
    assert first_test == times[8]


def test_shuffled_batches(spark):
    starts = [T0 + dt.timedelta(hours=i) for i in range(13)]
    w = spark.createDataFrame([(t, e, [1.0], [2.0]) for t in starts for e in ("a", "b")],
                              "label_start timestamp, edge_id string, x array<double>, y array<double>")
    b1 = windows.shuffled_batches(w, 5, seed=1)
    sizes = sorted(r["count"] for r in b1.select("label_start", "batch").distinct().groupBy("batch").count().collect())
    assert sizes == [3, 5, 5]
    again = {r.label_start: r.batch for r in windows.shuffled_batches(w, 5, seed=1).collect()}
    assert again == {r.label_start: r.batch for r in b1.collect()}


def test_percentile_of_a_hot_key_is_exact(spark):
    import random
    pick = random.Random(9)
    values = [round(pick.gauss(50, 20), pick.choice([0, 1, 6])) for _ in range(30_000)]
    few = [3.0, 1.0]
    df = spark.createDataFrame([("hot", v) for v in values] + [("few", v) for v in few] + [("same", 5.0)] * 9000, "k string, v double").repartition(6)
    for q in (0.9, 0.5, 0.0, 1.0, 0.123):
        got = {r.k: r.p for r in features.exact_percentile(df, "k", "v", q).collect()}
        for k, x in (("hot", sorted(values)), ("few", sorted(few)), ("same", [5.0] * 9000)):
            pos = q * (len(x) - 1)
            low = int(pos)
            want = x[low] + (pos - low) * (x[min(low + 1, len(x) - 1)] - x[low])
            assert math.isclose(got[k], want, rel_tol=1e-12), (k, q)
