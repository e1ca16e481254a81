"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each query reads the supplied tables through ``velograph.sources.tables`` and
runs over the whole tables; the DuckDB twin lives in ``velograph.plans.oracle``
under the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from velograph.plans import evaluation, mapping
from velograph.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__[2:]] = fn
    return fn


@query
def q_e2_heldout_eval(spark, sf):
    """Flagship (E2): EMA-baseline vs last-value MAE/RMSE per horizon, last full day."""
    return evaluation.heldout_evaluation(tables.readings(spark, sf), freq_minutes=60, recent=_recent(spark, sf))


def _recent(spark, sf, edge="event_type"):
    return lambda low, high: tables.readings(spark, sf, edge=edge, between=(low, high))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


# --------------------------------------------------------------------------- features
from pyspark.sql import functions as F  # noqa: E402

from velograph.functions.columns import round_to, to_ntz  # noqa: E402
from velograph.operators import align, features  # noqa: E402


def _user_readings(spark, sf):
    """Deduplicated hourly readings, one sensor per user (W3 mean per instant)."""
    return align.dedup_mean(tables.readings(spark, sf, edge="user")).drop("n_obs")


def _r6(c):
    return round_to(c, 6)


@query
def q_a01_sensor_stats(spark, sf):
    st = features.sensor_stats(_user_readings(spark, sf), percentile=True)
    return st.select("edge_id", "n", *[_r6(c).alias(c) for c in ("mu", "sigma", "min", "max", "p90")])


@query
def q_p02_zscore(spark, sf):
    r = _user_readings(spark, sf)
    z = features.normalize(r, features.norm_params(features.sensor_stats(r), "z_score"))
    return z.select("edge_id", to_ntz("timestamp").alias("timestamp"), _r6("value").alias("z"))


@query
def q_p04_minmax(spark, sf):
    r = _user_readings(spark, sf)
    z = features.normalize(r, features.norm_params(features.sensor_stats(r), "min_max"))
    return z.select("edge_id", to_ntz("timestamp").alias("timestamp"), _r6("value").alias("scaled"))


@query
def q_p06_denormalize(spark, sf):
    r = _user_readings(spark, sf)
    params = features.norm_params(features.sensor_stats(r), "z_score")
    back = features.denormalize(features.normalize(r, params), params)
    return back.select("edge_id", to_ntz("timestamp").alias("timestamp"),
                       _r6("value").alias("speed"))


@query
def q_p07_calendar(spark, sf):
    inst = tables.readings(spark, sf).select("timestamp").distinct()
    return features.with_calendar(inst).withColumn("timestamp", to_ntz("timestamp"))


@query
def q_p09_step_weight(spark, sf):
    r = _user_readings(spark, sf)
    w = features.congestion_step_weights(r)
    return w.select("edge_id", to_ntz("timestamp").alias("timestamp"), "weight")


@query
def q_p10_linear_weight(spark, sf):
    w = features.congestion_linear_weights(_user_readings(spark, sf))
    return w.select("edge_id", to_ntz("timestamp").alias("timestamp"), _r6("weight").alias("weight"))


@query
def q_a13_weight_summary(spark, sf):
    w = features.congestion_linear_weights(_user_readings(spark, sf))
    return features.weight_summary(w).select(_r6("avg_weight").alias("avg_weight"),
                                             _r6("max_weight").alias("max_weight"))


def _split_grid(spark, sf):
    r = tables.readings(spark, sf)
    lo, hi = align.grid_bounds(r)
    g = align.regular_grid(r, 60, bounds=(lo, hi))
    return features.ordered_split_grid(g, lo, hi, 60)


@query
def q_o04_ordered_split(spark, sf):
    g = _split_grid(spark, sf)
    return g.select("split", to_ntz("timestamp").alias("timestamp")).distinct()


@query
def q_a20_split_summary(spark, sf):
    s = features.split_summary(_split_grid(spark, sf))
    return s.select("split", "rows", to_ntz("first_ts").alias("first_ts"),
                    to_ntz("last_ts").alias("last_ts"), _r6("share").alias("share"))


@query
def q_a05_hourly_avg(spark, sf):
    h = features.hourly_average(align.dedup_mean(tables.readings(spark, sf)))
    return h.select("edge_id", "hour", _r6("avg_speed").alias("avg_speed"), "sample_count")


@query
def q_s20_profile(spark, sf):
    r = tables.readings(spark, sf)
    g = align.regular_grid(r, 60)
    p = features.profile(g)
    return p.select("n_rows", "n_sensors", "n_instants", to_ntz("first_ts").alias("first_ts"),
                    to_ntz("last_ts").alias("last_ts"), "n_missing")


# --------------------------------------------------------------------------- alignment & windows
from velograph.functions.columns import clip  # noqa: E402
from velograph.operators import forecast, windows  # noqa: E402


def _grid(spark, sf, method="ffill", edge="event_type"):
    r = tables.readings(spark, sf, edge=edge)
    g = align.fill(align.regular_grid(r, 60, carry=True), method)
    return g


def _grid_out(g, digits=6):
    return g.select("edge_id", to_ntz("timestamp").alias("timestamp"),
                    round_to("speed", digits).alias("speed"))


@query
def q_w03_duplicates(spark, sf):
    d = align.duplicate_instants(tables.readings(spark, sf))
    return d.select("edge_id", to_ntz("timestamp").alias("timestamp"),
                    _r6("speed").alias("speed"), "n_obs")


@query
def q_w04_grid_exact(spark, sf):
    g = align.regular_grid(tables.readings(spark, sf), 60)
    return g.select("edge_id", to_ntz("timestamp").alias("timestamp"),
                    _r6("speed").alias("speed"), "n_obs")


@query
def q_w04_grid_offgrid(spark, sf):
    """Minute-floored readings on a 5-minute exact grid: off-grid readings are dropped."""
    r = tables.readings(spark, sf, grain="minute")
    g = align.regular_grid(r, 5)
    return g.where(F.col("n_obs") > 0).select(
        "edge_id", to_ntz("timestamp").alias("timestamp"), _r6("speed").alias("speed"), "n_obs")


@query
def q_w04_grid_bucket(spark, sf):
    r = tables.readings(spark, sf, grain="minute")
    g = align.regular_grid(r, 30, align="bucket")
    return g.select("edge_id", to_ntz("timestamp").alias("timestamp"),
                    _r6("speed").alias("speed"), "n_obs")


@query
def q_w05_ffill(spark, sf):
    return _grid_out(_grid(spark, sf, "ffill", edge="user"))


@query
def q_w06_interpolate(spark, sf):
    return _grid_out(_grid(spark, sf, "interpolate", edge="user"))


@query
def q_w08_ffill_bfill(spark, sf):
    return _grid_out(_grid(spark, sf, "ffill_bfill", edge="user"))


@query
def q_p01_clip(spark, sf):
    g = align.to_regular(tables.readings(spark, sf), 60, "none")
    return _grid_out(g)


@query
def q_w09_history_fill(spark, sf):
    g = align.regular_grid(tables.readings(spark, sf), 60)
    h = align.history_fill(g, 60, 12)
    return h.select("edge_id", to_ntz("timestamp").alias("timestamp"), "slot",
                    _r6("value").alias("value"))


@query
def q_a07_ticks_per_day(spark, sf):
    t = align.ticks_per_day(tables.readings(spark, sf))
    return t.select(to_ntz("day").alias("day"), "ticks")


@query
def q_w11_grid_days(spark, sf):
    """Grid ticks per day and the full-day flag (steps/day from the step)."""
    t = align.grid_day_ticks(tables.readings(spark, sf), 60)
    return t.select(to_ntz("day").alias("day"), "ticks",
                    (F.col("ticks") == align.steps_per_day(60)).alias("is_full"))


@query
def q_w10_sampling_step(spark, sf):
    return align.sampling_step(tables.readings(spark, sf))


def _heldout(spark, sf):
    return evaluation.heldout_windows(tables.readings(spark, sf), 60, recent=_recent(spark, sf))


@query
def q_w12_windows(spark, sf):
    wl = windows.windows_long(_heldout(spark, sf))
    return wl.select(to_ntz("label_start").alias("label_start"), "edge_id", "role", "step",
                     _r6("value").alias("value"))


@query
def q_w13_windows_in_day(spark, sf):
    grid, day = evaluation.heldout_grid(tables.readings(spark, sf), 60, recent=_recent(spark, sf))
    w = windows.sliding_windows(grid, 60, 6, 6, label_day=day, all_within_day=True,
                                drop_missing=False)
    wl = windows.windows_long(w)
    return wl.select(to_ntz("label_start").alias("label_start"), "edge_id", "role", "step",
                     _r6("value").alias("value"))


@query
def q_w14_ema_forecast(spark, sf):
    w = forecast.ema_forecast(_heldout(spark, sf))
    return w.select(to_ntz("label_start").alias("label_start"), "edge_id", _r6("pred").alias("pred"))


@query
def q_w16_last_value(spark, sf):
    w = forecast.last_value_forecast(_heldout(spark, sf))
    return w.select(to_ntz("label_start").alias("label_start"), "edge_id", _r6("pred").alias("pred"))


@query
def q_a08_window_metrics(spark, sf):
    m = forecast.window_metrics(forecast.ema_forecast(_heldout(spark, sf)), 12)
    return m.select(to_ntz("label_start").alias("label_start"), "horizon", "steps",
                    _r6("mae").alias("mae"), _r6("rmse").alias("rmse"))


@query
def q_a10_step_node_mae(spark, sf):
    m = forecast.step_node_mae(forecast.ema_forecast(_heldout(spark, sf)))
    return m.select("step", "edge_id", _r6("mae").alias("mae"))


def _user_heldout(spark, sf):
    return evaluation.heldout_windows(tables.readings(spark, sf, edge="user"), 60,
                                      fill_method="ffill_bfill", recent=_recent(spark, sf, "user"))


@query
def q_o02_topk_nodes(spark, sf):
    m = forecast.step_node_mae(forecast.ema_forecast(_user_heldout(spark, sf)))
    t = forecast.top_k_nodes(m.withColumn("mae", _r6("mae")), step=12, k=20)
    return t.select("step", "edge_id", "mae")


@query
def q_a04_global_stats(spark, sf):
    s = forecast.global_stats(_heldout(spark, sf))
    return s.select(_r6("mean").alias("mean"), _r6("std").alias("std"))


def _train_windows(spark, sf):
    grid = align.fill(align.regular_grid(tables.readings(spark, sf), 60, carry=True), "ffill")
    return windows.sliding_windows(grid.withColumn("speed", clip("speed")), 60, 12, 12)


@query
def q_m04_residual_fit(spark, sf):
    m = forecast.fit_residual(_train_windows(spark, sf))
    return m.select("edge_id", "step", _r6("a").alias("a"), _r6("b").alias("b"), "n")


@query
def q_m03_residual_forecast(spark, sf):
    model = forecast.fit_residual(_train_windows(spark, sf))
    p = forecast.residual_forecast(_heldout(spark, sf), model)
    return p.select(to_ntz("label_start").alias("label_start"), "edge_id", "step",
                    _r6("pred").alias("pred"))


@query
def q_a14_smooth_l1(spark, sf):
    rows = forecast.label_steps(forecast.ema_forecast(_heldout(spark, sf)))
    return forecast.smooth_l1_loss(rows, 12).select(_r6("smooth_l1").alias("smooth_l1"))


@query
def q_c11_huber(spark, sf):
    rows = forecast.label_steps(forecast.ema_forecast(_heldout(spark, sf)))
    return forecast.huber_loss(rows).select(_r6("huber").alias("huber"))


@query
def q_c07_mape_weighted(spark, sf):
    from velograph.functions.columns import linear_weight
    rows = forecast.label_steps(forecast.ema_forecast(_heldout(spark, sf)))
    m = forecast.mape_weighted_mae(rows, linear_weight("y"))
    return m.select(_r6("mape").alias("mape"), _r6("weighted_mae").alias("weighted_mae"))


@query
def q_o03_first_windows(spark, sf):
    w = windows.first_n_windows(_heldout(spark, sf), 5)
    return w.select(to_ntz("label_start").alias("label_start"), "edge_id",
                    _r6(F.element_at("x", -1)).alias("x_last"), _r6(F.element_at("y", 1)).alias("y_first"))


# --------------------------------------------------------------------------- graph
from velograph.operators import graph, spatial  # noqa: E402

N_NATIONS = 25


def _clean_graph(spark, sf):
    return graph.clean_edges(tables.graph_edges(spark, sf), N_NATIONS)


@query
def q_g01_clean_edges(spark, sf):
    """G1/G2 on raw edges with ids out of range, repeats and weights below zero."""
    raw = tables.graph_edges(spark, sf)
    dirty = raw.unionByName(raw.select("src", "dst", (F.lit(2000.0) - F.col("w")).alias("w"))).select(
        (F.col("src") - 2).alias("src"), F.col("dst"), (F.col("w") - 1500.0).alias("w"))
    return graph.clean_edges(dirty, 20).select("src", "dst", _r6("w").alias("w"))


@query
def q_g03_self_loops(spark, sf):
    g = graph.with_self_loops(_clean_graph(spark, sf), N_NATIONS)
    return g.select("src", "dst", _r6("w").alias("w"))


@query
def q_g05_row_normalize(spark, sf):
    g = graph.row_normalize(graph.with_self_loops(_clean_graph(spark, sf), N_NATIONS))
    return g.select("src", "dst", round_to("w", 9).alias("w"))


@query
def q_g06_graph_stats(spark, sf):
    g = graph.with_self_loops(_clean_graph(spark, sf), N_NATIONS)
    return graph.graph_stats(g, N_NATIONS).select(
        "num_nodes", "num_edges", round_to("avg_degree", 9).alias("avg_degree"),
        round_to("density", 9).alias("density"))


def _nation_values(spark, sf):
    li = tables.table(spark, sf, "lineitem").select("l_suppkey", "l_quantity", "l_shipdate")
    su = tables.table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    j = li.join(su, li.l_suppkey == su.s_suppkey)
    return j.groupBy(F.date_trunc("MONTH", F.col("l_shipdate").cast("timestamp")).alias("t"),
                     F.col("s_nationkey").alias("node")).agg(F.sum("l_quantity").alias("x"))


@query
def q_g07_neighbour_mix(spark, sf):
    raw = materialize(tables.graph_edges(spark, sf), "g07-edges")  # a row per pair of nodes, for the mask and the weights
    g = graph.with_self_loops(graph.clean_edges(raw, N_NATIONS), N_NATIONS)
    w = raw.where("src <> 3").select("src", "dst", ((F.col("src") - F.col("dst")) / 10.0).alias("W"))
    y = graph.neighbour_mix(_nation_values(spark, sf), g, w)
    return y.select(to_ntz("t").alias("t"), "node", round_to("y", 4).alias("y"))


@query
def q_g08_node_index(spark, sf):
    return tables.graph_nodes(spark, sf)


# --------------------------------------------------------------------------- spatial


def _sensors(spark, sf):
    return spatial.sensor_table(tables.sensor_index(spark, sf))


def _mapping(spark, sf):
    s, e = _sensors(spark, sf), tables.road_edges(spark, sf)
    return s, e, spatial.map_sensors(s, e)


def _r9(c):
    return round_to(c, 9)


@query
def q_p08_sensor_table(spark, sf):
    """suppliers' ids and the same shifted into the range of the known sensors."""
    ids = tables.sensor_index(spark, sf)
    ids = ids.unionByName(ids.select((F.col("sensor_id") + 400000).alias("sensor_id"), "idx"))
    return spatial.sensor_table(ids).select("sensor_id", _r9("latitude").alias("latitude"),
                                      _r9("longitude").alias("longitude"), "highway", "direction")


@query
def q_j04_candidates(spark, sf):
    _, _, m = _mapping(spark, sf)
    return m["candidates"].select("sensor_id", "edge_id", _r9("dist").alias("dist"))


@query
def q_j06_mapping(spark, sf):
    _, _, m = _mapping(spark, sf)
    return m["mapping"].select("sensor_id", "edge_id", _r9("dist").alias("dist"))


@query
def q_j07_unmapped(spark, sf):
    return _mapping(spark, sf)[2]["unmapped"]


@query
def q_p20_status(spark, sf):
    return _mapping(spark, sf)[2]["status"]


@query
def q_j08_uncovered(spark, sf):
    return _mapping(spark, sf)[2]["uncovered"]


@query
def q_a12_edge_sensors(spark, sf):
    return spatial.edge_sensors(_mapping(spark, sf)[2]["mapping"])  # (edge_id, ordinal, sensor_id)


def _idw(spark, sf):
    s, e, m = _mapping(spark, sf)
    targets = spatial.edge_geometry(e).join(m["covered"], "edge_id", "left_anti")
    return s, e, m, spatial.knn_idw(s, targets.select("edge_id", "cx", "cy"))


@query
def q_j09_idw_weights(spark, sf):
    w = _idw(spark, sf)[3]
    return w.select("edge_id", "sensor_id", "rank", _r9("dist").alias("dist"), _r9("weight").alias("weight"))


@query
def q_j10_interp_summary(spark, sf):
    s = spatial.interpolation_summary(_idw(spark, sf)[3])
    return s.select("edge_id", "n_sensors", _r9("avg_distance_km").alias("avg_distance_km"))


@query
def q_j11_idw_speed(spark, sf):
    w = _idw(spark, sf)[3]
    ev = tables.readings(spark, sf, edge="user")
    speeds = align.dedup_mean(ev.withColumn("edge_id", F.expr("cast(substr(edge_id, 2) AS BIGINT)")))
    speeds = speeds.select(F.col("edge_id").alias("sensor_id"), "timestamp", "speed")
    out = spatial.idw_speed(w, speeds)
    return out.select("edge_id", to_ntz("timestamp").alias("timestamp"), _r6("speed").alias("speed"),
                      "n_sensors")


def _qa(spark, sf):
    s, e = _sensors(spark, sf), tables.road_edges(spark, sf)
    m = mapping.mapping_pipeline(s, e, run_at=PREDICTION_TS)
    return s, e, m, m["interp"], m["errors"]


@query
def q_j15_qa_errors(spark, sf):
    return spatial.first_errors(_qa(spark, sf)[4])


@query
def q_a11_mapping_stats(spark, sf):
    st = _qa(spark, sf)[2]["stats"]
    return st.select(*[_r9(c).alias(c) if c.endswith(("percent", "_km")) else F.col(c) for c in st.columns])


@query
def q_j16_mapping_detail(spark, sf):
    s, _, m = _mapping(spark, sf)
    d = spatial.mapping_detail(m["mapping"], s)
    return d.select("sensor_id", "edge_id", _r9("sensor_lat").alias("sensor_lat"),
                    _r9("sensor_lon").alias("sensor_lon"), "highway", "direction")


@query
def q_j14_split_candidates(spark, sf):
    s, e = _sensors(spark, sf), tables.road_edges(spark, sf)
    c = spatial.split_candidates(s, e)
    return c.select("sensor_id", "edge_id", _r9("dist").alias("dist"), _r9("length").alias("length"))


@query
def q_p11_major_roads(spark, sf):
    return spatial.major_roads(tables.road_edges(spark, sf)).select("edge_id", "highway")


@query
def q_p12_bbox(spark, sf):
    return spatial.in_bbox(_sensors(spark, sf)).select("sensor_id")


@query
def q_c06_geo_knn(spark, sf):
    a = spatial.geo_knn_adjacency(_sensors(spark, sf))
    return a.select("src", "dst", _r9("dist_km").alias("dist_km"))


# --------------------------------------------------------------------------- serving state
from velograph.operators import serve  # noqa: E402

NOW_EPOCH = 1706659200.0            # 2024-01-31T00:00:00Z, the evaluation "now" parameter
PREDICTION_TS = "2024-01-31 00:00:00"


@query
def q_t03_latest_state(spark, sf):
    s = serve.latest_state(_user_readings(spark, sf))
    return s.select("edge_id", _r6("speed").alias("speed"), to_ntz("ts").alias("ts"))


@query
def q_w15_ema_state(spark, sf):
    g = align.regular_grid(tables.readings(spark, sf, edge="user"), 60)
    s = serve.ema_state(g)
    return s.select("edge_id", _r6("ema").alias("ema"), to_ntz("ts").alias("ts"), "n")


def _pred_state(spark, sf):
    r = tables.readings(spark, sf)
    lo, hi = align.grid_bounds(r)
    # the newest 12-tick history needs at most the last two days of grid
    g = align.regular_grid(r, 60, bounds=(lo, hi), day_from_us=(hi // align.US_PER_DAY - 1) * align.US_PER_DAY)
    h = align.history_arrays(g, 60, 12).where(F.col("timestamp") == F.timestamp_micros(F.lit(hi)))
    h = h.withColumnRenamed("timestamp", "ts")
    return serve.prediction_state(h, 60, 12, serve.trend_forecaster("x", 12, windows.EVAL_EMA_ALPHA))


@query
def q_t06_pred_state(spark, sf):
    p = _pred_state(spark, sf)
    return p.select("edge_id", "horizon", _r6("value").alias("value"), to_ntz("ts").alias("ts"))


def _requests(spark, sf):
    """A request per sensor (and one for a sensor nobody knows) and horizon."""
    edges = tables.readings(spark, sf).select("edge_id").distinct()
    edges = edges.unionByName(spark.range(1).select(F.lit("unknown").alias("edge_id")))
    hz = F.array(*[F.struct(F.lit(i).alias("request_id"), F.lit(h).alias("horizon"))
                   for i, h in ((1, 15), (2, 20), (3, 60), (4, 90))])
    return edges.select(F.array("edge_id", "edge_id").alias("edge_ids"), F.explode(hz).alias("_r")).select(
        F.col("_r.request_id").alias("request_id"), "edge_ids", F.col("_r.horizon").alias("horizon"))


@query
def q_j02_lookup(spark, sf):
    latest = serve.latest_state(tables.readings(spark, sf))
    out = serve.stamp(serve.lookup(_requests(spark, sf), _pred_state(spark, sf), latest), 1, PREDICTION_TS)
    return out.select("request_id", "edge_id", "horizon", _r6("value").alias("value"), "source",
                      "model_generation", to_ntz("prediction_timestamp").alias("prediction_timestamp"))


@query
def q_p18_validate_requests(spark, sf):
    v = serve.validate_requests(_requests(spark, sf))
    return v.groupBy("request_id", "horizon", "valid", "reason").agg(F.count("*").alias("n"))


@query
def q_a15_freshness(spark, sf):
    latest = serve.latest_state(tables.readings(spark, sf))
    f = serve.freshness(latest, NOW_EPOCH)
    return f.select(to_ntz("last_ts").alias("last_ts"), _r6("age_s").alias("age_s"), "healthy")


@query
def q_a16_pred_count(spark, sf):
    return serve.prediction_count(_pred_state(spark, sf))


@query
def q_p21_metrics_text(spark, sf):
    latest = serve.latest_state(tables.readings(spark, sf))
    return serve.metrics_text(serve.freshness(latest, NOW_EPOCH),
                              serve.prediction_count(_pred_state(spark, sf)), 1)


@query
def q_p14_parse_instants(spark, sf):
    ev = tables.table(spark, sf, "events")
    t = F.col("ts").cast("timestamp")
    kinds = F.array(
        F.struct(F.lit("epoch").alias("kind"), F.unix_seconds(t).cast("string").alias("s")),
        F.struct(F.lit("iso").alias("kind"), F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("s")),
        F.struct(F.lit("bad").alias("kind"), F.col("props").alias("s")))
    x = ev.select("event_id", F.explode(kinds).alias("_k")).select("event_id", "_k.kind", "_k.s")
    return serve.parse_instants(x, "s").select("event_id", "kind", "epoch_s")


@query
def q_o05_capped_log(spark, sf):
    ev = tables.table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    return serve.capped_log(ev, cap=500).select(to_ntz("ts").alias("ts"))


@query
def q_s11_align_stats(spark, sf):
    """Statistics of all readings aligned to a sensor list that also has sensors without any."""
    r = tables.readings(spark, sf, edge="user")
    extra = tables.table(spark, sf, "supplier").select(F.concat(F.lit("u"), F.col("s_suppkey").cast("string"), F.lit("-new")).alias("edge_id"))
    sensors = r.select("edge_id").distinct().unionByName(extra)
    a = serve.align_stats(sensors, features.sensor_stats(r))
    return a.select("edge_id", _r6("mu").alias("mu"), _r6("sigma").alias("sigma"))


# --------------------------------------------------------------------------- sources
from velograph.sources import io as vio  # noqa: E402


@query
def q_s07_matrix_readings(spark, sf):
    r = vio.matrix_to_readings(tables.speed_matrix(spark, sf), 5)
    return r.select(to_ntz("timestamp").alias("timestamp"), "edge_id", _r6("speed").alias("speed"))


@query
def q_s05_normalize_wide(spark, sf):
    """Wide export of the hourly readings read back through normalisation."""
    r = align.dedup_mean(tables.readings(spark, sf)).drop("n_obs")
    sensors = sorted(x.edge_id for x in r.select("edge_id").distinct().collect())  # the columns of the wide table
    wide = vio.to_wide(r, sensors)
    back = vio.normalize_readings(wide.withColumnRenamed("timestamp", "ts"))
    return back.select(to_ntz("timestamp").alias("timestamp"), "edge_id", _r6("speed").alias("speed"))


# --------------------------------------------------------------------------- quality & remaining
from velograph.operators import quality  # noqa: E402


@query
def q_c03_range_flags(spark, sf):
    f = quality.range_flags(_user_readings(spark, sf))
    return f.groupBy("edge_id").agg(F.count_if("out_of_range").alias("n_out_of_range"),
                                    F.count("*").alias("n"))


@query
def q_c04_coverage(spark, sf):
    g = align.regular_grid(tables.readings(spark, sf, edge="user"), 60)
    c = quality.coverage_report(g)
    return c.select("edge_id", "ticks", "observed", _r6("coverage").alias("coverage"),
                    _r6("missing").alias("missing"), "passed")


@query
def q_c08_congestion_factor(spark, sf):
    r = _user_readings(spark, sf)
    ff = features.sensor_stats(r, percentile=True).select("edge_id", F.col("p90").alias("free_flow"))
    w = quality.congestion_factor_weights(r, ff)
    return w.select("edge_id", to_ntz("timestamp").alias("timestamp"), "weight")


@query
def q_c09_bias_correction(spark, sf):
    model = forecast.fit_residual(_train_windows(spark, sf))
    p = forecast.residual_forecast(_train_windows(spark, sf), model).where(F.col("step") == 1)
    res = p.select("edge_id", F.date_trunc("DAY", "label_start").alias("day"),
                   F.col("label_start").alias("timestamp"), (F.col("y") - F.col("pred")).alias("speed"))
    b = quality.bias_correction(res)
    return b.select("edge_id", _r6("bias").alias("bias"), to_ntz("ts").alias("ts"), "n")


@query
def q_c01_zero_fill(spark, sf):
    return _grid_out(_grid(spark, sf, "zero", edge="user"))


@query
def q_p03_zscore_unguarded(spark, sf):
    """Z-scores by the plain sample deviation; without spread (or with one reading) NULL."""
    r = _user_readings(spark, sf)
    st = features.sensor_stats(r).withColumn("sigma", F.col("sample_std"))
    z = features.normalize(r, features.norm_params(st, "z_score"), guard=False)
    return z.select("edge_id", to_ntz("timestamp").alias("timestamp"), _r6("value").alias("z"))


@query
def q_s21_norm_params(spark, sf):
    st = features.sensor_stats(_user_readings(spark, sf))
    p = features.norm_params(st, "z_score").unionByName(features.norm_params(st, "min_max"))
    return p.select("edge_id", "method", _r6("a").alias("a"), _r6("b").alias("b"))


@query
def q_a06_split_counts(spark, sf):
    s = _split_grid(spark, sf)
    return s.groupBy("split").agg(F.count("*").alias("n"))


@query
def q_a19_dataset_summary(spark, sf):
    s = _split_grid(spark, sf)
    kinds = ("train", "val", "test")
    per = s.groupBy("edge_id").agg(*(F.count_if(F.col("split") == k).alias(k) for k in kinds))
    counts = per.agg(F.count("edge_id").alias("num_sensors"), *(F.sum(k).alias(f"{k}_samples") for k in kinds))
    params = features.norm_params(features.sensor_stats(align.dedup_mean(tables.readings(spark, sf))), "z_score")
    norm = params.agg(F.min("method").alias("norm_method"), F.count("*").alias("norm_sensors"),
                      _r6(F.sum("a")).alias("norm_mean_sum"), _r6(F.sum("b")).alias("norm_std_sum"))
    gs = graph.graph_stats(graph.with_self_loops(_clean_graph(spark, sf), N_NATIONS), N_NATIONS)
    one = [c.select(F.struct(*c.columns).alias("r")).scalar() for c in (counts, norm)]  # one-row tables
    return gs.select(*(one[0][c].alias(c) for c in counts.columns), *(one[1][c].alias(c) for c in norm.columns), "num_nodes", "num_edges",
                     round_to("avg_degree", 9).alias("avg_degree"), round_to("density", 9).alias("density"))


@query
def q_c02_nearest_interp(spark, sf):
    s, e, m = _mapping(spark, sf)
    targets = spatial.edge_geometry(e).join(m["covered"], "edge_id", "left_anti")
    w = spatial.knn_idw(s, targets.select("edge_id", "cx", "cy"), k=1)
    return w.select("edge_id", "sensor_id", _r9("dist").alias("dist"), _r9("weight").alias("weight"))


@query
def q_o06_batches(spark, sf):
    """Seeded shuffle of training windows into batches of 512 label starts."""
    b = windows.shuffled_batches(_train_windows(spark, sf), 512, seed=0)
    return b.groupBy(to_ntz("label_start").alias("label_start"), "batch").agg(F.count("*").alias("rows"))


@query
def q_m02_score_with_callable(spark, sf):
    """M2: user forecaster through mapInPandas — here the last value."""
    import numpy as np

    def predict(x):
        return np.repeat(x[:, -1:], 12, axis=1)

    w = _heldout(spark, sf)
    g = forecast.global_stats(w).first()
    scored = forecast.score_with(w, predict, 12, 12, g["mean"], g["std"])
    return forecast.window_metrics(scored, 12).select(
        to_ntz("label_start").alias("label_start"), "horizon", _r6("mae").alias("mae"))


@query
def q_p22_input_jitter(spark, sf):
    """Gaussian input noise on window inputs, the same for a seed in any run."""
    j = forecast.jitter(_heldout(spark, sf), std=0.01, seed=7)
    x = j.select("label_start", "edge_id", F.posexplode("x").alias("slot", "v"))
    return x.select(to_ntz("label_start").alias("label_start"), "edge_id", (F.col("slot") + 1).alias("slot"), _r6("v").alias("v"))


@query
def q_p05_global_zscore(spark, sf):
    """P5: window inputs z-scored with the global X∪Y statistics (tiny std → 1)."""
    w = _heldout(spark, sf)
    g = forecast.global_stats(w)
    mean, std = g.select("mean").scalar(), g.select("std").scalar()
    z = w.select("label_start", "edge_id", F.posexplode("x").alias("slot", "v"))
    return z.select(to_ntz("label_start").alias("label_start"), "edge_id", (F.col("slot") + 1).alias("slot"),
                    _r6(forecast.zscore_global("v", mean, std, forecast.GLOBAL_STD_EPS)).alias("z"))


@query
def q_j01_node_positions(spark, sf):
    """Per-sensor error at the last step joined to node positions."""
    m = forecast.step_node_mae(forecast.ema_forecast(_user_heldout(spark, sf))).where(F.col("step") == 12)
    users = tables.table(spark, sf, "events").select("user_id").distinct()
    pos = spatial.sensor_table(users.select(F.col("user_id").alias("sensor_id"), F.col("user_id").alias("idx")))
    nodes = pos.select(F.concat(F.lit("u"), F.col("sensor_id").cast("string")).alias("node"),
                       F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    j = forecast.join_positions(m, nodes)
    return j.select("edge_id", _r9("lat").alias("lat"), _r9("lon").alias("lon"), _r6("mae").alias("mae"))


# --------------------------------------------------------------------------- files
from velograph.session import scratch_folder as _folder  # noqa: E402
from velograph.session import materialize  # noqa: E402
from velograph.sources import days  # noqa: E402
from velograph.streaming import replay  # noqa: E402


def _tall(r):
    return r.select(to_ntz("timestamp").alias("timestamp"), "edge_id", _r6("speed").alias("speed"))


@query
def q_s02_read_dir(spark, sf):
    """Readings dealt over CSV and Parquet files whose columns differ in order,
    type and number and whose suffixes differ in case, read from their folder and normalised."""
    r, root = tables.readings(spark, sf, grain="minute"), _folder(spark, "s02")
    part = F.pmod(F.minute("timestamp"), F.lit(4))
    r.where(part == 0).write.option("header", True).csv(f"{root}/a")
    r.where(part == 1).select("speed", F.lit("x").alias("note"), "edge_id", "timestamp").write.option("header", True).option("extension", "CSV").csv(f"{root}/a/b")
    r.where(part == 2).write.parquet(f"{root}/c")
    r.where(part == 3).select(F.lit(1).alias("lane"), "speed", "timestamp", "edge_id").write.parquet(f"{root}/c/d")
    return _tall(vio.normalize_readings(vio.read_dir(spark, root)))


@query
def q_s08_partitioned(spark, sf):
    """Parquet by date and hour, read back whole in time order."""
    root = _folder(spark, "s08")
    vio.write_partitioned(tables.readings(spark, sf, grain="minute"), root, by_hour=True)
    back = vio.read_partitioned(spark, root, view="readings_by_hour", ordered=True)
    return back.groupBy("date", "hour").agg(F.count("*").alias("n"), F.count("speed").alias("n_speed"), _r6(F.avg("speed")).alias("mean")) \
        .withColumn("date", F.col("date").cast("string")).orderBy("date", "hour")


@query
def q_s10_sidecar(spark, sf):
    """Statistics written beside the data and read back."""
    root = _folder(spark, "s10")
    vio.write_sidecar(features.sensor_stats(_user_readings(spark, sf)), root, 60)
    return vio.read_sidecar(spark, root).select("edge_id", _r6("mu").alias("mu"), _r6("sigma").alias("sigma"), "freq_minutes")


@query
def q_s12_window_files(spark, sf):
    """The held-out windows as a dataset with its parameters."""
    name = vio.write_windows(_heldout(spark, sf), _folder(spark, "s12"), 60, 60, 12)
    w = spark.read.parquet(name)
    return w.select(to_ntz("label_start").alias("label_start"), "edge_id", _r6(F.element_at("x", 1)).alias("x_first"),
                    _r6(F.element_at("y", 12)).alias("y_last"), "freq_minutes", "horizon_minutes", "t_in")


@query
def q_s14_edge_list(spark, sf):
    """An edge list as CSV, some weights left empty."""
    root, e = _folder(spark, "s14"), tables.graph_edges(spark, sf)
    e.select("src", "dst", F.when(F.col("src") % 3 > 0, F.col("w")).alias("w")).write.option("header", True).csv(root)
    return vio.read_edge_list(spark, root).select("src", "dst", _r6("w").alias("w"))


@query
def q_g02_crop(spark, sf):
    return graph.crop(_clean_graph(spark, sf), 10).select("src", "dst", _r6("w").alias("w"))


@query
def q_g04_identity(spark, sf):
    """A graph without edges has self-loops only; one node per row of the node table."""
    n = tables.graph_nodes(spark, sf).count()
    return graph.identity_graph(spark, n)


@query
def q_c02_linear_interp(spark, sf):
    s, e, m = _mapping(spark, sf)
    targets = spatial.edge_geometry(e).join(m["covered"], "edge_id", "left_anti")
    w = spatial.knn_idw(s, targets.select("edge_id", "cx", "cy"), power=1)
    return w.select("edge_id", "sensor_id", "rank", _r9("dist").alias("dist"), _r9("weight").alias("weight"))


@query
def q_c05_dimensions(spark, sf):
    """Sundays with an order count as holidays; limits and road types for known suppliers' sensors."""
    days = tables.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d"))
    events = tables.table(spark, sf, "events").select(F.to_date("ts").alias("date")).where(F.dayofweek("date") == 1)
    holidays = events.unionByName(days.select(F.col("d").alias("date")).where(F.dayofweek("date") == 1))
    k = F.col("s_suppkey")
    dims = tables.table(spark, sf, "supplier").select(
        F.concat(F.lit("u"), k.cast("string")).alias("edge_id"), (F.lit(25.0) + (k % 5) * 10.0).alias("speed_limit"),
        F.element_at(F.array(*[F.lit(c) for c in tables.ROAD_CLASSES]), (k % 6 + 1).cast("int")).alias("road_type"))
    d = features.with_dimensions(_user_readings(spark, sf), holidays, dims)
    return d.select("edge_id", to_ntz("timestamp").alias("timestamp"), "is_holiday", "speed_limit", "road_type")


@query
def q_c09_bias_applied(spark, sf):
    """One-step forecasts with the running residual bias added."""
    model = forecast.fit_residual(_train_windows(spark, sf))
    p = forecast.residual_forecast(_train_windows(spark, sf), model).where(F.col("step") == 1)
    p = p.select("edge_id", F.date_trunc("DAY", "label_start").alias("day"), F.col("label_start").alias("timestamp"), "y", "pred")
    c = quality.bias_corrected(p)
    return c.select("edge_id", to_ntz("timestamp").alias("timestamp"), round_to("bias", 5).alias("bias"), round_to("corrected", 5).alias("corrected"))


@query
def q_j15_qa_report(spark, sf):
    """Pass flag, number of errors and the first ten messages."""
    r = spatial.qa_report(_qa(spark, sf)[4])
    return r.select("validation_passed", "validation_errors", F.array_join("errors", "; ").alias("errors"))


# --------------------------------------------------------------------------- drained streams


def _drained(spark, sf, name, job, mode, sink_of, rows=None, schema=replay.LONG_SCHEMA):
    """Write the hourly grid (or ``rows``) by date and drain ``job`` over it, eight days a batch."""
    root = _folder(spark, name)
    rows = _hourly(spark, sf) if rows is None else rows
    vio.write_partitioned(rows, f"{root}/days")
    source = days.day_stream(spark, f"{root}/days", schema, days_per_batch=8)
    replay.run_drained(job(source), f"{root}/checkpoint", mode, sink_of(f"{root}/state"))
    return f"{root}/state"


def _hourly(spark, sf):
    return align.regular_grid(tables.readings(spark, sf), 60).select("edge_id", "timestamp", "speed")


def _upsert(spark, keys, order="ts"):
    return lambda path: replay.StateTable(spark, path, keys, order).upsert


@query
def q_t03_stream_latest(spark, sf):
    path = _drained(spark, sf, "t03", replay.latest_stream, "update", _upsert(spark, ["edge_id"]))
    s = replay.StateTable(spark, path, ["edge_id"]).read()
    return s.select("edge_id", _r6("speed").alias("speed"), to_ntz("ts").alias("ts"))


@query
def q_t04_stream_ema(spark, sf):
    path = _drained(spark, sf, "t04", replay.ema_stream, "update", _upsert(spark, ["edge_id"]))
    s = replay.StateTable(spark, path, ["edge_id"]).read()
    return s.select("edge_id", _r6("ema").alias("ema"))


@query
def q_t05_stream_forecast(spark, sf):
    path = _drained(spark, sf, "t05", lambda src: replay.forecast_stream(src, 60), "update", _upsert(spark, ["edge_id", "horizon"]))
    s = replay.StateTable(spark, path, ["edge_id", "horizon"]).read()
    return s.select("edge_id", "horizon", _r6("value").alias("value"), to_ntz("ts").alias("ts"))


@query
def q_t06_stream_per_sensor(spark, sf):
    """A linear model on histories normalised by each sensor's own mean and spread."""
    import numpy as np
    stats = materialize(features.sensor_stats(_hourly(spark, sf)).select("edge_id", "mu", "sigma"), "t06-stats")

    def job(src):
        return replay.forecast_stream(src, 60, predict=lambda x: 0.8 * x[:, -1:] + 0.1 * np.arange(1, 13), stats=stats)

    path = _drained(spark, sf, "t06", job, "update", _upsert(spark, ["edge_id", "horizon"]))
    s = replay.StateTable(spark, path, ["edge_id", "horizon"]).read()
    return s.select("edge_id", "horizon", _r6("value").alias("value"), to_ntz("ts").alias("ts"))


@query
def q_t09_live_lookup(spark, sf):
    """A request per event, for its sensor and now and then one nobody knows, answered
    by a running stream from the state at its instant."""
    ev = tables.table(spark, sf, "events")
    requests = ev.select(F.col("event_id").alias("request_id"), (15 * (1 + F.col("user_id") % 5)).cast("int").alias("horizon"),
                         F.col("ts").cast("timestamp").alias("timestamp"),
                         F.array_compact(F.array("event_type", "event_type", F.when(F.col("user_id") % 7 == 0, "unknown"))).alias("edge_ids"))
    rows = _hourly(spark, sf).withColumns({"request_id": F.lit(None).cast("long"), "horizon": F.lit(None).cast("int")})
    events = rows.unionByName(replay.requested(requests))

    def sink_of(path):
        return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    path = _drained(spark, sf, "t09", lambda src: replay.live_lookup(src, 60), "append", sink_of, events,
                    replay.LONG_SCHEMA + ", request_id long, horizon int")
    out = spark.read.parquet(path)
    return out.select("request_id", "edge_id", "horizon", _r6("value").alias("value"), "source", to_ntz("ts").alias("ts"))


@query
def q_t07_stream_freshness(spark, sf):
    path = _drained(spark, sf, "t07", lambda src: replay.freshness_stream(src).withColumn("kind", F.lit("last_ts")), "complete",
                    _upsert(spark, ["kind"], "last_ts"))
    return replay.StateTable(spark, path, ["kind"], "last_ts").read().select("kind", to_ntz("last_ts").alias("last_ts"))


@query
def q_t08_stream_log(spark, sf):
    path = _drained(spark, sf, "t08", lambda src: src, "append", lambda path: replay.capped_log_sink(spark, path, cap=100))
    return replay.StateTable(spark, path, ["timestamp"], "timestamp").read().select(to_ntz("timestamp").alias("ts"))


@query
def q_t10_stream_average(spark, sf):
    """Watermarked tumbling averages of six hours; windows that the watermark has passed."""
    path = _drained(spark, sf, "t10", lambda src: replay.average_stream(src, 360, 60).withColumnRenamed("timestamp", "ts"), "append",
                    _upsert(spark, ["edge_id", "ts"], "n"))
    s = replay.StateTable(spark, path, ["edge_id", "ts"], "n").read()
    return s.select("edge_id", to_ntz("ts").alias("ts"), _r6("speed").alias("speed"), "n")


@query
def q_s16_sensor_files(spark, sf):
    """Sensor metadata and the id → index map, written and read back."""
    index = tables.sensor_index(spark, sf)
    out = vio.write_sensors(spatial.sensor_table(index), index, _folder(spark, "s16"))
    meta = spark.read.option("header", True).schema("sensor_id long, latitude double, longitude double, highway string, direction string").csv(out["metadata"])
    idx = spark.read.schema("sensor_id long, idx long").json(out["index"])
    return meta.join(idx, "sensor_id").select("sensor_id", "idx", _r9("latitude").alias("latitude"), _r9("longitude").alias("longitude"), "highway", "direction")


# --------------------------------------------------------------------------- further forms


@query
def q_a03_sketch_percentile(spark, sf):
    """A3 from mergeable daily sketches: days and readings per sensor, and whether the
    value's true rank is within one percent (or one reading) of the 90th percentile."""
    r = _user_readings(spark, sf)
    p = features.sketch_percentile(features.daily_sketches(r), 0.9, "p90")
    ranks = r.join(p, "edge_id").groupBy("edge_id", "n_days", "n").agg(
        F.count_if(F.col("speed") < F.col("p90")).alias("below"), F.count_if(F.col("speed") <= F.col("p90")).alias("upto"))
    slack = F.greatest(F.lit(0.01) * F.col("n"), F.lit(1.0))
    return ranks.select("edge_id", "n_days", "n", ((F.col("below") - slack <= 0.9 * F.col("n")) & (0.9 * F.col("n") <= F.col("upto") + slack)).alias("within"))


@query
def q_m02_model_file(spark, sf):
    """M2: the residual model's coefficients as a file that each worker loads once, on
    histories normalised by each sensor's own mean and spread."""
    import json

    import numpy as np
    w = _heldout(spark, sf)
    train = _train_windows(spark, sf)
    stats = features.sensor_stats(train.select("edge_id", F.element_at("x", -1).alias("speed"), F.col("label_start").alias("timestamp")))
    path = _folder(spark, "m02") + "/model"
    slopes = forecast.fit_residual(train).groupBy("step").agg(F.avg("a").alias("a"), F.avg("b").alias("b"))  # twelve rows
    slopes.coalesce(1).write.json(path)

    def load(folder):
        import pathlib
        rows = sorted((json.loads(x) for f in pathlib.Path(folder).glob("*.json") for x in f.read_text().splitlines()), key=lambda r: r["step"])
        b = np.array([r["b"] for r in rows])
        return lambda x: x[:, -1:] + (x[:, -1:] - x[:, -2:-1]) * b

    scored = forecast.score_with_artifact(w, path, load, 12, stats)
    return forecast.window_metrics(scored, 12).select(to_ntz("label_start").alias("label_start"), "horizon", round_to("mae", 5).alias("mae"))


def _z_windows(spark, sf):
    """W13 on z-scores: windows of six and six hours inside the last full day, gaps kept."""
    r = align.dedup_mean(tables.readings(spark, sf)).drop("n_obs")
    stats = features.sensor_stats(r)
    z = features.normalize(r, features.norm_params(stats)).select("timestamp", "edge_id", F.col("value").alias("speed"))
    lo, hi = align.grid_bounds(r)
    day = align.last_full_day_us(lo, hi, 60)
    grid = align.regular_grid(z, 60, day_from_us=day, day_to_us=day, bounds=(lo, hi))
    return stats, windows.sliding_windows(grid, 60, 6, 6, label_day=F.timestamp_micros(F.lit(day)), all_within_day=True, drop_missing=False)


@query
def q_w13_windows_normalized(spark, sf):
    wl = windows.windows_long(_z_windows(spark, sf)[1])
    return wl.select(to_ntz("label_start").alias("label_start"), "edge_id", "role", "step", _r6("value").alias("value"))


@query
def q_m06_error_units(spark, sf):
    """M6: last-value errors per step and sensor, in z-scores and in speeds."""
    stats, w = _z_windows(spark, sf)
    e = forecast.in_speed_units(forecast.step_node_mae(w.withColumn("pred", windows.last_value("x"))), stats)
    return e.select("step", "edge_id", _r6("mae").alias("mae"), _r6("mae_speed").alias("mae_speed"))


@query
def q_s01_read_table(spark, sf):
    """One table as CSV and as Parquet, each read by its suffix."""
    r, root = tables.readings(spark, sf, grain="minute"), _folder(spark, "s01")
    r.write.option("header", True).csv(f"{root}/r.CSV")
    r.write.parquet(f"{root}/r.pq")
    both = [vio.normalize_readings(vio.read_table(spark, f"{root}/r.{x}")).withColumn("kind", F.lit(x.lower())) for x in ("CSV", "pq")]
    return both[0].unionByName(both[1]).select("kind", to_ntz("timestamp").alias("timestamp"), "edge_id", _r6("speed").alias("speed"))


@query
def q_s18_reports(spark, sf):
    """A report as CSV, JSON and Parquet, read back."""
    root, report = _folder(spark, "s18"), features.hourly_average(tables.readings(spark, sf, grain="minute").where("speed IS NOT NULL"))
    schema = "edge_id string, hour int, avg_speed double, sample_count long"
    out = []
    for kind in ("csv", "json", "parquet"):
        vio.write_report(report, f"{root}/{kind}", kind)
        out.append(spark.read.format(kind).schema(schema).options(**({"header": True} if kind == "csv" else {})).load(f"{root}/{kind}").withColumn("kind", F.lit(kind)))
    both = out[0].unionByName(out[1]).unionByName(out[2])
    return both.select("kind", "edge_id", "hour", _r6("avg_speed").alias("avg_speed"), "sample_count")


@query
def q_t02_stream_long(spark, sf):
    """Hourly wide ticks as a stream of long rows, missing values kept."""
    sensors = [r.edge_id for r in tables.readings(spark, sf).select("edge_id").distinct().orderBy("edge_id").collect()]  # columns of a wide table
    wide = vio.to_wide(_hourly(spark, sf), sensors)
    schema = "timestamp timestamp, " + ", ".join(f"`{s}` double" for s in sensors)

    def sink_of(path):
        return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    path = _drained(spark, sf, "t02", lambda src: replay.wide_to_long(src, sensors), "append", sink_of, wide, schema)
    return spark.read.parquet(path).select("edge_id", to_ntz("timestamp").alias("timestamp"), _r6("speed").alias("speed"))


@query
def q_o04_irregular_split(spark, sf):
    """An ordered split at 70 and 85 % of the different instants of raw readings."""
    r = features.ordered_split(tables.readings(spark, sf, grain="minute"))
    return r.groupBy("split").agg(F.count("*").alias("rows"), F.min(to_ntz("timestamp")).alias("first_ts"), F.max(to_ntz("timestamp")).alias("last_ts"))
