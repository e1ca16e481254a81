"""DuckDB twins of the registered queries (the correctness oracle).

Plain ANSI-ish SQL over the pre-registered tables. Shared CTE fragments are
built by small helpers so each query states the same formulas as its Spark
counterpart. Computed doubles are rounded the same way on both sides.
"""

from __future__ import annotations


def readings_sql(grain: str = "hour", edge: str = "event_type") -> str:
    edge_expr = "event_type" if edge == "event_type" else "'u' || CAST(user_id AS VARCHAR)"
    return (f"SELECT date_trunc('{grain}', ts) AS timestamp, {edge_expr} AS edge_id, "
            f"CASE WHEN isnan(value) THEN NULL ELSE value END AS speed FROM events")


def grid_ctes(freq: int, grain: str = "hour", edge: str = "event_type", align: str = "exact") -> str:
    """CTEs r (readings), b (bounds), d (on-grid mean), ticks, edges, g (grid)."""
    step_us = freq * 60_000_000
    if align == "exact":
        dsel = ("SELECT r.edge_id, r.timestamp, avg(r.speed) AS speed, count(r.speed) AS n_obs "
                "FROM r, b WHERE r.speed IS NOT NULL AND "
                f"(epoch_us(r.timestamp) - epoch_us(b.lo)) % {step_us} = 0 GROUP BY 1, 2")
    else:
        dsel = ("SELECT r.edge_id, make_timestamp(epoch_us(b.lo) + "
                f"floor((epoch_us(r.timestamp) - epoch_us(b.lo)) / {step_us})::BIGINT * {step_us}) "
                "AS timestamp, avg(r.speed) AS speed, count(r.speed) AS n_obs "
                "FROM r, b WHERE r.speed IS NOT NULL GROUP BY 1, 2")
    return f"""r AS ({readings_sql(grain, edge)}),
b AS (SELECT min(timestamp) AS lo, max(timestamp) AS hi FROM r WHERE speed IS NOT NULL),
d AS ({dsel}),
ticks AS (SELECT unnest(generate_series(lo, hi, INTERVAL {freq} MINUTE)) AS timestamp FROM b),
edges AS (SELECT DISTINCT edge_id FROM r WHERE speed IS NOT NULL),
g AS (SELECT e.edge_id, t.timestamp, d.speed, coalesce(d.n_obs, 0) AS n_obs
      FROM edges e CROSS JOIN ticks t LEFT JOIN d ON d.edge_id = e.edge_id AND d.timestamp = t.timestamp)"""


def clip_sql(x: str, lo: float = 0.0, hi: float = 150.0) -> str:
    return (f"CASE WHEN {x} IS NULL OR isnan({x}) THEN NULL "
            f"ELSE greatest({lo!r}::DOUBLE, least({hi!r}::DOUBLE, {x})) END")


FFILL = ("last_value(speed IGNORE NULLS) OVER (PARTITION BY edge_id ORDER BY timestamp "
         "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")


def full_day_cte(freq: int) -> str:
    per_day = 1440 // freq
    return (f"full_day AS (SELECT max(day) AS day FROM (SELECT date_trunc('day', timestamp) AS day, "
            f"count(*) AS c FROM ticks GROUP BY 1) WHERE c = {per_day})")


FILL_SQL = {
    "ffill": "coalesce(speed, pv)",
    "ffill_bfill": "coalesce(speed, pv, nv)",
    "none": "speed",
    "interpolate": ("CASE WHEN speed IS NOT NULL THEN speed WHEN pv IS NOT NULL AND nv IS NOT NULL "
                    "THEN pv + (nv - pv) * ((epoch_us(timestamp) - pt)::DOUBLE / (nt - pt)::DOUBLE) "
                    "ELSE coalesce(pv, nv) END"),
}


def filled_cte(method: str, src: str = "g", name: str = "gf") -> str:
    """``name`` = ``src`` with ``speed`` filled by ``method`` (whole-history windows)."""
    return f"""{name} AS (SELECT edge_id, timestamp, {FILL_SQL[method]} AS speed FROM (
  SELECT edge_id, timestamp, speed,
    last_value(CASE WHEN speed IS NOT NULL THEN epoch_us(timestamp) END IGNORE NULLS) OVER wf AS pt,
    last_value(speed IGNORE NULLS) OVER wf AS pv,
    first_value(CASE WHEN speed IS NOT NULL THEN epoch_us(timestamp) END IGNORE NULLS) OVER wb AS nt,
    first_value(speed IGNORE NULLS) OVER wb AS nv
  FROM {src}
  WINDOW wf AS (PARTITION BY edge_id ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         wb AS (PARTITION BY edge_id ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)))"""


def windows_ctes(freq: int, t_in: int = 12, t_out: int = 12, grain: str = "hour",
                 edge: str = "event_type", fill: str = "ffill", heldout: bool = True,
                 within_day: bool = False, drop_missing: bool = True) -> str:
    """... f (filled+clipped grid), w (candidate windows), win (kept windows)."""
    xs = ", ".join(f"lag(v, {k}) OVER ww" for k in range(t_in, 0, -1))
    ys = ", ".join(["v"] + [f"lead(v, {k}) OVER ww" for k in range(1, t_out)])
    conds = ["t0 IS NOT NULL", "t1 IS NOT NULL"]
    if heldout:
        conds.append("date_trunc('day', t1) = date_trunc('day', label_start)")
        conds.append("date_trunc('day', label_start) = (SELECT day FROM full_day)")
    if within_day:
        conds.append("date_trunc('day', t0) = date_trunc('day', label_start)")
    keep = ("SELECT wd.label_start, wd.edge_id, wd.x, wd.y FROM wd SEMI JOIN ok USING (label_start)"
            if drop_missing else "SELECT label_start, edge_id, x, y FROM wd")
    return f"""{grid_ctes(freq, grain, edge)},
{full_day_cte(freq)},
{filled_cte(fill)},
f AS (SELECT edge_id, timestamp, {clip_sql('speed')} AS v FROM gf),
w AS (SELECT edge_id, timestamp AS label_start, [{xs}] AS x, [{ys}] AS y,
        lag(timestamp, {t_in}) OVER ww AS t0, lead(timestamp, {t_out - 1}) OVER ww AS t1
      FROM f WINDOW ww AS (PARTITION BY edge_id ORDER BY timestamp)),
wd AS (SELECT * FROM w WHERE {' AND '.join(conds)}),
ok AS (SELECT label_start FROM wd GROUP BY 1
       HAVING bool_and(list_count(x) = {t_in} AND list_count(y) = {t_out})),
win AS ({keep})"""


def ema_sql(x: str, alpha: float) -> str:
    a, b = float(alpha), float(1.0 - alpha)
    return f"list_reduce({x}, lambda e, v: {a!r}::DOUBLE * v + {b!r}::DOUBLE * e)"


#: Label steps scored per horizon, by T_out (60 / T_out minutes a step): stated here, not taken from the code under test.
PREFIX_STEPS = {12: "(15, 3), (30, 6), (45, 9), (60, 12)"}


def horizons_values(t_out: int) -> str:
    return f"(VALUES {PREFIX_STEPS[t_out]}) AS hz(horizon, steps)"


def _q_e2_heldout_eval() -> str:
    return f"""WITH {windows_ctes(60)},
p AS (SELECT label_start, edge_id, y, {clip_sql(ema_sql('x', 0.3))} AS pred,
             {clip_sql('x[-1]')} AS p_last FROM win),
s AS (SELECT label_start, edge_id, pred, p_last, unnest(y) AS y, unnest(range(1, 13)) AS step FROM p),
pw AS (SELECT label_start, horizon, steps,
              avg(abs(pred - y)) AS ema_mae, sqrt(avg((pred - y) * (pred - y))) AS ema_rmse,
              avg(abs(p_last - y)) AS last_mae, sqrt(avg((p_last - y) * (p_last - y))) AS last_rmse
       FROM s JOIN {horizons_values(12)} ON s.step <= hz.steps GROUP BY 1, 2, 3)
SELECT horizon, steps, count(*) AS n_windows, round(avg(ema_mae), 6) AS ema_mae,
       round(avg(ema_rmse), 6) AS ema_rmse, round(avg(last_mae), 6) AS last_mae,
       round(avg(last_rmse), 6) AS last_rmse
FROM pw GROUP BY 1, 2"""


def two_stage_round(sql: str) -> str:
    """Rewrite every ``round(E, d)`` as ``round(round(E, d + 3), d)`` (see ``round_to``)."""
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k, comma = 1, j + len(key), -1
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        inner, digits = sql[j + len(key):comma], sql[comma + 1:k - 1].strip()
        out.append(sql[i:j])
        out.append(f"round(round({two_stage_round(inner)}, {int(digits) + 3}), {digits})")
        i = k


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, fn in globals().items():
        if name.startswith("_q_") and callable(fn):
            out[name[3:]] = two_stage_round(fn())
    return out


# --------------------------------------------------------------------------- features
USER_DEDUP = (f"ud AS (SELECT edge_id, timestamp, avg(speed) AS speed FROM ({readings_sql('hour', 'user')}) "
              "WHERE speed IS NOT NULL GROUP BY 1, 2)")
USER_STATS = ("st AS (SELECT edge_id, count(speed) AS n, avg(speed) AS mu, "
              "CASE WHEN coalesce(stddev_samp(speed), 1.0) = 0 THEN 1.0 ELSE coalesce(stddev_samp(speed), 1.0) END AS sigma, "
              "min(speed) AS min, max(speed) AS max, quantile_cont(speed, 0.9) AS p90 FROM ud GROUP BY 1)")


def _q_a01_sensor_stats():
    return (f"WITH {USER_DEDUP}, {USER_STATS} SELECT edge_id, n, round(mu, 6) AS mu, round(sigma, 6) AS sigma, "
            "round(min, 6) AS min, round(max, 6) AS max, round(p90, 6) AS p90 FROM st")


def _q_p02_zscore():
    return (f"WITH {USER_DEDUP}, {USER_STATS} SELECT edge_id, timestamp, "
            "round((speed - mu) / sigma, 6) AS z FROM ud JOIN st USING (edge_id)")


def _q_p04_minmax():
    return (f"WITH {USER_DEDUP}, {USER_STATS} SELECT edge_id, timestamp, "
            "round((speed - min) / CASE WHEN max - min <> 0 THEN max - min END, 6) AS scaled "
            "FROM ud JOIN st USING (edge_id)")


def _q_p06_denormalize():
    return (f"WITH {USER_DEDUP}, {USER_STATS} SELECT edge_id, timestamp, "
            "round(((speed - mu) / sigma) * sigma + mu, 6) AS speed FROM ud JOIN st USING (edge_id)")


def _q_p07_calendar():
    return (f"WITH i AS (SELECT DISTINCT timestamp FROM ({readings_sql()})) "
            "SELECT timestamp, hour(timestamp)::INTEGER AS hour, minute(timestamp)::INTEGER AS minute, "
            "(hour(timestamp) * 60 + minute(timestamp))::DOUBLE / 1440.0::DOUBLE AS time_of_day, "
            "(isodow(timestamp) - 1)::INTEGER AS day_of_week, "
            "CASE WHEN isodow(timestamp) - 1 >= 5 THEN 1 ELSE 0 END AS is_weekend, "
            "month(timestamp)::INTEGER AS month FROM i")


def _q_p09_step_weight():
    return (f"WITH {USER_DEDUP}, {USER_STATS} SELECT edge_id, timestamp, "
            "CASE WHEN speed / greatest(p90, 1.0::DOUBLE) < 0.4::DOUBLE THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight "
            "FROM ud LEFT JOIN st USING (edge_id)")


LINEAR_W = ("1.0::DOUBLE + 4.0::DOUBLE * (1.0::DOUBLE - " +
            "CASE WHEN speed / 65.0::DOUBLE IS NULL OR isnan(speed / 65.0::DOUBLE) THEN NULL "
            "ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE, speed / 65.0::DOUBLE)) END)")


def _q_p10_linear_weight():
    return f"WITH {USER_DEDUP} SELECT edge_id, timestamp, round({LINEAR_W}, 6) AS weight FROM ud"


def _q_a13_weight_summary():
    return (f"WITH {USER_DEDUP}, w AS (SELECT edge_id, {LINEAR_W} AS weight FROM ud), "
            "per AS (SELECT edge_id, avg(weight) AS w, max(weight) AS m FROM w GROUP BY 1) "
            "SELECT round(avg(w), 6) AS avg_weight, round(max(m), 6) AS max_weight FROM per")


SPLIT_CTE = ("sp AS (SELECT timestamp, CASE WHEN rn < floor(n * 0.7::DOUBLE) THEN 'train' "
             "WHEN rn < floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split "
             "FROM (SELECT timestamp, row_number() OVER (ORDER BY timestamp) - 1 AS rn, count(*) OVER () AS n FROM ticks))")


def _q_o04_ordered_split():
    return f"WITH {grid_ctes(60)}, {SPLIT_CTE} SELECT split, timestamp FROM sp"


def _q_a20_split_summary():
    return (f"WITH {grid_ctes(60)}, {SPLIT_CTE}, "
            "per AS (SELECT split, count(*) AS rows, min(g.timestamp) AS first_ts, max(g.timestamp) AS last_ts "
            "FROM g JOIN sp USING (timestamp) GROUP BY 1) "
            "SELECT split, rows, first_ts, last_ts, round(rows / sum(rows) OVER (), 6) AS share FROM per")


def _q_a05_hourly_avg():
    return (f"WITH d AS (SELECT edge_id, timestamp, avg(speed) AS speed FROM ({readings_sql()}) "
            "WHERE speed IS NOT NULL GROUP BY 1, 2) SELECT edge_id, hour(timestamp)::INTEGER AS hour, "
            "round(avg(speed), 6) AS avg_speed, count(*) AS sample_count FROM d GROUP BY 1, 2")


def _q_s20_profile():
    return (f"WITH {grid_ctes(60)} SELECT count(*) AS n_rows, count(DISTINCT edge_id) AS n_sensors, "
            "count(DISTINCT timestamp) AS n_instants, min(timestamp) AS first_ts, max(timestamp) AS last_ts, "
            "count(*) FILTER (WHERE speed IS NULL) AS n_missing FROM g")


# --------------------------------------------------------------------------- alignment & windows
def _q_w03_duplicates():
    return (f"SELECT edge_id, timestamp, round(avg(speed), 6) AS speed, count(speed) AS n_obs "
            f"FROM ({readings_sql()}) WHERE speed IS NOT NULL GROUP BY 1, 2 HAVING count(speed) > 1")


def _q_w04_grid_exact():
    return f"WITH {grid_ctes(60)} SELECT edge_id, timestamp, round(speed, 6) AS speed, n_obs FROM g"


def _q_w04_grid_offgrid():
    return (f"WITH {grid_ctes(5, 'minute')} SELECT edge_id, timestamp, round(speed, 6) AS speed, n_obs "
            "FROM g WHERE n_obs > 0")


def _q_w04_grid_bucket():
    return (f"WITH {grid_ctes(30, 'minute', align='bucket')} "
            "SELECT edge_id, timestamp, round(speed, 6) AS speed, n_obs FROM g")


def _fill_q(method):
    return (f"WITH {grid_ctes(60, edge='user')}, {filled_cte(method)} "
            "SELECT edge_id, timestamp, round(speed, 6) AS speed FROM gf")


def _q_w05_ffill():
    return _fill_q("ffill")


def _q_w06_interpolate():
    return _fill_q("interpolate")


def _q_w08_ffill_bfill():
    return _fill_q("ffill_bfill")


def _q_p01_clip():
    return f"WITH {grid_ctes(60)} SELECT edge_id, timestamp, round({clip_sql('speed')}, 6) AS speed FROM g"


def _q_w09_history_fill():
    frame = "PARTITION BY edge_id ORDER BY timestamp"
    slots = ", ".join(
        f"last_value(speed IGNORE NULLS) OVER ({frame} ROWS BETWEEN 11 PRECEDING AND {11 - j} PRECEDING) AS s{j + 1}"
        if 11 - j > 0 else
        f"last_value(speed IGNORE NULLS) OVER ({frame} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS s{j + 1}"
        for j in range(12))
    lst = ", ".join(f"CASE WHEN s12 IS NULL THEN 0.0 ELSE s{j + 1} END" for j in range(12))
    return (f"WITH {grid_ctes(60)}, "
            f"h AS (SELECT edge_id, timestamp, row_number() OVER ({frame}) AS rn, {slots} FROM g), "
            f"e AS (SELECT edge_id, timestamp, unnest(range(1, 13))::INTEGER AS slot, unnest([{lst}]) AS value "
            "FROM h WHERE rn >= 12) SELECT edge_id, timestamp, slot, round(value, 6) AS value FROM e")


def _q_a07_ticks_per_day():
    return (f"SELECT date_trunc('day', timestamp) AS day, count(DISTINCT timestamp) AS ticks "
            f"FROM ({readings_sql()}) GROUP BY 1")


def _q_w11_grid_days():
    return (f"WITH {grid_ctes(60)} SELECT date_trunc('day', timestamp) AS day, count(*) AS ticks, "
            "count(*) = 24 AS is_full FROM ticks GROUP BY 1")


def _q_w10_sampling_step():
    return (f"WITH r AS ({readings_sql()}), a AS (SELECT min(timestamp) AS t0 FROM r), "
            "b2 AS (SELECT min(timestamp) AS t1 FROM r, a WHERE timestamp > t0) "
            "SELECT CAST((epoch_us(t1) - epoch_us(t0)) / 1000000 AS BIGINT) AS step_seconds, "
            "CAST(floor(86400 / ((epoch_us(t1) - epoch_us(t0)) / 1000000.0)) AS BIGINT) AS steps_per_day FROM a, b2")


def _long(win="win", n_x=12, n_y=12):
    return (f"SELECT label_start, edge_id, role, step, round(value, 6) AS value FROM ("
            f"SELECT label_start, edge_id, 'x' AS role, unnest(range(1, {n_x + 1}))::INTEGER AS step, unnest(x) AS value FROM {win} "
            f"UNION ALL SELECT label_start, edge_id, 'y' AS role, unnest(range(1, {n_y + 1}))::INTEGER AS step, unnest(y) AS value FROM {win})")


def _q_w12_windows():
    return f"WITH {windows_ctes(60)} {_long()}"


def _q_w13_windows_in_day():
    return (f"WITH {windows_ctes(60, 6, 6, within_day=True, drop_missing=False)} "
            f"{_long('win', 6, 6)}")


EMA_P = f"{clip_sql(ema_sql('x', 0.3))}"


def _q_w14_ema_forecast():
    return f"WITH {windows_ctes(60)} SELECT label_start, edge_id, round({EMA_P}, 6) AS pred FROM win"


def _q_w16_last_value():
    return f"WITH {windows_ctes(60)} SELECT label_start, edge_id, round({clip_sql('x[-1]')}, 6) AS pred FROM win"


STEPS = ("s AS (SELECT label_start, edge_id, pred, unnest(y) AS y, unnest(range(1, 13))::INTEGER AS step "
         f"FROM (SELECT label_start, edge_id, y, {EMA_P} AS pred FROM win))")


def _q_a08_window_metrics():
    return (f"WITH {windows_ctes(60)}, {STEPS} SELECT label_start, horizon, steps, "
            "round(avg(abs(pred - y)), 6) AS mae, round(sqrt(avg((pred - y) * (pred - y))), 6) AS rmse "
            f"FROM s JOIN {horizons_values(12)} ON s.step <= hz.steps GROUP BY 1, 2, 3")


def _q_a10_step_node_mae():
    return (f"WITH {windows_ctes(60)}, {STEPS} SELECT step, edge_id, round(avg(abs(pred - y)), 6) AS mae "
            "FROM s GROUP BY 1, 2")


def _q_o02_topk_nodes():
    return (f"WITH {windows_ctes(60, edge='user', fill='ffill_bfill')}, {STEPS}, "
            "m AS (SELECT step, edge_id, round(avg(abs(pred - y)), 6) AS mae FROM s GROUP BY 1, 2) "
            "SELECT step, edge_id, mae FROM m WHERE step = 12 ORDER BY mae DESC, edge_id LIMIT 20")


def _q_a04_global_stats():
    return (f"WITH {windows_ctes(60)}, v AS (SELECT unnest(list_concat(x, y)) AS v FROM win) "
            "SELECT round(avg(v), 6) AS mean, round(CASE WHEN stddev_pop(v) = 0 OR stddev_pop(v) IS NULL "
            "THEN 1.0 ELSE stddev_pop(v) END, 6) AS std FROM v")


RESID = (f"rf AS (SELECT label_start, edge_id, y, {ema_sql('x', 0.2)} AS ref, "
         f"x[-1] - {ema_sql('x', 0.2)} AS gap FROM {{src}}), "
         "rs AS (SELECT label_start, edge_id, ref, gap, unnest(y) AS y, "
         "unnest(range(1, 13))::INTEGER AS step FROM rf)")


def _train_model_sql():
    ctes = windows_ctes(60, heldout=False).replace("win AS (", "trainwin AS (")
    return (ctes + ", " + RESID.replace("{src}", "trainwin").replace("rf AS", "trf AS")
            .replace("FROM rf", "FROM trf").replace("rs AS", "trs AS") +
            ", model AS (SELECT edge_id, step, coalesce(regr_slope(y - ref, gap), 0.0) AS b, "
            "coalesce(regr_intercept(y - ref, gap), 0.0) AS a, count(*) AS n FROM trs GROUP BY 1, 2)")


def _q_m04_residual_fit():
    return (f"WITH {_train_model_sql()} SELECT edge_id, step, round(a, 6) AS a, round(b, 6) AS b, n FROM model")


def _q_m03_residual_forecast():
    return (f"WITH {_train_model_sql()}, "
            + "hw AS (" + f"SELECT * FROM trainwin WHERE date_trunc('day', label_start) = (SELECT day FROM full_day)"
            + "), " + RESID.replace("{src}", "hw") +
            f", o AS (SELECT rs.label_start, rs.edge_id, rs.step, {clip_sql('ref + coalesce(a, 0.0) + coalesce(b, 0.0) * gap')} AS pred "
            "FROM rs LEFT JOIN model ON model.edge_id = rs.edge_id AND model.step = rs.step) "
            "SELECT label_start, edge_id, step, round(pred, 6) AS pred FROM o")


def _q_a14_smooth_l1():
    from velograph.operators.forecast import step_weights
    wl = ", ".join(repr(w) for w in step_weights(12))
    return (f"WITH {windows_ctes(60)}, {STEPS}, dd AS (SELECT [{wl}][step] * (pred - y) AS d FROM s) "
            "SELECT round(avg(CASE WHEN abs(d) < 0.02 THEN 0.5 * d * d / 0.02 ELSE abs(d) - 0.01 END), 6) AS smooth_l1 FROM dd")


def _q_c11_huber():
    return (f"WITH {windows_ctes(60)}, {STEPS}, dd AS (SELECT pred - y AS d FROM s) "
            "SELECT round(avg(CASE WHEN abs(d) <= 1.0 THEN 0.5 * d * d ELSE 1.0 * (abs(d) - 0.5) END), 6) AS huber FROM dd")


def _q_c07_mape_weighted():
    lw = LINEAR_W.replace("speed", "y")
    return (f"WITH {windows_ctes(60)}, {STEPS}, dd AS (SELECT abs(pred - y) AS d, y, {lw} AS w FROM s) "
            "SELECT round(avg(d / CASE WHEN abs(y) <> 0 THEN abs(y) END), 6) AS mape, "
            "round(sum(w * d) / sum(w), 6) AS weighted_mae FROM dd")


def _q_o03_first_windows():
    return (f"WITH {windows_ctes(60)}, fs AS (SELECT DISTINCT label_start FROM win ORDER BY 1 LIMIT 5) "
            "SELECT label_start, edge_id, round(x[-1], 6) AS x_last, round(y[1], 6) AS y_first "
            "FROM win SEMI JOIN fs USING (label_start)")


# --------------------------------------------------------------------------- graph
GRAPH_RAW = ("ge AS (SELECT s_nationkey AS src, c_nationkey AS dst, sum(l_quantity) AS w FROM lineitem "
             "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey "
             "JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)")
GRAPH_CLEAN = ("gc AS (SELECT src, dst, greatest(0.0::DOUBLE, max(w)) AS w FROM ge "
               "WHERE src >= 0 AND src < 25 AND dst >= 0 AND dst < 25 GROUP BY 1, 2 "
               "HAVING greatest(0.0::DOUBLE, max(w)) > 0)")
GRAPH_LOOPS = ("gl AS (SELECT src, dst, w FROM gc WHERE src <> dst UNION ALL "
               "SELECT i::INTEGER AS src, i::INTEGER AS dst, 1.0::DOUBLE AS w FROM range(25) t(i))")
GRAPH = f"{GRAPH_RAW}, {GRAPH_CLEAN}, {GRAPH_LOOPS}"


def _q_g01_clean_edges():
    return (f"WITH {GRAPH_RAW}, d AS (SELECT src - 2 AS src, dst, w - 1500.0 AS w FROM ge UNION ALL SELECT src - 2, dst, 2000.0 - w - 1500.0 FROM ge) "
            "SELECT src, dst, round(max(w), 6) AS w FROM d WHERE src BETWEEN 0 AND 19 AND dst BETWEEN 0 AND 19 GROUP BY 1, 2 HAVING max(w) > 0")


def _q_g03_self_loops():
    return f"WITH {GRAPH} SELECT src, dst, round(w, 6) AS w FROM gl"


def _q_g05_row_normalize():
    return (f"WITH {GRAPH}, rs AS (SELECT src, sum(w) AS s FROM gl GROUP BY 1) SELECT src, dst, "
            "round(CASE WHEN s > 0 THEN w / s ELSE 0.0 END, 9) AS w FROM gl JOIN rs USING (src)")


def _q_g06_graph_stats():
    return (f"WITH {GRAPH} SELECT 25 AS num_nodes, count(*) AS num_edges, "
            "round(count(*) / 25.0, 9) AS avg_degree, round(count(*) / 625.0, 9) AS density FROM gl WHERE w > 0")


def _q_g07_neighbour_mix():
    return (f"WITH {GRAPH}, v AS (SELECT date_trunc('month', l_shipdate) AS t, s_nationkey AS node, "
            "sum(l_quantity) AS x FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2), "
            "m AS (SELECT gl.src, gl.dst, ln(1.0 + exp(coalesce(CASE WHEN ge.src <> 3 THEN (ge.src - ge.dst) / 10.0 END, 0.0))) "
            "+ CASE WHEN gl.src = gl.dst THEN 1.0 ELSE 0.0 END AS c "
            "FROM gl LEFT JOIN ge ON ge.src = gl.src AND ge.dst = gl.dst WHERE gl.w > 0) "
            "SELECT t, dst AS node, round(sum(x * c), 4) AS y FROM v JOIN m ON v.node = m.src GROUP BY 1, 2")


def _q_g08_node_index():
    return "SELECT n_nationkey AS idx, n_name AS sensor_id FROM nation"


# --------------------------------------------------------------------------- spatial
from velograph.functions.geometry import seg_dist_sql, seg_len_sql  # noqa: E402

D = "::DOUBLE"
SENSORS = ("sn AS (SELECT s_suppkey AS sensor_id, 37.4::DOUBLE + (s_suppkey % 50)::DOUBLE * 0.01::DOUBLE AS latitude, "
           "-122.2::DOUBLE + (s_suppkey // 50)::DOUBLE * 0.01::DOUBLE AS longitude, "
           "'Highway-' || CAST(s_suppkey // 10 AS VARCHAR) AS highway, "
           "CASE WHEN s_suppkey % 2 = 0 THEN 'North' ELSE 'South' END AS direction FROM supplier)")
EDGES = (f"ce0 AS (SELECT c_custkey AS edge_id, c_custkey % 4 AS d, "
         f"37.4{D} + (c_custkey % 61){D} * 0.01{D} + ((c_custkey % 7) - 3){D} * 0.0004{D} AS lat0, "
         f"-122.2{D} + ((c_custkey // 61) % 23){D} * 0.01{D} + ((c_custkey % 5) - 2){D} * 0.0003{D} AS lon0, "
         f"0.0005{D} + (c_custkey % 9){D} * 0.0005{D} AS len, c_custkey % 3 = 0 AS three, "
         f"(1 + c_custkey % 89){D} AS mag, "
         "['motorway', 'trunk', 'primary', 'secondary', 'tertiary', 'residential'][c_custkey % 6 + 1] AS highway "
         "FROM customer), "
         f"ce1 AS (SELECT *, CASE WHEN d = 0 THEN len WHEN d = 1 THEN -len ELSE 0.0{D} END AS dlat, "
         f"CASE WHEN d = 2 THEN len WHEN d = 3 THEN -len ELSE 0.0{D} END AS dlon FROM ce0), "
         "ce AS (SELECT edge_id, highway, CASE WHEN d = 0 OR d = 2 THEN mag ELSE -mag END AS bearing, "
         "lon0 AS p0x, lat0 AS p0y, lon0 + dlon AS p1x, lat0 + dlat AS p1y, "
         f"CASE WHEN three THEN lon0 + dlon + 0.001{D} END AS p2x, "
         f"CASE WHEN three THEN lat0 + dlat + 0.001{D} END AS p2y FROM ce1)")
SEG1 = seg_len_sql("p0x", "p0y", "p1x", "p1y")
SEG2 = seg_len_sql("p1x", "p1y", "p2x", "p2y")
EGEO = (f"eg AS (SELECT *, {SEG1} AS l1, CASE WHEN p2x IS NOT NULL THEN {SEG2} END AS l2 FROM ce), "
        f"eg2 AS (SELECT *, 0.0{D} + l1 + coalesce(l2, 0.0{D}) AS length, "
        f"(0.0{D} + l1 * ((p0x + p1x) / 2.0{D}) + coalesce(l2 * ((p1x + p2x) / 2.0{D}), 0.0{D})) "
        f"/ (0.0{D} + l1 + coalesce(l2, 0.0{D})) AS cx, "
        f"(0.0{D} + l1 * ((p0y + p1y) / 2.0{D}) + coalesce(l2 * ((p1y + p2y) / 2.0{D}), 0.0{D})) "
        f"/ (0.0{D} + l1 + coalesce(l2, 0.0{D})) AS cy FROM eg)")
DIST = ("least(" + seg_dist_sql("s.longitude", "s.latitude", "e.p0x", "e.p0y", "e.p1x", "e.p1y", "duckdb") +
        ", CASE WHEN e.p2x IS NOT NULL THEN " +
        seg_dist_sql("s.longitude", "s.latitude", "e.p1x", "e.p1y", "e.p2x", "e.p2y", "duckdb") + " END)")
MAP = (f"{SENSORS}, {EDGES}, {EGEO}, "
       f"cand AS (SELECT * FROM (SELECT s.sensor_id, e.edge_id, e.bearing, s.direction, {DIST} AS dist "
       "FROM sn s CROSS JOIN ce e) WHERE dist < 0.001), "
       "okc AS (SELECT * FROM cand WHERE CASE WHEN direction IN ('North', 'East') THEN bearing > 0 "
       "WHEN direction IN ('South', 'West') THEN bearing < 0 ELSE true END), "
       "mp AS (SELECT sensor_id, arg_min(edge_id, (dist, edge_id)) AS edge_id, min(dist) AS dist FROM okc GROUP BY 1), "
       "um AS (SELECT sensor_id FROM sn WHERE sensor_id NOT IN (SELECT sensor_id FROM cand)), "
       "st AS (SELECT sensor_id, CASE WHEN sensor_id IN (SELECT sensor_id FROM mp) THEN 'mapped' "
       "WHEN sensor_id IN (SELECT sensor_id FROM um) THEN 'unmapped' ELSE 'unknown' END AS status FROM sn), "
       "unc AS (SELECT edge_id FROM ce WHERE edge_id NOT IN (SELECT edge_id FROM mp))")
KDIST = seg_len_sql("s.longitude", "s.latitude", "e.cx", "e.cy")
IDW = (f"{MAP}, kc AS (SELECT * FROM (SELECT e.edge_id, s.sensor_id, {KDIST} AS dist FROM eg2 e "
       "JOIN unc USING (edge_id) CROSS JOIN sn s) WHERE dist < 0.02), "
       "kr AS (SELECT *, row_number() OVER (PARTITION BY edge_id ORDER BY dist, sensor_id) AS rank FROM kc), "
       "k5 AS (SELECT * FROM kr WHERE rank <= 5), "
       "kp AS (SELECT edge_id, sum(CASE WHEN dist > 0 THEN 1.0 / (dist * dist) END) AS inv, "
       "count(*) FILTER (WHERE dist = 0) AS zero FROM k5 GROUP BY 1), "
       "wt AS (SELECT k5.edge_id, sensor_id, rank, dist, CASE WHEN zero > 0 THEN "
       "CASE WHEN dist = 0 THEN 1.0 / zero ELSE 0.0 END ELSE (1.0 / (dist * dist)) / inv END AS weight "
       "FROM k5 JOIN kp USING (edge_id)), "
       "isum AS (SELECT edge_id, count(*) AS n_sensors, avg(dist) * 111.0 AS avg_distance_km FROM wt GROUP BY 1), "
       "qa AS (SELECT 1 AS rule, CAST(sensor_id AS VARCHAR) AS key, 'Sensor ' || CAST(sensor_id AS VARCHAR) "
       "|| ' has no mapping' AS message FROM st WHERE status = 'unknown' UNION ALL "
       "SELECT 3, CAST(edge_id AS VARCHAR), 'Edge ' || CAST(edge_id AS VARCHAR) || ' has interpolation distance > 3km' "
       "FROM isum WHERE avg_distance_km > 3.0)")


def _q_p08_sensor_table():
    known = ("(VALUES (400001, 37.3382, -121.8863, 'I-880', 'North'), (400002, 37.3352, -121.8833, 'I-880', 'South'), "
             "(400003, 37.4419, -122.1430, 'US-101', 'North'), (400004, 37.4389, -122.1400, 'US-101', 'South'), "
             "(400005, 37.3688, -122.0363, 'I-280', 'North'), (400006, 37.3658, -122.0333, 'I-280', 'South')) k(id, lat, lon, hw, dir)")
    return (f"WITH {SENSORS}, a AS (SELECT sensor_id AS id, latitude, longitude, highway, direction FROM sn UNION ALL "
            "SELECT sensor_id + 400000, latitude, longitude, highway, direction FROM sn) "
            "SELECT a.id AS sensor_id, round(coalesce(k.lat::DOUBLE, latitude), 9) AS latitude, round(coalesce(k.lon::DOUBLE, longitude), 9) AS longitude, "
            f"coalesce(k.hw, highway) AS highway, coalesce(k.dir, direction) AS direction FROM a LEFT JOIN {known} USING (id)")


def _q_j04_candidates():
    return f"WITH {MAP} SELECT sensor_id, edge_id, round(dist, 9) AS dist FROM cand"


def _q_j06_mapping():
    return f"WITH {MAP} SELECT sensor_id, edge_id, round(dist, 9) AS dist FROM mp"


def _q_j07_unmapped():
    return f"WITH {MAP} SELECT sensor_id FROM um"


def _q_p20_status():
    return f"WITH {MAP} SELECT sensor_id, status FROM st"


def _q_j08_uncovered():
    return f"WITH {MAP} SELECT edge_id FROM unc"


def _q_a12_edge_sensors():
    return f"WITH {MAP} SELECT edge_id, row_number() OVER (PARTITION BY edge_id ORDER BY sensor_id) AS ordinal, sensor_id FROM mp"


def _q_j09_idw_weights():
    return (f"WITH {IDW} SELECT edge_id, sensor_id, rank::INTEGER AS rank, round(dist, 9) AS dist, "
            "round(weight, 9) AS weight FROM wt")


def _q_j10_interp_summary():
    return f"WITH {IDW} SELECT edge_id, n_sensors, round(avg_distance_km, 9) AS avg_distance_km FROM isum"


def _q_j11_idw_speed():
    return (f"WITH {IDW}, sp AS (SELECT user_id AS sensor_id, date_trunc('hour', ts) AS timestamp, "
            "avg(value) AS speed FROM events WHERE NOT isnan(value) GROUP BY 1, 2) "
            "SELECT edge_id, timestamp, round(sum(weight * speed) / sum(weight), 6) AS speed, count(*) AS n_sensors "
            "FROM wt JOIN sp USING (sensor_id) GROUP BY 1, 2")


def _q_j15_qa_errors():
    return f"WITH {IDW} SELECT rule, key, message FROM qa ORDER BY rule, key LIMIT 10"


def _q_a11_mapping_stats():
    return (f"WITH {IDW} SELECT (SELECT count(*) FROM sn) AS total_sensors, (SELECT count(*) FROM mp) AS mapped_sensors, "
            "(SELECT count(*) FROM um) AS unmapped_sensors, "
            "round((SELECT count(*) FROM mp) / (SELECT count(*) FROM sn) * 100, 9) AS coverage_percent, "
            "(SELECT count(*) FROM ce) AS total_edges, (SELECT count(DISTINCT edge_id) FROM mp) AS edges_with_sensors, "
            "(SELECT count(*) FROM isum) AS edges_with_interpolation, "
            "round(((SELECT count(DISTINCT edge_id) FROM mp) + (SELECT count(*) FROM isum)) / (SELECT count(*) FROM ce) * 100, 9) "
            "AS edge_coverage_percent, round(coalesce((SELECT avg(avg_distance_km) FROM isum), 0.0), 9) "
            "AS avg_interpolation_distance_km, (SELECT count(*) FROM qa) AS validation_errors, '20240131_000000' AS timestamp")


def _q_j16_mapping_detail():
    return (f"WITH {MAP} SELECT sensor_id, edge_id, round(latitude, 9) AS sensor_lat, round(longitude, 9) AS sensor_lon, "
            "highway, direction FROM mp JOIN sn USING (sensor_id)")


def _q_j14_split_candidates():
    return (f"WITH {SENSORS}, {EDGES}, {EGEO}, "
            f"nd AS (SELECT s.sensor_id, e.edge_id, {DIST} AS dist, e.length FROM sn s CROSS JOIN eg2 e), "
            "nn AS (SELECT sensor_id, arg_min(edge_id, (dist, edge_id)) AS edge_id, min(dist) AS dist, "
            "arg_min(length, (dist, edge_id)) AS length FROM nd GROUP BY 1) "
            "SELECT sensor_id, edge_id, round(dist, 9) AS dist, round(length, 9) AS length FROM nn WHERE length > 0.001")


def _q_p11_major_roads():
    return (f"WITH {EDGES} SELECT edge_id, highway FROM ce "
            "WHERE highway IN ('motorway', 'trunk', 'primary', 'secondary', 'motorway_link')")


def _q_p12_bbox():
    return (f"WITH {SENSORS} SELECT sensor_id FROM sn WHERE latitude BETWEEN 37.2 AND 38.0 "
            "AND longitude BETWEEN -122.5 AND -121.7")


def _q_c06_geo_knn():
    r = repr(2.0 / 111.0)
    return (f"WITH {SENSORS}, kc AS (SELECT * FROM (SELECT t.sensor_id AS src, s.sensor_id AS dst, "
            f"{seg_len_sql('s.longitude', 's.latitude', 't.longitude', 't.latitude')} AS dist FROM sn t CROSS JOIN sn s) "
            f"WHERE dist < {r}), kr AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY dist, dst) AS rk FROM kc) "
            "SELECT src, dst, round(dist * 111.0, 9) AS dist_km FROM kr WHERE rk <= 11 AND src <> dst")


# --------------------------------------------------------------------------- serving state
def _q_t03_latest_state():
    return (f"WITH {USER_DEDUP} SELECT edge_id, round(arg_max(speed, timestamp), 6) AS speed, "
            "max(timestamp) AS ts FROM ud GROUP BY 1")


def _q_w15_ema_state():
    return (f"WITH {USER_DEDUP} SELECT edge_id, round({ema_sql('list(speed ORDER BY timestamp)', 0.2)}, 6) AS ema, "
            "max(timestamp) AS ts, count(*) AS n FROM ud GROUP BY 1")


def _pred_sql():
    frame = "PARTITION BY edge_id ORDER BY timestamp"
    slots = ", ".join(
        f"last_value(speed IGNORE NULLS) OVER ({frame} ROWS BETWEEN 11 PRECEDING AND {11 - j} PRECEDING) AS s{j + 1}"
        if 11 - j > 0 else
        f"last_value(speed IGNORE NULLS) OVER ({frame} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS s{j + 1}"
        for j in range(12))
    lst = ", ".join(f"CASE WHEN s12 IS NULL THEN 0.0 ELSE s{j + 1} END" for j in range(12))
    return (f"{grid_ctes(60)}, h AS (SELECT edge_id, timestamp, row_number() OVER ({frame}) AS rn, {slots} FROM g), "
            f"hx AS (SELECT edge_id, timestamp AS ts, [{lst}] AS x FROM h WHERE rn >= 12 AND timestamp = (SELECT hi FROM b)), "
            f"pr AS (SELECT edge_id, hz.horizon, {clip_sql(ema_sql('x', 0.3) + ' + hz.i')} AS value, ts FROM hx "
            "CROSS JOIN (VALUES (15, 1), (30, 2), (45, 3), (60, 4)) AS hz(horizon, i))")


def _q_t06_pred_state():
    return f"WITH {_pred_sql()} SELECT edge_id, horizon, round(value, 6) AS value, ts FROM pr"


LATEST = (f"lr AS (SELECT * FROM ({readings_sql()}) WHERE speed IS NOT NULL), lt AS (SELECT edge_id, max(speed) AS speed, "
          "any_value(timestamp) AS ts FROM lr JOIN (SELECT edge_id, max(timestamp) AS timestamp FROM lr GROUP BY 1) USING (edge_id, timestamp) GROUP BY 1)")
REQS = (f"eds AS (SELECT DISTINCT edge_id FROM ({readings_sql()}) UNION SELECT 'unknown'), "
        "rq AS (SELECT request_id, horizon FROM (VALUES (1, 15), (2, 20), (3, 60), (4, 90)) AS t(request_id, horizon))")


def _q_j02_lookup():
    return (f"WITH {_pred_sql()}, {LATEST}, {REQS}, "
            "x AS (SELECT rq.request_id, eds.edge_id, rq.horizon FROM rq CROSS JOIN eds WHERE rq.horizon BETWEEN 15 AND 60) "
            "SELECT x.request_id, x.edge_id, x.horizon, round(coalesce(pr.value, lt.speed), 6) AS value, "
            "CASE WHEN pr.value IS NOT NULL THEN 'pred' WHEN lt.speed IS NOT NULL THEN 'speed' ELSE 'none' END AS source, "
            "1 AS model_generation, TIMESTAMP '2024-01-31 00:00:00' AS prediction_timestamp "
            "FROM x LEFT JOIN pr ON pr.edge_id = x.edge_id AND pr.horizon = x.horizon LEFT JOIN lt ON lt.edge_id = x.edge_id")


def _q_p18_validate_requests():
    return (f"WITH {REQS} SELECT request_id, horizon, horizon BETWEEN 15 AND 60 AS valid, "
            "CASE WHEN horizon BETWEEN 15 AND 60 THEN NULL ELSE 'horizon must be within 15..60' END AS reason, count(*) AS n FROM rq, eds GROUP BY ALL")


FRESH = ("fr AS (SELECT max(ts) AS last_ts, CASE WHEN max(ts) IS NOT NULL THEN greatest(0.0, 1706659200.0 - epoch_us(max(ts)) / 1e6) END AS age_s FROM lt)")


def _q_a15_freshness():
    return (f"WITH {LATEST}, {FRESH} SELECT last_ts, round(age_s, 6) AS age_s, "
            "coalesce(age_s <= 5.0, false) AS healthy FROM fr")


def _q_a16_pred_count():
    return f"WITH {_pred_sql()} SELECT count(*) AS keys_pred_count FROM pr"


def _q_p21_metrics_text():
    lines = ["'# HELP api_up Always 1 if the API process is running'", "'# TYPE api_up gauge'", "'api_up 1'",
             "'# HELP model_generation Current model generation number'", "'# TYPE model_generation gauge'",
             "'model_generation 1'", "'# HELP prediction_age_seconds Seconds since last replay tick'",
             "'# TYPE prediction_age_seconds gauge'",
             "'prediction_age_seconds ' || coalesce(CAST(age_s AS VARCHAR), 'NaN')",
             "'# HELP keys_pred_count Count of cached prediction keys'", "'# TYPE keys_pred_count gauge'",
             "'keys_pred_count ' || CAST((SELECT count(*) FROM pr) AS VARCHAR)"]
    return (f"WITH {_pred_sql()}, {LATEST}, {FRESH} SELECT (unnest(range(0, 12)))::INTEGER AS line_no, "
            f"unnest([{', '.join(lines)}]) AS line FROM fr")


def _q_p14_parse_instants():
    return ("WITH x AS (SELECT event_id, unnest(['epoch', 'iso', 'bad']) AS kind, "
            "unnest([CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR), strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), props]) AS s "
            "FROM events) SELECT event_id, kind, coalesce(TRY_CAST(s AS DOUBLE), "
            "epoch_us(TRY_CAST(regexp_replace(trim(s), 'Z$', '+00:00') AS TIMESTAMPTZ)) / 1e6) AS epoch_s FROM x")


def _q_o05_capped_log():
    return "SELECT ts FROM events ORDER BY ts DESC LIMIT 500"


def _q_s11_align_stats():
    return (f"WITH r AS ({readings_sql('hour', 'user')}), s AS (SELECT DISTINCT edge_id FROM r UNION ALL "
            "SELECT 'u' || CAST(s_suppkey AS VARCHAR) || '-new' FROM supplier), "
            "c AS (SELECT edge_id, avg(speed) AS mu, stddev_samp(speed) AS sd FROM r GROUP BY 1) "
            "SELECT s.edge_id, round(coalesce(mu, 0.0), 6) AS mu, round(coalesce(nullif(sd, 0.0), 1.0), 6) AS sigma FROM s LEFT JOIN c USING (edge_id)")


# --------------------------------------------------------------------------- sources
def _q_s07_matrix_readings():
    return ("WITH m AS (SELECT vec_id AS row_idx, embedding AS vals FROM embeddings), "
            "sh AS (SELECT count(*) < max(len(vals)) AS t FROM m), "
            "c AS (SELECT row_idx, unnest(range(0, len(vals))) AS pos, unnest(vals)::DOUBLE AS v FROM m) "
            "SELECT make_timestamp(epoch_us(TIMESTAMP '2017-01-01 00:00:00') + "
            "(CASE WHEN sh.t THEN pos ELSE row_idx END) * 300000000) AS timestamp, "
            "'s' || CAST(CASE WHEN sh.t THEN row_idx ELSE pos END AS VARCHAR) AS edge_id, "
            "round(CASE WHEN isnan(v) THEN NULL ELSE v END, 6) AS speed FROM c, sh")


def _q_s05_normalize_wide():
    return (f"WITH d AS (SELECT edge_id, timestamp, avg(speed) AS speed FROM ({readings_sql()}) "
            "WHERE speed IS NOT NULL GROUP BY 1, 2), ts AS (SELECT DISTINCT timestamp FROM d), "
            "e AS (SELECT DISTINCT edge_id FROM d) "
            "SELECT ts.timestamp, e.edge_id, round(d.speed, 6) AS speed FROM ts CROSS JOIN e "
            "LEFT JOIN d ON d.timestamp = ts.timestamp AND d.edge_id = e.edge_id")


# --------------------------------------------------------------------------- quality & remaining
def _q_c03_range_flags():
    return (f"WITH {USER_DEDUP} SELECT edge_id, count(*) FILTER (WHERE coalesce(speed < 0.0 OR speed > 80.0, false)) "
            "AS n_out_of_range, count(*) AS n FROM ud GROUP BY 1")


def _q_c04_coverage():
    return (f"WITH {grid_ctes(60, edge='user')}, p AS (SELECT edge_id, count(*) AS ticks, count(speed) AS observed "
            "FROM g GROUP BY 1) SELECT edge_id, ticks, observed, round(observed / ticks, 6) AS coverage, "
            "round(1.0 - observed / ticks, 6) AS missing, (observed / ticks >= 0.8 AND 1.0 - observed / ticks <= 0.2) "
            "AS passed FROM p")


def _q_c08_congestion_factor():
    return (f"WITH {USER_DEDUP}, {USER_STATS} SELECT edge_id, timestamp, CASE WHEN speed < 0.4 * p90 "
            "THEN 4.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM ud LEFT JOIN st USING (edge_id)")


def _q_c09_bias_correction():
    return (f"WITH {_train_model_sql()}, "
            "o AS (SELECT trs.label_start, trs.edge_id, trs.y, "
            f"{clip_sql('ref + coalesce(a, 0.0) + coalesce(b, 0.0) * gap')} AS pred "
            "FROM trs LEFT JOIN model ON model.edge_id = trs.edge_id AND model.step = trs.step WHERE trs.step = 1) "
            f"SELECT edge_id, round({ema_sql('list(y - pred ORDER BY label_start)', 0.05)}, 6) AS bias, "
            "max(label_start) AS ts, count(*) AS n FROM o WHERE y - pred IS NOT NULL GROUP BY 1")


def _q_c01_zero_fill():
    return (f"WITH {grid_ctes(60, edge='user')} SELECT edge_id, timestamp, round(coalesce(speed, 0.0), 6) AS speed FROM g")


def _q_p03_zscore_unguarded():
    return (f"WITH {USER_DEDUP}, st AS (SELECT edge_id, avg(speed) AS mu, stddev_samp(speed) AS sd FROM ud GROUP BY 1) "
            "SELECT edge_id, timestamp, round((speed - mu) / nullif(sd, 0.0), 6) AS z FROM ud JOIN st USING (edge_id)")


def _q_o06_batches():
    return (f"WITH {windows_ctes(60, heldout=False)}, n AS (SELECT label_start, count(*) AS rows FROM win GROUP BY 1), "
            "o AS (SELECT *, row_number() OVER (ORDER BY md5('0:' || CAST(epoch_us(label_start) AS VARCHAR)), label_start) AS rn FROM n) "
            "SELECT label_start, CAST((rn - 1) // 512 AS INTEGER) AS batch, rows FROM o")


def _q_m02_score_with_callable():
    return (f"WITH {windows_ctes(60)}, p AS (SELECT label_start, edge_id, {clip_sql('x[-1]')} AS pred, unnest(y) AS y, "
            f"unnest(range(1, 13)) AS step FROM win) SELECT label_start, horizon, round(avg(abs(pred - y)), 6) AS mae "
            f"FROM p JOIN {horizons_values(12)} ON p.step <= hz.steps GROUP BY 1, 2")


def _q_p22_input_jitter():
    u = ("(CAST(CAST('0x' || substr(md5('7{0}:' || CAST(epoch_us(label_start) AS VARCHAR) || ':' || edge_id || ':' || "
         "CAST(slot - 1 AS VARCHAR)), 1, 8) AS UBIGINT) AS DOUBLE) + 1) / 4294967297.0")
    return (f"WITH {windows_ctes(60)}, xs AS (SELECT label_start, edge_id, unnest(range(1, 13))::INTEGER AS slot, unnest(x) AS v FROM win) "
            f"SELECT label_start, edge_id, slot, round(v + 0.01 * sqrt(-2 * ln({u.format('a')})) * cos(2 * pi() * ({u.format('b')})), 6) AS v FROM xs")


def _q_s21_norm_params():
    return (f"WITH {USER_DEDUP}, {USER_STATS} SELECT edge_id, 'z_score' AS method, round(mu, 6) AS a, "
            "round(sigma, 6) AS b FROM st UNION ALL SELECT edge_id, 'min_max', round(min, 6), round(max, 6) FROM st")


def _q_a06_split_counts():
    return f"WITH {grid_ctes(60)}, {SPLIT_CTE} SELECT split, count(*) AS n FROM g JOIN sp USING (timestamp) GROUP BY 1"


def _q_a19_dataset_summary():
    return (f"WITH {grid_ctes(60)}, {SPLIT_CTE}, {GRAPH}, gs AS (SELECT split, count(*) AS n FROM g JOIN sp USING (timestamp) "
            "GROUP BY 1), dm AS (SELECT edge_id, timestamp, avg(speed) AS speed FROM r WHERE speed IS NOT NULL GROUP BY 1, 2), "
            "st AS (SELECT edge_id, avg(speed) AS mu, coalesce(nullif(stddev_samp(speed), 0.0), 1.0) AS sd FROM dm GROUP BY 1) "
            "SELECT (SELECT count(DISTINCT edge_id) FROM g) AS num_sensors, "
            "(SELECT n FROM gs WHERE split = 'train') AS train_samples, (SELECT n FROM gs WHERE split = 'val') AS val_samples, "
            "(SELECT n FROM gs WHERE split = 'test') AS test_samples, 'z_score' AS norm_method, (SELECT count(*) FROM st) AS norm_sensors, "
            "round((SELECT sum(mu) FROM st), 6) AS norm_mean_sum, round((SELECT sum(sd) FROM st), 6) AS norm_std_sum, 25 AS num_nodes, "
            "(SELECT count(*) FROM gl WHERE w > 0) AS num_edges, round((SELECT count(*) FROM gl WHERE w > 0) / 25.0, 9) AS avg_degree, "
            "round((SELECT count(*) FROM gl WHERE w > 0) / 625.0, 9) AS density")


def _q_c02_nearest_interp():
    return (IDW_K1 + " SELECT edge_id, sensor_id, round(dist, 9) AS dist, round(weight, 9) AS weight FROM wt")


IDW_K1 = "WITH " + IDW.replace("WHERE rank <= 5", "WHERE rank <= 1")


def _q_p05_global_zscore():
    return (f"WITH {windows_ctes(60)}, v AS (SELECT unnest(list_concat(x, y)) AS v FROM win), "
            "gs AS (SELECT avg(v) AS mean, CASE WHEN stddev_pop(v) = 0 OR stddev_pop(v) IS NULL THEN 1.0 "
            "ELSE stddev_pop(v) END AS std FROM v), "
            "xs AS (SELECT label_start, edge_id, unnest(range(1, 13))::INTEGER AS slot, unnest(x) AS v FROM win) "
            "SELECT label_start, edge_id, slot, round((v - mean) / CASE WHEN std <= 1e-6 THEN 1.0 ELSE std END, 6) AS z "
            "FROM xs, gs")


def _q_j01_node_positions():
    return (f"WITH {windows_ctes(60, edge='user', fill='ffill_bfill')}, {STEPS}, "
            "m AS (SELECT edge_id, avg(abs(pred - y)) AS mae FROM s WHERE step = 12 GROUP BY 1), "
            "u AS (SELECT DISTINCT user_id FROM events), "
            "pos AS (SELECT 'u' || CAST(user_id AS VARCHAR) AS node, 37.4::DOUBLE + (user_id % 50)::DOUBLE * 0.01::DOUBLE AS lat, "
            "-122.2::DOUBLE + (user_id // 50)::DOUBLE * 0.01::DOUBLE AS lon FROM u) "
            "SELECT edge_id, round(lat, 9) AS lat, round(lon, 9) AS lon, round(mae, 6) AS mae FROM m JOIN pos ON m.edge_id = pos.node")


# --------------------------------------------------------------------------- files and drained streams
def _q_s02_read_dir():
    return f"SELECT timestamp, edge_id, round(speed, 6) AS speed FROM ({readings_sql('minute')})"


def _q_s08_partitioned():
    return (f"SELECT strftime(timestamp, '%Y-%m-%d') AS date, CAST(hour(timestamp) AS INTEGER) AS hour, count(*) AS n, count(speed) AS n_speed, "
            f"round(avg(speed), 6) AS mean FROM ({readings_sql('minute')}) GROUP BY 1, 2")


def _q_s10_sidecar():
    return f"WITH {USER_DEDUP}, {USER_STATS} SELECT edge_id, round(mu, 6) AS mu, round(sigma, 6) AS sigma, 60 AS freq_minutes FROM st"


def _q_s12_window_files():
    return (f"WITH {windows_ctes(60)} SELECT label_start, edge_id, round(x[1], 6) AS x_first, round(y[12], 6) AS y_last, "
            "60 AS freq_minutes, 60 AS horizon_minutes, 12 AS t_in FROM win")


def _q_s14_edge_list():
    return f"WITH {GRAPH_RAW} SELECT src, dst, round(CASE WHEN src % 3 > 0 THEN w ELSE 1.0 END, 6) AS w FROM ge"


def _q_g02_crop():
    return f"WITH {GRAPH_RAW}, {GRAPH_CLEAN} SELECT src, dst, round(w, 6) AS w FROM gc WHERE src < 10 AND dst < 10"


def _q_g04_identity():
    return "SELECT CAST(n AS INTEGER) AS src, CAST(n AS INTEGER) AS dst, 1.0::DOUBLE AS w FROM (SELECT row_number() OVER () - 1 AS n FROM nation)"


def _q_c02_linear_interp():
    return ("WITH " + IDW.replace("dist * dist", "dist") + " SELECT edge_id, sensor_id, rank::INTEGER AS rank, round(dist, 9) AS dist, "
            "round(weight, 9) AS weight FROM wt")


def _q_c05_dimensions():
    return (f"WITH {USER_DEDUP}, h AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events WHERE dayofweek(ts) = 0 UNION "
            "SELECT DISTINCT CAST(o_orderdate AS DATE) FROM orders WHERE dayofweek(o_orderdate) = 0), "
            "s AS (SELECT 'u' || CAST(s_suppkey AS VARCHAR) AS edge_id, 25.0::DOUBLE + (s_suppkey % 5) * 10.0::DOUBLE AS l, "
            "['motorway', 'trunk', 'primary', 'secondary', 'tertiary', 'residential'][s_suppkey % 6 + 1] AS rt FROM supplier) "
            "SELECT ud.edge_id, timestamp, CAST(h.d IS NOT NULL AS INTEGER) AS is_holiday, coalesce(l, 65.0::DOUBLE) AS speed_limit, "
            "coalesce(rt, 'unknown') AS road_type FROM ud LEFT JOIN h ON h.d = CAST(timestamp AS DATE) LEFT JOIN s ON s.edge_id = ud.edge_id")


def _q_c09_bias_applied():
    return (f"WITH {_train_model_sql()}, "
            "o AS (SELECT trs.label_start, trs.edge_id, trs.y, "
            f"{clip_sql('ref + coalesce(a, 0.0) + coalesce(b, 0.0) * gap')} AS pred "
            "FROM trs LEFT JOIN model ON model.edge_id = trs.edge_id AND model.step = trs.step WHERE trs.step = 1), "
            "l AS (SELECT edge_id, label_start, pred, list(y - pred) OVER (PARTITION BY edge_id ORDER BY label_start "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS rs FROM o), "
            f"e AS (SELECT *, CASE WHEN coalesce(len(rs), 0) = 0 THEN 0.0 ELSE {ema_sql('rs', 0.05)} END AS bias FROM l) "
            f"SELECT edge_id, label_start AS timestamp, round(bias, 5) AS bias, round({clip_sql('pred + bias')}, 5) AS corrected FROM e")


def _q_j15_qa_report():
    return (f"WITH {IDW}, f AS (SELECT message, rule, key FROM qa ORDER BY rule, key LIMIT 10) SELECT (SELECT count(*) = 0 FROM qa) AS validation_passed, "
            "(SELECT count(*) FROM qa) AS validation_errors, (SELECT coalesce(string_agg(message, '; ' ORDER BY rule, key), '') FROM f) AS errors")


GRID_ONLY = f"WITH {grid_ctes(60)}"


def _q_t03_stream_latest():
    return GRID_ONLY + (" SELECT edge_id, round(arg_max(speed, timestamp), 6) AS speed, max(timestamp) AS ts FROM g WHERE speed IS NOT NULL GROUP BY 1")


def _q_t04_stream_ema():
    return GRID_ONLY + f", o AS (SELECT * FROM g WHERE speed IS NOT NULL) SELECT edge_id, round({ema_sql('list(speed ORDER BY timestamp)', 0.2)}, 6) AS ema FROM o GROUP BY 1"


def _q_t05_stream_forecast():
    return f"WITH {_pred_sql().replace(' + hz.i', '')} SELECT edge_id, horizon, round(value, 6) AS value, ts FROM pr"


def _q_t06_stream_per_sensor():
    return (f"WITH {_pred_sql()}, st AS (SELECT edge_id, avg(speed) AS mu, coalesce(nullif(stddev_samp(speed), 0.0), 1.0) AS sd FROM g "
            "WHERE speed IS NOT NULL GROUP BY 1) SELECT hx.edge_id, hz.horizon, round(0.8 * (x[12] - mu) + 0.1 * hz.i * sd + mu, 6) AS value, ts "
            "FROM hx JOIN st USING (edge_id) CROSS JOIN (VALUES (15, 1), (30, 2), (45, 3), (60, 4)) AS hz(horizon, i)")


def _q_t09_live_lookup():
    known = "last_value(speed IGNORE NULLS) OVER (PARTITION BY edge_id ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    lst = ", ".join(f"CASE WHEN s12 IS NULL THEN 0.0 ELSE s{j + 1} END" for j in range(12))
    return (f"WITH {_pred_sql()}, s AS (SELECT *, CASE WHEN rn >= 12 AND (s1 IS NOT NULL OR s12 IS NULL) THEN [{lst}] END AS x FROM h), "
            f"k AS (SELECT edge_id, timestamp, {known} AS last FROM g), "
            "rq AS (SELECT event_id AS request_id, CAST(15 * (1 + user_id % 5) AS INTEGER) AS horizon, ts, event_type, user_id FROM events), "
            "q AS (SELECT request_id, horizon, ts, event_type AS edge_id FROM rq UNION ALL SELECT request_id, horizon, ts, 'unknown' FROM rq WHERE user_id % 7 = 0), "
            f"a AS (SELECT request_id, q.edge_id, horizon, s.timestamp AS tick, last, CASE WHEN horizon IN (15, 30, 45, 60) AND x IS NOT NULL THEN {clip_sql(ema_sql('x', 0.3))} END AS pred "
            "FROM q LEFT JOIN s ON s.edge_id = q.edge_id AND s.timestamp = least(date_trunc('hour', q.ts), (SELECT hi FROM b)) "
            "LEFT JOIN k ON k.edge_id = s.edge_id AND k.timestamp = s.timestamp WHERE horizon BETWEEN 15 AND 60) "
            "SELECT request_id, edge_id, horizon, round(coalesce(pred, last), 6) AS value, "
            "CASE WHEN pred IS NOT NULL THEN 'pred' WHEN last IS NOT NULL THEN 'speed' ELSE 'none' END AS source, tick AS ts FROM a")


def _q_t07_stream_freshness():
    return GRID_ONLY + " SELECT 'last_ts' AS kind, max(timestamp) AS last_ts FROM g"


def _q_t08_stream_log():
    return GRID_ONLY + " SELECT timestamp AS ts FROM ticks ORDER BY ts DESC LIMIT 100"


def _q_t10_stream_average():
    return GRID_ONLY + (", w AS (SELECT edge_id, time_bucket(INTERVAL 6 HOUR, timestamp, TIMESTAMP '1970-01-01') AS ts, avg(speed) AS speed, count(*) AS n "
                        "FROM g WHERE speed IS NOT NULL GROUP BY 1, 2) SELECT edge_id, ts, round(speed, 6) AS speed, n FROM w "
                        "WHERE ts + INTERVAL 6 HOUR <= (SELECT max(timestamp) FROM g WHERE speed IS NOT NULL) - INTERVAL 1 HOUR")


def _q_a03_sketch_percentile():
    return (f"WITH {USER_DEDUP} SELECT edge_id, count(DISTINCT CAST(timestamp AS DATE)) AS n_days, count(*) AS n, true AS within FROM ud GROUP BY 1")


def _q_m02_model_file():
    return (f"WITH {_train_model_sql()}, cf AS (SELECT step, avg(b) AS b FROM model GROUP BY 1), "
            "sts AS (SELECT edge_id, avg(x[12]) AS mu, coalesce(nullif(stddev_samp(x[12]), 0.0), 1.0) AS sd FROM trainwin GROUP BY 1), "
            f"hw AS ({windows_sql_heldout()}), "
            "p AS (SELECT label_start, edge_id, x, unnest(y) AS y, unnest(range(1, 13)) AS step FROM hw), "
            f"s AS (SELECT label_start, p.step, p.y, {clip_sql('((x[12] - mu) / sd + ((x[12] - mu) / sd - (x[11] - mu) / sd) * b) * sd + mu')} AS pred "
            "FROM p JOIN cf ON cf.step = p.step JOIN sts ON sts.edge_id = p.edge_id) "
            f"SELECT label_start, horizon, round(avg(abs(pred - y)), 5) AS mae FROM s JOIN {horizons_values(12)} ON s.step <= hz.steps GROUP BY 1, 2")


def windows_sql_heldout():
    return f"SELECT * FROM (WITH {windows_ctes(60)} SELECT * FROM win)"


def _z_windows_ctes():
    plain = f"f AS (SELECT edge_id, timestamp, {clip_sql('speed')} AS v FROM gf)"
    stats = ("st AS (SELECT edge_id, avg(speed) AS mu, coalesce(nullif(stddev_samp(speed), 0.0), 1.0) AS sd FROM "
             "(SELECT edge_id, timestamp, avg(speed) AS speed FROM r WHERE speed IS NOT NULL GROUP BY 1, 2) GROUP BY 1)")
    return windows_ctes(60, 6, 6, fill="none", within_day=True, drop_missing=False).replace(
        plain, f"{stats}, f AS (SELECT edge_id, timestamp, (speed - mu) / sd AS v FROM gf JOIN st USING (edge_id))")


def _q_w13_windows_normalized():
    return f"WITH {_z_windows_ctes()} {_long('win', 6, 6)}"


def _q_m06_error_units():
    return (f"WITH {_z_windows_ctes()}, p AS (SELECT edge_id, x[6] AS pred, unnest(y) AS y, CAST(unnest(range(1, 7)) AS INTEGER) AS step FROM win), "
            "e AS (SELECT step, edge_id, avg(abs(pred - y)) AS mae FROM p GROUP BY 1, 2) "
            "SELECT step, edge_id, round(mae, 6) AS mae, round(mae * sd, 6) AS mae_speed FROM e JOIN st USING (edge_id)")


def _q_s01_read_table():
    return (f"SELECT kind, timestamp, edge_id, round(speed, 6) AS speed FROM ({readings_sql('minute')}) CROSS JOIN (VALUES ('csv'), ('pq')) AS k(kind)")


def _q_s18_reports():
    return (f"SELECT kind, edge_id, CAST(hour(timestamp) AS INTEGER) AS hour, round(avg(speed), 6) AS avg_speed, count(*) AS sample_count "
            f"FROM ({readings_sql('minute')}) CROSS JOIN (VALUES ('csv'), ('json'), ('parquet')) AS k(kind) WHERE speed IS NOT NULL GROUP BY ALL")


def _q_t02_stream_long():
    return GRID_ONLY + " SELECT edge_id, timestamp, round(speed, 6) AS speed FROM g"


def _q_o04_irregular_split():
    return (f"WITH r AS ({readings_sql('minute')}), i AS (SELECT timestamp, row_number() OVER (ORDER BY timestamp) AS rn, count(*) OVER () AS n "
            "FROM (SELECT DISTINCT timestamp FROM r)), l AS (SELECT timestamp, CASE WHEN rn <= floor(n * 0.7::DOUBLE) THEN 'train' "
            "WHEN rn <= floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM i) "
            "SELECT split, count(*) AS rows, min(timestamp) AS first_ts, max(timestamp) AS last_ts FROM r JOIN l USING (timestamp) GROUP BY 1")


def _q_s16_sensor_files():
    return (f"WITH {SENSORS} SELECT sensor_id, sensor_id AS idx, round(latitude, 9) AS latitude, round(longitude, 9) AS longitude, highway, direction FROM sn")
