"""Serving state as keyed tables and the lookups over them
(J2, J3, A15, A16, P14, P17, P18, P21, P23, O5, S11, W15, T3/T4/T6 batch twins).

State tables: ``latest(edge_id, speed, ts)``, ``ema(edge_id, ema, ts)``,
``pred(edge_id, horizon, value, ts)``. They are built here in batch and by
``velograph.streaming`` incrementally; both give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velograph.functions.columns import clip, parse_epoch_or_iso, sigma_guard
from velograph.operators.windows import HORIZONS_MIN, REPLAY_EMA_ALPHA, point_index

# Fixed values that must equal the reference's.
HORIZON_MIN, HORIZON_MAX = 15, 60
MAX_PREDICTION_AGE_S = 5.0
STREAM_LOG_CAP = 10_000


def latest_state(readings: DataFrame) -> DataFrame:
    """T3 batch twin: latest non-missing reading per sensor, of several at the last
    instant the largest. One partial-aggregating ``groupBy``."""
    r = readings.where(F.col("speed").isNotNull() & ~F.isnan("speed"))
    best = r.groupBy("edge_id").agg(F.max(F.struct("timestamp", "speed")).alias("_b"))
    return best.select("edge_id", F.col("_b.speed").alias("speed"), F.col("_b.timestamp").alias("ts"))


def ema_state(grid: DataFrame, alpha: float = REPLAY_EMA_ALPHA) -> DataFrame:
    """W15 / T4 batch twin: per-sensor EMA over all non-missing values in time order,
    seeded by the first value: ``e_n = x_1·b^n + Σ_p a·b^(n−p)·x_p`` (b = 1 − a).

    Each sensor-day folds into an affine pair — ``B_d = Σ_j a·b^(m_d−j)·x_j``
    and its count ``m_d`` — using windows on the grid's (sensor, day)
    partitioning; days then combine per sensor on the small day table as
    ``e = x_1·b^N + Σ_d B_d·b^(later observations)``. No task holds a whole
    sensor history and the grid is read once.
    """
    a, b = float(alpha), float(1.0 - alpha)
    r = grid.where(F.col("speed").isNotNull()).select("edge_id", "day", "timestamp", "speed")
    part = Window.partitionBy("edge_id", "day")
    r = r.withColumn("_j", F.row_number().over(part.orderBy("timestamp"))) \
         .withColumn("_m", F.count("*").over(part))
    days = r.groupBy("edge_id", "day").agg(
        F.sum(F.lit(a) * F.col("speed") * F.pow(F.lit(b), F.col("_m") - F.col("_j"))).alias("_B"),
        F.max("_m").alias("_m"), F.min_by("speed", "timestamp").alias("_x0"),
        F.max("timestamp").alias("_ts"))
    we = Window.partitionBy("edge_id").orderBy("day")
    days = days.withColumn("_after", F.coalesce(F.sum("_m").over(
        we.rowsBetween(1, Window.unboundedFollowing)), F.lit(0)))
    per = days.groupBy("edge_id").agg(
        F.sum(F.col("_B") * F.pow(F.lit(b), F.col("_after"))).alias("_S"),
        F.min_by("_x0", "day").alias("_x1"), F.sum("_m").alias("n"), F.max("_ts").alias("ts"))
    return per.select("edge_id", (F.col("_x1") * F.pow(F.lit(b), F.col("n")) + F.col("_S")).alias("ema"),
                      "ts", "n")


def prediction_state(history: DataFrame, freq_minutes: int, t_out: int,
                     forecaster: Column, horizons: Sequence[int] = HORIZONS_MIN) -> DataFrame:
    """T6 batch twin (P17): ``history(edge_id, ts, x ARRAY)`` → ``pred(edge_id, horizon, value, ts)``.

    ``forecaster`` maps ``x`` to an array of ``t_out`` values (already in speed units).
    """
    pairs = point_index(freq_minutes, t_out, horizons)
    hz = F.array(*[F.struct(F.lit(h).alias("horizon"), F.lit(i).alias("idx")) for h, i in pairs])
    p = history.select("edge_id", "ts", forecaster.alias("_y"), F.explode(hz).alias("_h"))
    return p.select("edge_id", F.col("_h.horizon").alias("horizon"),
                    F.element_at("_y", F.col("_h.idx")).alias("value"), "ts")


def validate_requests(requests: DataFrame) -> DataFrame:
    """Horizon must lie in 15..60; rejected rows keep a reason."""
    ok = F.col("horizon").between(HORIZON_MIN, HORIZON_MAX)
    return requests.withColumn("valid", ok).withColumn(
        "reason", F.when(ok, F.lit(None).cast("string")).otherwise(F.lit("horizon must be within 15..60")))


def lookup(requests: DataFrame, pred: DataFrame, latest: DataFrame) -> DataFrame:
    """Per (request, edge) the prediction at the horizon, else the current speed, else NULL.

    Duplicate ids inside one request collapse. Output adds ``source``
    (``pred`` / ``speed`` / ``none``).
    """
    req = (validate_requests(requests).where("valid")
           .select("request_id", "horizon", F.explode(F.array_distinct("edge_ids")).alias("edge_id")))  # no state on a stream
    p = pred.select("edge_id", "horizon", F.col("value").alias("_pv"))
    s = latest.select("edge_id", F.col("speed").alias("_sv"))
    j = req.join(p, ["edge_id", "horizon"], "left").join(s, "edge_id", "left")
    return j.select("request_id", "edge_id", "horizon",
                    F.coalesce("_pv", "_sv").alias("value"),
                    F.when(F.col("_pv").isNotNull(), "pred").when(F.col("_sv").isNotNull(), "speed")
                    .otherwise("none").alias("source"))


def stamp(df: DataFrame, model_generation: int, prediction_ts: str) -> DataFrame:
    """Model generation and prediction timestamp (a parameter, so results are deterministic)."""
    return df.withColumn("model_generation", F.lit(model_generation)).withColumn(
        "prediction_timestamp", F.lit(prediction_ts).cast("timestamp"))


def freshness(state: DataFrame, now_epoch: float, threshold_s: float = MAX_PREDICTION_AGE_S,
              ts_col: str = "ts") -> DataFrame:
    """Last processed instant, age = max(0, now − last), healthy if age ≤ threshold."""
    last = state.agg(F.max(ts_col).alias("last_ts"))
    # greatest() skips NULLs, so an unknown last instant must stay NULL explicitly
    age = F.when(F.col("last_ts").isNotNull(), F.greatest(
        F.lit(0.0), F.lit(float(now_epoch)) - F.unix_micros(F.col("last_ts").cast("timestamp")) / F.lit(1e6)))
    return last.select("last_ts", age.alias("age_s"),
                       F.coalesce(age <= F.lit(threshold_s), F.lit(False)).alias("healthy"))


def prediction_count(pred: DataFrame) -> DataFrame:
    """Number of live prediction keys."""
    return pred.agg(F.count("*").alias("keys_pred_count"))


def metrics_text(fresh: DataFrame, count: DataFrame, model_generation: int = 0) -> DataFrame:
    """Metrics exposition lines (HELP, TYPE, value; NaN when the age is unknown)."""
    age = F.coalesce(F.col("age_s").cast("string"), F.lit("NaN"))
    lines = F.array(
        F.lit("# HELP api_up Always 1 if the API process is running"), F.lit("# TYPE api_up gauge"),
        F.lit("api_up 1"),
        F.lit("# HELP model_generation Current model generation number"),
        F.lit("# TYPE model_generation gauge"), F.lit(f"model_generation {model_generation}"),
        F.lit("# HELP prediction_age_seconds Seconds since last replay tick"),
        F.lit("# TYPE prediction_age_seconds gauge"), F.concat(F.lit("prediction_age_seconds "), age),
        F.lit("# HELP keys_pred_count Count of cached prediction keys"),
        F.lit("# TYPE keys_pred_count gauge"),
        F.concat(F.lit("keys_pred_count "), F.col("keys_pred_count").cast("string")))
    age_s = fresh.select("age_s").scalar()
    keys = count.select("keys_pred_count").scalar()
    one = fresh.sparkSession.range(1).select(age_s.alias("age_s"), keys.alias("keys_pred_count"))
    return one.select(F.posexplode(lines).alias("line_no", "line"))


def parse_instants(df: DataFrame, col: str) -> DataFrame:
    """Epoch seconds or ISO-8601 text → epoch seconds (NULL when neither)."""
    return df.withColumn("epoch_s", parse_epoch_or_iso(col))


def capped_log(log: DataFrame, cap: int = STREAM_LOG_CAP, ts_col: str = "ts") -> DataFrame:
    """Keep the newest ``cap`` entries (the cap is the feature)."""
    return log.orderBy(F.col(ts_col).desc()).limit(cap)


def trend_forecaster(x: str, t_out: int, alpha: float, per_step: float = 1.0) -> Column:
    """A forecast that differs by step: the EMA of the history plus ``per_step`` a step, clipped."""
    from velograph.operators.windows import ema
    return F.transform(F.sequence(F.lit(1), F.lit(t_out)), lambda i: clip(ema(x, alpha) + i * F.lit(float(per_step))))


def align_stats(sensors: DataFrame, stats: DataFrame) -> DataFrame:
    """Stats per listed sensor with defaults mu 0, sigma 1 (0 → 1)."""
    j = sensors.select("edge_id").join(stats.select("edge_id", "mu", "sigma"), "edge_id", "left")
    return j.select("edge_id", F.coalesce("mu", F.lit(0.0)).alias("mu"), sigma_guard("sigma").alias("sigma"))


def ema_forecaster(x: str, t_out: int, alpha: float) -> Column:
    """M1 inside serving: clipped EMA of the history repeated over ``t_out`` steps."""
    from velograph.operators.windows import ema
    return F.array_repeat(clip(ema(x, alpha)), t_out)
