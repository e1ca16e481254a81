"""Data-quality operators declared in configuration (C1–C11 not covered elsewhere).

C1 zero fill lives in ``align.fill(method='zero')``, C2 nearest interpolation is
``spatial.knn_idw(k=1)``, C6 in ``spatial.geo_knn_adjacency``, C7/C11 in
``forecast``, C10 in ``features.split_bounds``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.window import Window

from velograph.functions.columns import clip
from velograph.operators.serve import ema_state
from velograph.session import off_its_keys

# Fixed values that must equal the reference's configuration.
VALID_SPEED_RANGE = (0.0, 80.0)     # mph
MIN_COVERAGE = 0.8
MAX_MISSING = 0.2
CONGESTION_FACTOR = 4.0              # weight below 40 % of free-flow
CONGESTION_THRESHOLD = 0.4
BIAS_DECAY = 0.95

FAN = 8                # rows joined in one step of a scan
BLOCK_STEPS = 2        # blocks of 64 days
ALL_DAYS_STEPS = 8     # 8^8 days: all dates from year 1 to 9999


def range_flags(readings: DataFrame, lo: float = VALID_SPEED_RANGE[0],
                hi: float = VALID_SPEED_RANGE[1]) -> DataFrame:
    """Flag readings outside the valid speed range (missing stays unflagged)."""
    v = F.col("speed")
    return readings.withColumn("out_of_range", F.coalesce((v < lo) | (v > hi), F.lit(False)))


def coverage_report(grid: DataFrame, min_coverage: float = MIN_COVERAGE,
                    max_missing: float = MAX_MISSING) -> DataFrame:
    """C4: per sensor, share of grid ticks with a value, share missing, pass flag."""
    per = grid.groupBy("edge_id").agg(F.count("*").alias("ticks"),
                                      F.count("speed").alias("observed"))
    cov = F.col("observed") / F.col("ticks")
    return per.select("edge_id", "ticks", "observed", cov.alias("coverage"),
                      (F.lit(1.0) - cov).alias("missing"),
                      ((cov >= min_coverage) & ((F.lit(1.0) - cov) <= max_missing)).alias("passed"))


def congestion_factor_weights(readings: DataFrame, free_flow: DataFrame) -> DataFrame:
    """weight = 4 where speed < 40 % of the sensor's free-flow speed, else 1."""
    j = readings.join(off_its_keys(free_flow.select("edge_id", "free_flow")), "edge_id", "left")
    below = F.col("speed") < F.lit(CONGESTION_THRESHOLD) * F.col("free_flow")
    return j.withColumn("weight", F.when(below, F.lit(CONGESTION_FACTOR)).otherwise(F.lit(1.0))) \
        .drop("free_flow")


def bias_correction(residual_grid: DataFrame, decay: float = BIAS_DECAY) -> DataFrame:
    """Per-sensor online bias = EMA (weight 1 − decay on the newest) of the residuals
    ``speed = y − ŷ`` in time order; add it to the next forecast."""
    b = ema_state(residual_grid, alpha=1.0 - decay)
    return b.select("edge_id", F.col("ema").alias("bias"), "ts", "n")


def affine_scan(rows: DataFrame, keys: list[str], order: str, steps: int) -> DataFrame:
    """Every row's affine map ``x -> scale * x + shift`` composed with those of all rows
    before it with equal ``keys``, in ``order``: columns ``scale`` and ``shift`` become
    the running composition, exact for up to ``FAN ** steps`` rows of one key.

    In step k a row takes in the compositions that end ``FAN ** k``, ``2 * FAN ** k``, ..
    rows earlier. All steps share one partitioning and sort; rows are streamed and spill,
    none are gathered."""
    w = Window.partitionBy(*keys).orderBy(order)
    kept = [c for c in rows.columns if c not in ("scale", "shift")]
    for k in range(steps):
        lags = range(1, FAN)
        wide = rows.select("*", *(F.lag("scale", i * FAN ** k, 1.0).over(w).alias(f"_scale{i}") for i in lags),
                           *(F.lag("shift", i * FAN ** k, 0.0).over(w).alias(f"_shift{i}") for i in lags))
        scale, shift = F.lit(1.0), F.lit(0.0)
        for i in reversed(lags):  # the earliest map is applied first
            shift = F.col(f"_scale{i}") * shift + F.col(f"_shift{i}")
            scale = scale * F.col(f"_scale{i}")
        rows = wide.select(*kept, (scale * F.col("scale")).alias("scale"), (F.col("scale") * shift + F.col("shift")).alias("shift"))
    return rows


def bias_corrected(forecasts: DataFrame, decay: float = BIAS_DECAY) -> DataFrame:
    """C9 applied: ``corrected = clip(pred + bias)``, where ``bias`` is the EMA of the
    sensor's residuals ``y - pred`` before the row (0 at its first).

    ``forecasts(edge_id, day, timestamp, y, pred)``. Inside a day the bias is a running sum
    of residuals scaled by powers of the decay. A sensor-day is an affine map of the bias
    it starts with; the biases at the starts of days follow from a scan of these maps
    inside blocks of ``FAN ** BLOCK_STEPS`` days and one of the blocks' maps, so a long
    history is neither one task's nor one row's."""
    a, b = 1.0 - decay, decay
    day = Window.partitionBy("edge_id", "day").orderBy("timestamp")
    r = forecasts.withColumn("_r", F.col("y") - F.col("pred")).withColumn("_j", F.count("_r").over(day.rowsBetween(Window.unboundedPreceding, -1)))
    # sum over earlier rows i of a * r_i * b^(j - 1 - i), i counting known residuals of the day from 0
    part = F.sum(F.lit(a) * F.col("_r") * F.pow(F.lit(b), -F.col("_j").cast("double"))).over(day.rowsBetween(Window.unboundedPreceding, -1))
    r = r.withColumn("_own", F.coalesce(part, F.lit(0.0)) * F.pow(F.lit(b), F.col("_j").cast("double") - 1))
    known_at = F.when(F.col("_r").isNotNull(), F.col("timestamp"))
    days = r.groupBy("edge_id", "day").agg(F.count("_r").alias("_m"), F.max_by(F.struct("_own", "_r"), known_at).alias("_l"),
                                           F.min_by("_r", known_at).alias("_first"), F.min(known_at).alias("_t0"))
    days = days.select("edge_id", "day", F.floor(F.unix_date(F.to_date("day")) / FAN ** BLOCK_STEPS).alias("_block"), "_first", "_t0",
                       F.pow(F.lit(b), F.col("_m").cast("double")).alias("scale"),
                       F.coalesce(F.col("_l._own") * F.lit(b) + F.lit(a) * F.col("_l._r"), F.lit(0.0)).alias("shift"))
    days = affine_scan(days, ["edge_id", "_block"], "day", BLOCK_STEPS)
    blocks = days.groupBy("edge_id", "_block").agg(F.max_by("scale", "day").alias("scale"), F.max_by("shift", "day").alias("shift"))
    blocks = affine_scan(blocks, ["edge_id"], "_block", ALL_DAYS_STEPS - BLOCK_STEPS)
    # the EMA starts at the first residual: before it the state is that residual itself
    firsts = days.groupBy("edge_id").agg(F.min_by("_first", "_t0").alias("_r0"), F.min("_t0").alias("_t0"))
    blocks = (blocks.join(firsts, "edge_id").withColumn("_end", F.col("scale") * F.col("_r0") + F.col("shift"))
              .withColumn("_e0", F.coalesce(F.lag("_end").over(Window.partitionBy("edge_id").orderBy("_block")), "_r0")))
    inside = Window.partitionBy("edge_id", "_block").orderBy("day")
    days = days.select("edge_id", "day", "_block", F.lag("scale").over(inside).alias("_scale"), F.lag("shift").over(inside).alias("_shift"))
    starts = days.join(blocks.select("edge_id", "_block", "_e0", F.col("_t0").alias("_first_at")), ["edge_id", "_block"]).select(
        "edge_id", "day", "_first_at", F.coalesce(F.col("_scale") * F.col("_e0") + F.col("_shift"), "_e0").alias("_e"))
    j = r.join(starts, ["edge_id", "day"], "left")
    bias = F.when(F.col("timestamp") > F.col("_first_at"), F.col("_e") * F.pow(F.lit(b), F.col("_j").cast("double")) + F.col("_own")).otherwise(F.lit(0.0))
    return (j.withColumn("bias", F.coalesce(bias, F.lit(0.0))).withColumn("corrected", clip(F.col("pred") + F.col("bias")))
            .drop("_r", "_j", "_own", "_e", "_first_at"))
