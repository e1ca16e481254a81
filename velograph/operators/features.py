"""Per-sensor statistics, normalisation, calendar features, weights, ordered splits
(A1–A6, A13, A18–A20, P2–P10, S20, S21, O4).

Statistics are one partial-aggregating ``groupBy(edge_id)``; applying them is
a join against a table with one row per sensor (AQE broadcasts it when its
runtime size is under the threshold, otherwise it stays a shuffle join, whose hot
sensors AQE splits: see ``off_its_keys``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velograph.functions.columns import calendar_features, linear_weight, sigma_guard, step_weight
from velograph.operators.windows import numbered
from velograph.session import off_its_keys

# Fixed values that must equal the reference's.
SPLIT_RATIOS = (0.7, 0.15, 0.15)   # train / val / test
FREE_FLOW_PERCENTILE = 0.9


SKETCH_ACCURACY = 1000
KLL_K = 1024   # size of a mergeable sketch


def exact_percentile(df: DataFrame, key: str, value: str, q: float,
                     alias: str = "p") -> DataFrame:
    """Exact linear-interpolation percentile per key, lazy and safe for hot keys.

    A quantile sketch per key (partial aggregation) brackets the wanted ranks. One more
    pass counts the values below the bracket and the different values in it, combined
    before the shuffle; a running count over those few (all of a key with at most four
    sketch sizes of values, else about 0.4 %) finds the ranks. Nothing is stored.
    """
    v = df.where(F.col(value).isNotNull()).select(key, F.col(value).alias("_v"))
    around = F.percentile_approx("_v", F.array(F.lit(max(q - 2 / SKETCH_ACCURACY, 0.0)), F.lit(min(q + 2 / SKETCH_ACCURACY, 1.0))),
                                 SKETCH_ACCURACY)
    bounds = v.groupBy(key).agg(F.count("*").alias("_n"), around.alias("_a"))
    small = F.col("_n") <= 4 * SKETCH_ACCURACY
    bounds = bounds.select(key, "_n", F.when(~small, F.col("_a")[0]).alias("_from"), F.when(~small, F.col("_a")[1]).alias("_to"))
    inside = F.col("_from").isNull() | F.col("_v").between(F.col("_from"), F.col("_to"))
    placed = v.join(off_its_keys(bounds), key).select(key, "_n", F.when(inside, F.col("_v")).alias("_in"), F.when(inside, 1).when(F.col("_v") < F.col("_from"), 0).alias("_side"))
    counted = placed.where(F.col("_side").isNotNull()).groupBy(key, "_n", "_side", "_in").agg(F.count("*").alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy(key).orderBy("_side", "_in"))
    pos = F.lit(float(q)) * (F.col("_n") - 1).cast("double")

    def at(rank: Column) -> Column:  # the value whose run of equal values holds a rank counted from 0
        return F.max(F.when((F.col("_upto") - F.col("_c") <= rank) & (rank < F.col("_upto")), F.col("_in")))

    agg = counted.withColumn("_upto", upto).groupBy(key).agg(
        at(F.floor(pos)).alias("_vl"), at(F.ceil(pos)).alias("_vh"), F.max(pos - F.floor(pos)).alias("_fr"))
    return agg.select(key, (F.col("_vl") + F.col("_fr") * (F.col("_vh") - F.col("_vl"))).alias(alias))


def sensor_stats(readings: DataFrame, percentile: bool = False) -> DataFrame:
    """A1, A2: count, mean, sample std (plain as ``sample_std``, guarded 0 → 1 as
    ``sigma``), min and max per sensor, one lazy partial-aggregating ``groupBy``; with ``percentile`` also A3, the exact 90th
    percentile (``exact_percentile``)."""
    v = F.col("speed")
    r = readings.where(v.isNotNull())
    stats = r.groupBy("edge_id").agg(
        F.count(v).alias("n"), F.avg(v).alias("mu"), F.stddev_samp(v).alias("sample_std"),
        F.min(v).alias("min"), F.max(v).alias("max"))
    stats = stats.withColumn("sigma", sigma_guard("sample_std"))
    if not percentile:
        return stats
    return stats.join(exact_percentile(r, "edge_id", "speed", FREE_FLOW_PERCENTILE, "p90"), "edge_id")


def daily_sketches(readings: DataFrame, accuracy: int = KLL_K) -> DataFrame:
    """A3 for growing data: one mergeable KLL quantile sketch per sensor and day
    ``(edge_id, day, n, sketch)``, a few kB each. New days are appended; nothing is read
    again for a percentile over any span of days. Partial sketches meet in the shuffle,
    so a hot sensor is no hot task. Missing readings (NULL, NaN) are left out."""
    v = F.col("speed").cast("double")
    known = readings.where(F.col("speed").isNotNull() & ~F.isnan("speed"))
    return known.groupBy("edge_id", F.to_date("timestamp").alias("day")).agg(
        F.count("*").alias("n"), F.kll_sketch_agg_double(v, accuracy).alias("sketch"))


def sketch_percentile(sketches: DataFrame, q: float = FREE_FLOW_PERCENTILE, alias: str = "p", accuracy: int = KLL_K) -> DataFrame:
    """Percentile per sensor from ``daily_sketches`` rows: ``(edge_id, n_days, n, <alias>)``.
    The value's rank is off by about 2.3 / accuracy^0.9 of n (0.4 % at 1024), at 99 %
    confidence; ``exact_percentile`` is the exact way."""
    merged = sketches.groupBy("edge_id").agg(F.count("*").alias("n_days"), F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", accuracy).alias("_s"))
    return merged.select("edge_id", "n_days", "n", F.kll_sketch_get_quantile_double("_s", F.lit(float(q))).alias(alias))


def norm_params(stats: DataFrame, method: str = "z_score") -> DataFrame:
    """Normalisation parameters with their method, one row per sensor."""
    if method == "z_score":
        return stats.select("edge_id", F.lit(method).alias("method"),
                            F.col("mu").alias("a"), F.col("sigma").alias("b"))
    if method == "min_max":
        return stats.select("edge_id", F.lit(method).alias("method"),
                            F.col("min").alias("a"), F.col("max").alias("b"))
    raise ValueError(f"unknown method: {method}")


def normalize(readings: DataFrame, params: DataFrame, guard: bool = True) -> DataFrame:
    """P2/P3 (z-score) and P4 (min-max), driven by a ``norm_params`` table.

    Missing stats default to (0, 1) (S11). Without ``guard`` a zero spread
    gives NULL instead of dividing by zero.
    """
    p = off_its_keys(params.select("edge_id", "method", "a", "b"))
    j = readings.join(p, "edge_id", "left")
    a = F.coalesce(F.col("a"), F.lit(0.0))
    zs = sigma_guard("b") if guard else F.when(F.col("b") != 0, F.coalesce("b", F.lit(1.0)))
    mm = F.col("b") - F.col("a")
    z = F.when(F.col("method") == "min_max", (F.col("speed") - a) / F.when(mm != 0, mm)) \
        .otherwise((F.col("speed") - a) / zs)
    return j.withColumn("value", z).drop("method", "a", "b")


def denormalize(normalized: DataFrame, params: DataFrame, col: str = "value") -> DataFrame:
    """Inverse of ``normalize`` (``y*sigma + mu`` or ``y*(max-min) + min``)."""
    p = off_its_keys(params.select("edge_id", "method", "a", "b"))
    j = normalized.join(p, "edge_id", "left")
    a = F.coalesce(F.col("a"), F.lit(0.0))
    inv = F.when(F.col("method") == "min_max", F.col(col) * (F.col("b") - F.col("a")) + a) \
        .otherwise(F.col(col) * sigma_guard("b") + a)
    return j.withColumn(col, inv).drop("method", "a", "b")


def with_calendar(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Hour, minute, time_of_day, day_of_week (Mon=0), is_weekend, month."""
    return df.select("*", *[c.alias(n) for n, c in calendar_features(ts).items()])


def congestion_step_weights(readings: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Weight 2.0 where speed / max(p90, 1) < 0.4 else 1.0, per reading."""
    st = stats if stats is not None else sensor_stats(readings, percentile=True)
    j = readings.join(off_its_keys(st.select("edge_id", "p90")), "edge_id", "left")
    return j.withColumn("weight", step_weight("speed", "p90")).drop("p90")


def congestion_linear_weights(readings: DataFrame) -> DataFrame:
    """P10: weight = 1 + 4·(1 − clip(v/65, 0, 1)); NULL speed keeps NULL."""
    return readings.withColumn("weight", linear_weight("speed"))


def weight_summary(weights: DataFrame) -> DataFrame:
    """Mean of per-sensor mean weights, and the max weight."""
    per = weights.groupBy("edge_id").agg(F.avg("weight").alias("w"), F.max("weight").alias("m"))
    return per.agg(F.avg("w").alias("avg_weight"), F.max("m").alias("max_weight"))


def split_bounds(n: int, ratios: Sequence[float] = SPLIT_RATIOS) -> tuple[int, int]:
    """``int(n*train)`` and ``train_end + int(n*val)``; ratios must sum to 1."""
    if abs(sum(ratios) - 1.0) > 1e-3:
        raise ValueError("split ratios must sum to 1")
    train_end = int(n * ratios[0])
    return train_end, train_end + int(n * ratios[1])


def ordered_split_grid(df: DataFrame, lo_us: int, hi_us: int, freq_minutes: int,
                       ratios: Sequence[float] = SPLIT_RATIOS) -> DataFrame:
    """O4 on a regular grid: the tick index is arithmetic, so no global ranking."""
    step = int(freq_minutes) * 60_000_000
    n = (hi_us - lo_us) // step + 1
    a, b = split_bounds(n, ratios)
    idx = (F.unix_micros(F.col("timestamp").cast("timestamp")) - F.lit(lo_us)) / F.lit(step)
    return df.withColumn("split", F.when(idx < a, "train").when(idx < b, "val").otherwise("test"))


def ordered_split(df: DataFrame, ratios: Sequence[float] = SPLIT_RATIOS) -> DataFrame:
    """O4 on an irregular index: number the *distinct instants* (``windows.numbered``),
    cut at ``int(n*ratio)``, join back. The cut positions follow from ``n`` in SQL."""
    if abs(sum(ratios) - 1.0) > 1e-3:
        raise ValueError("split ratios must sum to 1")
    ranked = numbered(df.select("timestamp").distinct(), ["timestamp"])
    n = ranked.agg(F.count("*").alias("n")).select("n").scalar()
    first = F.floor(n * ratios[0])
    second = first + F.floor(n * ratios[1])
    lab = ranked.select("timestamp", F.when(F.col("position") <= first, "train")
                        .when(F.col("position") <= second, "val").otherwise("test").alias("split"))
    return df.join(lab, "timestamp")


def split_summary(split_df: DataFrame) -> DataFrame:
    """A20 (+A6): rows, share of all rows, first/last instant per split."""
    per = split_df.groupBy("split").agg(F.count("*").alias("rows"),
                                        F.min("timestamp").alias("first_ts"),
                                        F.max("timestamp").alias("last_ts"))
    # share over a 3-row table: an unpartitioned window is fine here
    return per.withColumn("share", F.col("rows") / F.sum("rows").over(Window.partitionBy()))


def hourly_average(readings: DataFrame) -> DataFrame:
    """A5: average speed and sample count per sensor and hour of day."""
    return (readings.groupBy("edge_id", F.hour("timestamp").alias("hour"))
            .agg(F.avg("speed").alias("avg_speed"), F.count("*").alias("sample_count")))


def profile(readings: DataFrame) -> DataFrame:
    """S20 + A18: rows, sensors, instants, time range, missing values. Sensors and instants
    are two small groupings, each combined before its shuffle, in place of one pass
    that expands every row once per distinct count."""
    per = readings.groupBy("edge_id").agg(F.count("*").alias("_n"), F.min("timestamp").alias("_lo"), F.max("timestamp").alias("_hi"),
                                          F.count_if(F.col("speed").isNull()).alias("_missing"))
    whole = per.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.count("edge_id").alias("n_sensors"),
                    F.min("_lo").alias("first_ts"), F.max("_hi").alias("last_ts"), F.coalesce(F.sum("_missing"), F.lit(0)).alias("n_missing"))
    return whole.select("n_rows", "n_sensors", distinct_count(readings, "timestamp").alias("n_instants"), "first_ts", "last_ts", "n_missing")


def distinct_count(df: DataFrame, column: str) -> Column:
    """Number of different values that are not NULL, as a scalar subquery."""
    return df.select(column).distinct().agg(F.count(column).alias("n")).scalar()


def with_dimensions(readings: DataFrame, holidays: DataFrame, sensors: DataFrame,
                    default_limit: float = 65.0, default_road: str = "unknown") -> DataFrame:
    """``is_holiday`` (by ``holidays(date)``), ``speed_limit`` and ``road_type`` (by
    ``sensors(edge_id, speed_limit, road_type)``) per reading, with defaults."""
    h = holidays.select(F.col("date").alias("_date")).distinct().withColumn("_holiday", F.lit(1))
    d = sensors.select("edge_id", F.col("speed_limit").alias("_limit"), F.col("road_type").alias("_road"))
    j = readings.join(h, F.to_date("timestamp") == F.col("_date"), "left").join(off_its_keys(d), "edge_id", "left")
    return (j.withColumn("is_holiday", F.coalesce("_holiday", F.lit(0)))
            .withColumn("speed_limit", F.coalesce("_limit", F.lit(float(default_limit))))
            .withColumn("road_type", F.coalesce("_road", F.lit(default_road))).drop("_date", "_holiday", "_limit", "_road"))
