"""Sliding multi-step windows and window-level series functions.

Windows stay in long form: one row per (label_start, edge_id) with the input
history ``x`` (oldest first) and the labels ``y`` as arrays built from
``lag``/``lead`` — never ``collect_list``, which drops NULLs and shortens arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velograph.operators.align import with_halo
from velograph.session import materialize

# Fixed values that must equal the reference's.
HORIZONS_MIN = (15, 30, 45, 60)   # evaluation / serving horizons (minutes)
EVAL_EMA_ALPHA = 0.3              # offline evaluation baseline smoothing
REPLAY_EMA_ALPHA = 0.2            # replay / residual reference smoothing
T_IN = 12
T_OUT = 12


def sliding_windows(grid: DataFrame, freq_minutes: int, t_in: int = T_IN, t_out: int = T_OUT,
                    label_day: Column | None = None, all_within_day: bool = False,
                    drop_missing: bool = True) -> DataFrame:
    """``(label_start, edge_id, x, y)``.

    * ``label_day``: only label starts on that day, and the whole label span
      must stay inside it (W12). ``None`` → every start, also windows over midnight
      (training windows).
    * ``all_within_day``: the inputs must also lie in the same day (W13).
    * ``drop_missing``: drop a label start for *all* sensors when any sensor
      has a missing value in x or y (cross-sensor completeness, J13): the ticks
      that any sensor misses are one small aggregate, joined to the grid, and a
      sliding max over the window's own span spots them.

    Partitions are sensor-days with a halo of ``t_in`` rows before and
    ``t_out − 1`` after, so no partition grows with the history length.
    """
    g = grid
    if label_day is not None:
        g = g.where((F.col("day") >= label_day - F.expr("INTERVAL 1 DAY")) & (F.col("day") <= label_day))
    g = g.select("edge_id", "day", "timestamp", "speed")
    if drop_missing:
        # a tick is bad when any sensor misses it: few rows, combined before they are shuffled
        bad = g.where(F.col("speed").isNull()).groupBy(F.col("timestamp").alias("_tick")).agg(F.lit(1).alias("_bad"))
        g = g.join(bad, F.col("timestamp") == F.col("_tick"), "left").withColumn("_bad", F.coalesce("_bad", F.lit(0))).drop("_tick")
    g = with_halo(g, freq_minutes, before_rows=t_in, after_rows=max(t_out - 1, 0))
    w = Window.partitionBy("edge_id", "pday").orderBy("timestamp")
    x = F.array(*[F.lag("speed", k).over(w) for k in range(t_in, 0, -1)])
    y = F.array(F.col("speed"), *[F.lead("speed", k).over(w) for k in range(1, t_out)])
    first_ts = F.lag("timestamp", t_in).over(w)
    last_ts = F.lead("timestamp", t_out - 1).over(w) if t_out > 1 else F.col("timestamp")
    spoiled = (F.max("_bad").over(w.rowsBetween(-t_in, max(t_out - 1, 0))) if drop_missing
               else F.lit(0))
    out = g.select("edge_id", "day", "pday", F.col("timestamp").alias("label_start"),
                   x.alias("x"), y.alias("y"), first_ts.alias("_t0"), last_ts.alias("_t1"),
                   spoiled.alias("_spoiled"))
    keep = (F.col("day") == F.col("pday")) & F.col("_t0").isNotNull() & F.col("_t1").isNotNull()
    keep = keep & (F.col("_spoiled") == 0)
    if all_within_day:
        keep = keep & (F.date_trunc("DAY", F.col("_t0")) == F.col("day"))
    if label_day is not None:
        keep = keep & (F.col("day") == label_day) & (F.date_trunc("DAY", F.col("_t1")) == F.col("day"))
    return out.where(keep).select("label_start", "edge_id", "x", "y")


def windows_long(windows: DataFrame) -> DataFrame:
    """Explode ``x``/``y`` to ``(label_start, edge_id, role, step, value)``."""
    xs = windows.select("label_start", "edge_id", F.lit("x").alias("role"),
                        F.posexplode("x").alias("step", "value"))
    ys = windows.select("label_start", "edge_id", F.lit("y").alias("role"),
                        F.posexplode("y").alias("step", "value"))
    return xs.unionByName(ys).withColumn("step", F.col("step") + 1)


def ema(x: str | Column, alpha: float) -> Column:
    """``e = x0; e = a*x + (1-a)*e`` over an array, oldest first."""
    x = F.col(x) if isinstance(x, str) else x
    a, b = float(alpha), float(1.0 - alpha)
    return F.aggregate(F.slice(x, 2, F.greatest(F.size(x) - 1, F.lit(0))), F.element_at(x, 1),
                       lambda e, v: F.lit(a) * v + F.lit(b) * e)


def last_value(x: str | Column) -> Column:
    """Last tick of the history."""
    return F.element_at(F.col(x) if isinstance(x, str) else x, -1)


def prefix_steps(t_out: int, horizon_minutes: int) -> int:
    """Label steps scored for a horizon (minutes per step = 60 / T_out)."""
    if t_out == 1:
        mps = 60
    else:
        if 60 % t_out != 0:
            raise ValueError(f"60 minutes not divisible by T_out={t_out}")
        mps = 60 // t_out
    return max(1, min(t_out, horizon_minutes // mps))


def point_index(freq_minutes: int, t_out: int, horizons=HORIZONS_MIN) -> list[tuple[int, int]]:
    """(horizon, 1-based label index) pairs; indices outside 1..T_out are skipped."""
    per15 = max(1, 15 // freq_minutes)
    return [(h, i * per15) for i, h in enumerate(horizons, start=1) if 1 <= i * per15 <= t_out]


def first_n_windows(windows: DataFrame, n: int) -> DataFrame:
    """O3: the windows of the ``n`` earliest label starts (a sampling feature)."""
    starts = windows.select("label_start").distinct().orderBy("label_start").limit(n)
    return windows.join(starts, "label_start", "left_semi")


def shuffled_batches(windows: DataFrame, batch_size: int = 512, seed: int = 0) -> DataFrame:
    """Seeded shuffle of label starts into fixed-size batches (last one kept).

    Label starts are ordered by an MD5 of seed and instant and numbered by
    ``numbered`` (per-partition counts), then joined back.
    """
    starts = (windows.select("label_start").distinct()
              .withColumn("_h", F.md5(F.concat(F.lit(f"{seed}:"), F.unix_micros("label_start").cast("string")))))
    batches = numbered(starts, ["_h", "label_start"]).select(
        "label_start", F.floor((F.col("position") - 1) / batch_size).cast("int").alias("batch"))
    return windows.join(batches, "label_start")


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with ``position`` 1..n in the given order: a range-partitioned sort, written
    once, whose partitions are numbered inside and shifted by the rows before them."""
    rank = Window.partitionBy("_part").orderBy(*order)
    sorted_ = materialize(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "numbered")
    sizes = sorted_.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (sorted_.withColumn("_in", F.row_number().over(rank)).join(sizes, "_part")
            .withColumn("position", F.col("_in") + F.col("_before")).drop("_part", "_in", "_before"))
