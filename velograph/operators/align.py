"""Gap handling and alignment on the long readings table.

Layout decision used everywhere below: the gridded table carries a ``day``
column and every time-ordered window is partitioned by ``(edge_id, day)``.
A sensor-day has at most ``1440 / freq`` rows, so no task ever holds an
unbounded group even when one sensor owns a third of all readings; state that
crosses day boundaries (fills, interpolation) travels through a small
per-(edge, day) summary instead of one giant per-edge partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velograph.functions.columns import clip, day_of

US_PER_MIN = 60 * 1_000_000
US_PER_DAY = 86_400 * 1_000_000
FILL_METHODS = ("ffill", "interpolate", "none", "ffill_bfill", "zero")


def _us(c: str | Column) -> Column:
    return F.unix_micros((F.col(c) if isinstance(c, str) else c).cast("timestamp"))


# --------------------------------------------------------------------------- dedup


def dedup_mean(readings: DataFrame) -> DataFrame:
    """One mean per (edge, instant); missing readings are ignored.

    Partial aggregation runs before the shuffle, so duplicate-heavy (hot)
    keys are collapsed map-side.
    """
    return (readings.where(F.col("speed").isNotNull())
            .groupBy("edge_id", "timestamp")
            .agg(F.avg("speed").alias("speed"), F.count("speed").alias("n_obs")))


def duplicate_instants(readings: DataFrame) -> DataFrame:
    """W3 report: (edge, instant) pairs that had more than one reading."""
    return dedup_mean(readings).where(F.col("n_obs") > 1)


# --------------------------------------------------------------------------- grid


def grid_bounds(readings: DataFrame) -> tuple[int, int]:
    """First/last instant with a reading, as epoch micros (one tiny aggregate job).

    Two integers cross to the driver — a bounded scalar, not data — so later
    plans get literals that Catalyst can fold and push into the scan.
    """
    row = (readings.where(F.col("speed").isNotNull())
           .agg(F.unix_micros(F.min("timestamp").cast("timestamp")).alias("lo"),
                F.unix_micros(F.max("timestamp").cast("timestamp")).alias("hi"))
           .first())
    if row is None or row["lo"] is None:
        raise RuntimeError("No readings with a value.")
    return int(row["lo"]), int(row["hi"])


def _ts(us: int) -> Column:
    return F.timestamp_micros(F.lit(int(us)))


def _day_floor(us: int) -> int:
    return (us // US_PER_DAY) * US_PER_DAY


def day_ticks(lo_us: int, hi_us: int, freq_minutes: int, day_us: int) -> int:
    """Ticks of the regular grid (anchored at ``lo``) inside one day."""
    step = int(freq_minutes) * US_PER_MIN
    first_k = max(0, -((lo_us - day_us) // step))
    last_k = min((hi_us - lo_us) // step, (day_us + US_PER_DAY - 1 - lo_us) // step)
    return max(0, last_k - first_k + 1)


def full_days(lo_us: int, hi_us: int, freq_minutes: int) -> list[int]:
    """W11 helper: days (epoch micros) whose tick count equals steps/day."""
    need = steps_per_day(freq_minutes)
    return [d for d in range(_day_floor(lo_us), _day_floor(hi_us) + 1, US_PER_DAY)
            if day_ticks(lo_us, hi_us, freq_minutes, d) == need]


def last_full_day_us(lo_us: int, hi_us: int, freq_minutes: int) -> int:
    """Latest full calendar day; raises like the reference when none."""
    days = full_days(lo_us, hi_us, freq_minutes)
    if not days:
        raise RuntimeError("No full calendar day found to use as held-out.")
    return days[-1]


def _tick_range(day: Column, lo_us: Column, hi_us: Column, step_us: int) -> tuple[Column, Column]:
    """First/last grid index k (tick = lo + k*step) that falls inside ``day``."""
    d0 = _us(day)
    first_k = F.greatest(F.lit(0).cast("long"),
                         F.ceil((d0 - lo_us).cast("double") / F.lit(float(step_us))).cast("long"))
    last_k = F.least(F.floor((hi_us - lo_us) / F.lit(step_us)).cast("long"),
                     F.floor((d0 + F.lit(US_PER_DAY) - F.lit(1) - lo_us) / F.lit(step_us)).cast("long"))
    return first_k, last_k


def regular_grid(readings: DataFrame, freq_minutes: int, align: str = "exact",
                 day_from_us: int | None = None, day_to_us: int | None = None,
                 bounds: tuple[int, int] | None = None, carry: bool = False,
                 prior: DataFrame | None = None, posterior: DataFrame | None = None,
                 edges: DataFrame | None = None) -> DataFrame:
    """W4 (+W1/W3): every sensor on a regular grid from min to max instant.

    ``align='exact'`` keeps only readings that sit exactly on a tick (others
    are dropped, as a reindex does); ``'bucket'`` floors readings to the tick
    before averaging. Duplicates average. Output ``(edge_id, day, timestamp,
    speed, n_obs)``; ``speed`` is NULL on gaps. ``day_from_us``/``day_to_us``
    restrict the grid (and the scanned readings) to a day range.

    ``carry=True`` also attaches ``_cprev``/``_cnext``: each gap's nearest observation
    before/after it, on its day or another (from ``prior``/``posterior`` outside the
    range), so ``fill`` sorts no grid rows.

    Plan: readings → partial-aggregating mean per (sensor, day, tick) → one sorted
    list per sensor-day (≤ ticks/day entries) → sensor-day rows (from a generator,
    no cartesian join) → optional carries (a window over days per sensor on the
    days' first and last reading alone) → hash partition by (sensor, day) → ticks
    exploded last, each list read once. Windows by sensor-day reuse this partitioning.
    """
    if align not in ("exact", "bucket"):
        raise ValueError(f"unknown align: {align}")
    step_us = int(freq_minutes) * US_PER_MIN
    if step_us <= 0:
        raise ValueError("freq_minutes must be positive")
    lo_us, hi_us = bounds if bounds is not None else grid_bounds(readings)

    r = readings.where(F.col("speed").isNotNull())
    # Every sensor with any reading gets grid rows, also inside a day range.
    if edges is None:
        edges = r.select("edge_id").distinct()
    first_day, last_day = _day_floor(lo_us), _day_floor(hi_us)
    if day_from_us is not None:
        first_day = max(first_day, day_from_us)
        r = r.where(F.col("timestamp") >= _ts(first_day))
    if day_to_us is not None:
        last_day = min(last_day, day_to_us)
        r = r.where(F.col("timestamp") < _ts(last_day + US_PER_DAY))
    off = _us("timestamp") - F.lit(lo_us)
    if align == "exact":
        r = r.where(off % F.lit(step_us) == 0)
    else:
        r = r.withColumn("timestamp", F.timestamp_micros(
            F.lit(lo_us) + F.floor(off / F.lit(step_us)).cast("long") * F.lit(step_us)))
    r = r.withColumn("day", day_of("timestamp"))

    ticks = (r.withColumn("k", F.floor((_us("timestamp") - F.lit(lo_us)) / F.lit(step_us)).cast("long"))
             .groupBy("edge_id", "day", "k").agg(F.avg("speed").alias("speed"), F.count("speed").alias("n_obs")))
    obs = ticks.groupBy("edge_id", "day").agg(  # at most the ticks of one day
        F.array_sort(F.collect_list(F.struct("k", "speed", "n_obs"))).alias("_obs"))
    days = edges.select("edge_id", F.explode(
        F.sequence(_ts(first_day), _ts(last_day), F.expr("INTERVAL 1 DAY"))).alias("day"))
    if carry:
        days = _day_carries(days, ticks, lo_us, step_us, prior, posterior)
    sd = days.join(obs, ["edge_id", "day"], "left")
    sd = sd.repartition("edge_id", "day")
    first_k, last_k = _tick_range(F.col("day"), F.lit(lo_us), F.lit(hi_us), step_us)
    extra = [c for c in ("_cprev", "_cnext") if c in sd.columns]
    # a reading's tick opens a run of ticks up to the next reading's; the day's first tick opens one too
    none = F.expr("cast(array() as array<struct<k:bigint,speed:double,n_obs:bigint>>)")
    lead_in = F.array(F.struct(F.col("_k0").alias("k"), F.lit(None).cast("double").alias("speed"), F.lit(0).cast("long").alias("n_obs")))
    sd = sd.withColumn("_k0", first_k).withColumn("_k1", last_k).where("_k0 <= _k1").withColumn("_obs", F.coalesce("_obs", none))
    runs = F.when(F.get("_obs", F.lit(0))["k"] == F.col("_k0"), F.col("_obs")).otherwise(F.concat(lead_in, "_obs"))
    sd = sd.withColumn("_runs", runs)
    spans = F.transform("_runs", lambda o, i: F.struct(o.alias("o"), F.get("_runs", i + 1).alias("next")))
    g = sd.select("edge_id", "day", "_k1", *extra, F.explode(spans).alias("_s"))
    # only the lead-in has no reading of its own, only the last run none behind it
    near = {"_cprev": F.when(F.col("_s.o.speed").isNull(), F.col("_cprev")).otherwise(_point(F.col("_s.o"), lo_us, step_us)),
            "_cnext": F.when(F.col("_s.next").isNull(), F.col("_cnext")).otherwise(_point(F.col("_s.next"), lo_us, step_us))}
    to = F.coalesce(F.col("_s.next.k"), F.col("_k1") + 1) - 1
    g = g.select("edge_id", "day", *(near[c].alias(c) for c in extra), F.col("_s.o").alias("_o"), F.explode(F.sequence(F.col("_s.o.k"), to)).alias("k"))
    opens = F.col("k") == F.col("_o.k")
    return g.select("edge_id", "day", F.timestamp_micros(F.lit(lo_us) + F.col("k") * F.lit(step_us)).alias("timestamp"),
                    F.when(opens, F.col("_o.speed")).alias("speed"),
                    F.when(opens, F.col("_o.n_obs")).otherwise(F.lit(0)).cast("long").alias("n_obs"), *extra)


def _point(tick: Column, lo_us: int, step_us: int) -> Column:
    """A tick's reading as the struct (ts, v)."""
    return F.struct(F.timestamp_micros(F.lit(lo_us) + tick["k"] * F.lit(step_us)).alias("ts"), tick["speed"].alias("v"))


def _day_carries(days: DataFrame, ticks: DataFrame, lo_us: int, step_us: int,
                 prior: DataFrame | None, posterior: DataFrame | None) -> DataFrame:
    """Per sensor-day: nearest observation on an earlier / later day (or outside the
    range). Only the first and last reading of each sensor-day take part: the window
    over a sensor's days holds two small structs a day, never its readings."""
    point = _point(F.struct("k", "speed"), lo_us, step_us)
    ends = ticks.groupBy("edge_id", "day").agg(F.max_by(point, "k").alias("_last"), F.min_by(point, "k").alias("_first"))
    days = days.join(ends, ["edge_id", "day"], "left")
    we = Window.partitionBy("edge_id").orderBy("day")
    back = Window.partitionBy("edge_id").orderBy(F.desc("day"))
    days = days.withColumn("_cprev", F.last("_last", True).over(we.rowsBetween(Window.unboundedPreceding, -1)))
    days = days.withColumn("_cnext", F.last("_first", True).over(back.rowsBetween(Window.unboundedPreceding, -1)))
    if prior is not None:
        p = prior.where(F.col("ts").isNotNull()).select("edge_id", F.struct(F.col("ts"), F.col("v")).alias("_pin"))
        days = days.join(p, "edge_id", "left").withColumn("_cprev", F.coalesce("_cprev", "_pin")).drop("_pin")
    if posterior is not None:
        q = posterior.where(F.col("ts").isNotNull()).select("edge_id", F.struct(F.col("ts"), F.col("v")).alias("_nin"))
        days = days.join(q, "edge_id", "left").withColumn("_cnext", F.coalesce("_cnext", "_nin")).drop("_nin")
    return days.drop("_last", "_first")


def grid_day_ticks(readings: DataFrame, freq_minutes: int,
                   bounds: tuple[int, int] | None = None) -> DataFrame:
    """A7 on the grid: ticks per calendar day, computed from the bounds alone."""
    step_us = int(freq_minutes) * US_PER_MIN
    lo_us, hi_us = bounds if bounds is not None else grid_bounds(readings)
    days = readings.sparkSession.range(1).select(F.explode(
        F.sequence(_ts(_day_floor(lo_us)), _ts(_day_floor(hi_us)), F.expr("INTERVAL 1 DAY"))).alias("day"))
    first_k, last_k = _tick_range(F.col("day"), F.lit(lo_us), F.lit(hi_us), step_us)
    return days.select("day", (last_k - first_k + 1).alias("ticks")).where(F.col("ticks") > 0)


def steps_per_day(freq_minutes: int) -> int:
    """W10 on a regular grid: int(1 day / step)."""
    if freq_minutes <= 0:
        raise ValueError("Non-increasing timestamps.")
    return int(1440 // freq_minutes)


def sampling_step(readings: DataFrame) -> DataFrame:
    """W10 on raw instants: step = second smallest − smallest distinct instant."""
    t = readings.select("timestamp").where(F.col("timestamp").isNotNull())
    first = t.agg(F.min("timestamp").alias("t0")).select("t0").scalar()
    second = (t.where(F.col("timestamp") > first)
              .agg(F.min("timestamp").alias("t1")).select("t1").scalar())
    step_s = (_us(second) - _us(first)) / F.lit(1_000_000)
    return readings.sparkSession.range(1).select(
        step_s.cast("long").alias("step_seconds"),
        F.when(step_s > 0, F.floor(F.lit(86_400) / step_s)).cast("long").alias("steps_per_day"))


def ticks_per_day(grid: DataFrame) -> DataFrame:
    """Distinct instants per calendar day of a (gridded or raw) table."""
    return (grid.select(day_of("timestamp").alias("day"), "timestamp").distinct()
            .groupBy("day").agg(F.count("*").alias("ticks")))


# --------------------------------------------------------------------------- fills


def _backwards():
    """A sensor-day from its end up to the row: a running frame, read once."""
    return (Window.partitionBy("edge_id", "day").orderBy(F.desc("timestamp"))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _prev_next(grid: DataFrame, prior: DataFrame | None,
               posterior: DataFrame | None, need_next: bool) -> DataFrame:
    """Attach nearest non-missing (ts, value) before/after each row.

    Inside a sensor-day a bounded window finds them; across days a per-(edge,
    day) summary is scanned per edge (days, not readings); ``prior`` /
    ``posterior`` give ``(edge_id, ts, v)`` from outside the gridded range.
    """
    obs = F.when(F.col("speed").isNotNull(), F.struct(F.col("timestamp").alias("ts"),
                                                      F.col("speed").alias("v")))
    wd = Window.partitionBy("edge_id", "day").orderBy("timestamp")
    g = grid.withColumn("_obs", obs)
    g = g.withColumn("_prev", F.last("_obs", True).over(
        wd.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    if need_next:
        g = g.withColumn("_next", F.last("_obs", True).over(_backwards()))

    summ = grid.groupBy("edge_id", "day").agg(
        F.max_by(obs, F.when(F.col("speed").isNotNull(), F.col("timestamp"))).alias("_last"),
        F.min_by(obs, F.when(F.col("speed").isNotNull(), F.col("timestamp"))).alias("_first"))
    we = Window.partitionBy("edge_id").orderBy("day")
    summ = summ.withColumn("_cprev", F.last("_last", True).over(
        we.rowsBetween(Window.unboundedPreceding, -1)))
    if need_next:
        back = Window.partitionBy("edge_id").orderBy(F.desc("day"))
        summ = summ.withColumn("_cnext", F.last("_first", True).over(
            back.rowsBetween(Window.unboundedPreceding, -1)))
    if prior is not None:
        p = prior.where(F.col("ts").isNotNull()).select("edge_id", F.struct(F.col("ts"), F.col("v")).alias("_pin"))
        summ = summ.join(p, "edge_id", "left").withColumn(
            "_cprev", F.coalesce("_cprev", "_pin")).drop("_pin")
    if need_next and posterior is not None:
        q = posterior.where(F.col("ts").isNotNull()).select("edge_id", F.struct(F.col("ts"), F.col("v")).alias("_nin"))
        summ = summ.join(q, "edge_id", "left").withColumn(
            "_cnext", F.coalesce("_cnext", "_nin")).drop("_nin")
    cols = ["edge_id", "day", "_cprev"] + (["_cnext"] if need_next else [])
    g = g.join(summ.select(*cols), ["edge_id", "day"], "left")
    g = g.withColumn("_prev", F.coalesce("_prev", "_cprev"))
    if need_next:
        g = g.withColumn("_next", F.coalesce("_next", "_cnext"))
    return g


def fill(grid: DataFrame, method: str = "ffill", prior: DataFrame | None = None,
         posterior: DataFrame | None = None) -> DataFrame:
    """W5 ffill / W6 interpolate (both ends extended) / W7 none / W8 ffill+bfill / C1 zero."""
    if method not in FILL_METHODS:
        raise ValueError(f"Unknown fill_method: {method}")
    if method == "none":
        return grid
    if method == "zero":
        return grid.withColumn("speed", F.coalesce("speed", F.lit(0.0)))
    need_next = method in ("interpolate", "ffill_bfill")
    if "_cprev" in grid.columns:
        g = grid.withColumns({"_prev": F.col("_cprev"), "_next": F.col("_cnext")})
    else:
        g = _prev_next(grid, prior, posterior, need_next)
    pv, nv = F.col("_prev.v"), F.col("_next.v") if need_next else None
    if method == "ffill":
        filled = F.coalesce(F.col("speed"), pv)
    elif method == "ffill_bfill":
        filled = F.coalesce(F.col("speed"), pv, nv)
    else:
        pt, nt = _us("_prev.ts"), _us("_next.ts")
        frac = (_us("timestamp") - pt).cast("double") / (nt - pt).cast("double")
        lerp = pv + (nv - pv) * frac
        filled = (F.when(F.col("speed").isNotNull(), F.col("speed"))
                  .when(F.col("_prev").isNotNull() & F.col("_next").isNotNull(), lerp)
                  .otherwise(F.coalesce(pv, nv)))
    return g.withColumn("speed", filled).drop("_obs", "_prev", "_next", "_cprev", "_cnext")


def edge_boundary(readings: DataFrame, freq_minutes: int, lo_us: int, day_us: int,
                  side: str = "before", align: str = "exact") -> DataFrame:
    """Carry-in/out per sensor → ``(edge_id, ts, v)`` for *every* sensor with a reading:
    the last on-grid instant before ``day`` (``side='before'``) or the first after
    the end of ``day`` (``'after'``), with the mean reading there (NULL if none).

    One partial-aggregating ``groupBy(edge_id)`` finds the instant; the mean
    comes from joining the readings at exactly that (sensor, instant) — the
    history is scanned, never shuffled per instant. The sensor list doubles as
    the grid's sensor set.
    """
    step_us = int(freq_minutes) * US_PER_MIN
    r = readings.where(F.col("speed").isNotNull())
    off = _us("timestamp") - F.lit(lo_us)
    if align == "exact":
        on_grid = off % F.lit(step_us) == 0
        tick = F.col("timestamp")
    else:
        on_grid = F.lit(True)
        tick = F.timestamp_micros(F.lit(lo_us) + F.floor(off / F.lit(step_us)).cast("long") * F.lit(step_us))
    r = r.withColumn("_t", F.when(on_grid, tick))
    if side == "before":
        sel = F.max(F.when(F.col("_t") < _ts(day_us), F.col("_t")))
    else:
        sel = F.min(F.when(F.col("_t") >= _ts(day_us + US_PER_DAY), F.col("_t")))
    at = r.groupBy("edge_id").agg(sel.alias("ts"))
    key = at.where(F.col("ts").isNotNull()).select(F.col("edge_id").alias("_e"), F.col("ts").alias("_at"))
    vals = (r.select("edge_id", "_t", "speed").join(key, (F.col("edge_id") == F.col("_e")) &
                                                    (F.col("_t") == F.col("_at")))
            .groupBy(F.col("_e").alias("edge_id")).agg(F.avg("speed").alias("v")))
    return at.join(vals, "edge_id", "left").select("edge_id", "ts", "v")


def to_regular(readings: DataFrame, freq_minutes: int, fill_method: str = "ffill",
               align: str = "exact") -> DataFrame:
    """W1–W7 + P1 in one call: grid, fill, clip to [0, 150]."""
    g = fill(regular_grid(readings, freq_minutes, align=align, carry=True), fill_method)
    return g.withColumn("speed", clip("speed"))


def with_halo(grid: DataFrame, freq_minutes: int, before_rows: int,
              after_rows: int = 0) -> DataFrame:
    """Copy each day's boundary rows into the neighbouring day's partition.

    Adds ``pday``: a row belongs to its own day and, when it lies within
    ``before_rows`` ticks of the next day (``after_rows`` of the previous day),
    also to that day. Windows partitioned by ``(edge_id, pday)`` then see the
    look-back/look-ahead they need while each partition stays one day long.
    Keep the result rows with ``day == pday``.
    """
    step_us = int(freq_minutes) * US_PER_MIN
    if max(before_rows, after_rows) * step_us > US_PER_DAY:
        raise ValueError("halo longer than one day: look-back/look-ahead must fit in a day of ticks")
    t, d = _us("timestamp"), _us("day")
    nxt = F.when(t >= d + F.lit(US_PER_DAY - before_rows * step_us),
                 F.col("day") + F.expr("INTERVAL 1 DAY"))
    prv = F.when(t < d + F.lit(after_rows * step_us), F.col("day") - F.expr("INTERVAL 1 DAY"))
    opts = F.filter(F.array(F.col("day"), nxt, prv), lambda x: x.isNotNull())
    return grid.withColumn("pday", F.explode(opts))


def history_arrays(grid: DataFrame, freq_minutes: int, t_in: int = 12) -> DataFrame:
    """W9 + W17: rolling last-``t_in`` instants per sensor as ``(edge_id, timestamp, x)``,
    emitted only once full.

    Inside the window each slot is forward filled from earlier slots; a window
    with no value at all becomes zeros; a leading gap stays missing. Partitions
    are sensor-days plus a (t_in − 1)-row halo, never a whole sensor history.
    """
    g = with_halo(grid, freq_minutes, before_rows=t_in - 1)
    w = Window.partitionBy("edge_id", "pday").orderBy("timestamp")
    frame = w.rowsBetween(-(t_in - 1), 0)
    any_v = F.last("speed", True).over(frame)
    slots = []
    for j in range(t_in):
        back = t_in - 1 - j
        v = F.last("speed", True).over(w.rowsBetween(-(t_in - 1), -back))
        slots.append(F.when(any_v.isNull(), F.lit(0.0)).otherwise(v))
    g = g.select("edge_id", "day", "pday", "timestamp",
                 F.count("*").over(frame).alias("_n"), F.array(*slots).alias("x"))
    return (g.where((F.col("day") == F.col("pday")) & (F.col("_n") == t_in))
            .select("edge_id", "timestamp", "x"))


def history_fill(grid: DataFrame, freq_minutes: int, t_in: int = 12) -> DataFrame:
    """``history_arrays`` exploded to ``(edge_id, timestamp, slot, value)``, slot 1 = oldest."""
    h = history_arrays(grid, freq_minutes, t_in)
    return h.select("edge_id", "timestamp", F.posexplode("x").alias("slot", "value")).withColumn(
        "slot", F.col("slot") + 1)
