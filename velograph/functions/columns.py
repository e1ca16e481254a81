"""Scalar column expressions (all built-in Spark functions, codegen friendly).

Rule for the whole library: NaN becomes NULL at every source, NULL is the
only "missing" inside, and every clip/compare is written NULL-safe.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's.
SPEED_MIN = 0.0            # clip lower bound (mph)
SPEED_MAX = 150.0          # clip upper bound (mph)
FREE_FLOW_MPH = 65.0       # linear congestion weight reference speed
CONGESTED_RATIO = 0.4      # step congestion weight threshold (speed / p90)
CONGESTED_WEIGHT = 2.0     # step congestion weight when below threshold
P90_FLOOR = 1.0            # lower bound on the per-sensor free-flow percentile
LINEAR_WEIGHT_SPAN = 4.0   # weight = 1 + 4 * congestion


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """NaN → NULL."""
    c = col_(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c.cast("double"))


def safe_double(c: str | Column) -> Column:
    """Lenient numeric parse (S6/P13): bad strings and NaN → NULL."""
    return nan_to_null(col_(c).try_cast("double"))


def clip(c: str | Column, lo: float = SPEED_MIN, hi: float = SPEED_MAX) -> Column:
    """NULL-safe clip (P1): NULL and NaN stay NULL; bare least/greatest would not."""
    c = col_(c)
    return (F.when(c.isNull() | F.isnan(c), F.lit(None).cast("double"))
            .otherwise(F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), c))))


def day_of(ts: str | Column) -> Column:
    """Floor to the calendar day."""
    return F.date_trunc("DAY", col_(ts))


def epoch_micros(ts: str | Column) -> Column:
    return F.unix_micros(col_(ts).cast("timestamp"))


def to_ntz(ts: str | Column) -> Column:
    """Output form of instants: naive wall-clock timestamp."""
    return col_(ts).cast("timestamp_ntz")


def calendar_features(ts: str | Column) -> dict[str, Column]:
    """Hour, minute, time_of_day, day_of_week (Mon=0), is_weekend, month."""
    t = col_(ts)
    hour = F.hour(t)
    minute = F.minute(t)
    dow = F.weekday(t)
    return {
        "hour": hour,
        "minute": minute,
        "time_of_day": (hour * 60 + minute).cast("double") / F.lit(1440.0),
        "day_of_week": dow,
        "is_weekend": F.when(dow >= 5, F.lit(1)).otherwise(F.lit(0)),
        "month": F.month(t),
    }


def step_weight(speed: str | Column, p90: str | Column) -> Column:
    """2.0 when speed / max(p90, 1) < 0.4, else 1.0 (missing → 1.0)."""
    ratio = col_(speed) / F.greatest(col_(p90), F.lit(P90_FLOOR))
    return F.when(ratio < F.lit(CONGESTED_RATIO), F.lit(CONGESTED_WEIGHT)).otherwise(F.lit(1.0))


def linear_weight(speed: str | Column, free_flow: float = FREE_FLOW_MPH) -> Column:
    """P10: 1 + 4 * (1 - clip(v / 65, 0, 1)); NULL stays NULL."""
    congestion = F.lit(1.0) - clip(col_(speed) / F.lit(free_flow), 0.0, 1.0)
    return F.lit(1.0) + F.lit(LINEAR_WEIGHT_SPAN) * congestion


def parse_epoch_or_iso(s: str | Column) -> Column:
    """Epoch seconds first, ISO-8601 (trailing Z allowed) second, else NULL."""
    s = col_(s).cast("string")
    as_number = s.try_cast("double")
    iso = F.regexp_replace(F.trim(s), "Z$", "+00:00")
    as_ts = F.try_to_timestamp(iso)
    return F.coalesce(as_number, F.unix_micros(as_ts).cast("double") / F.lit(1e6))


def sigma_guard(sigma: str | Column) -> Column:
    """Missing sigma → 1, zero sigma → 1."""
    s = F.coalesce(col_(sigma), F.lit(1.0))
    return F.when(s == 0.0, F.lit(1.0)).otherwise(s)


def round_to(c: str | Column, digits: int = 6) -> Column:
    """Round in two stages: to ``digits + 3`` places (absorbs last-bit noise
    from summation order), then to ``digits`` — each as ``round(x·10^d)/10^d``
    on the binary double, half away from zero. Engines that round this way
    give identical results even on exact decimal ties."""
    def once(x: Column, d: int) -> Column:
        scale = float(10 ** d)
        return F.round(x * F.lit(scale), 0) / F.lit(scale)
    return once(once(col_(c), digits + 3), digits)
