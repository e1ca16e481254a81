"""E2 — held-out day evaluation: grid → fill → clip → last full day → windows → scores.

One lazy plan. Only the held-out day and the day before it are gridded; the
fill state from older history arrives as a per-sensor carry-in row. The history
itself is scanned for its bounds and for the carry-in (the last instants and the
readings there); the scan that feeds the grid is limited to the two days.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velograph.functions.columns import clip
from velograph.operators import align, forecast
from velograph.operators.windows import EVAL_EMA_ALPHA, HORIZONS_MIN, sliding_windows


def heldout_grid(readings: DataFrame, freq_minutes: int, fill_method: str = "ffill",
                 align_mode: str = "exact", recent: Callable[[int, int], DataFrame] | None = None):
    """Filled, clipped grid for the held-out day and the day before; returns (grid, day).

    ``recent(from_us, to_us)`` may give the readings of a time range with the range
    already in the scan; without it the range is a filter on ``readings``."""
    lo_us, hi_us = align.grid_bounds(readings)
    day_us = align.last_full_day_us(lo_us, hi_us, freq_minutes)
    day_from = day_us - align.US_PER_DAY
    # one per-sensor aggregate gives the sensor set and the carry-in instant
    prior = align.edge_boundary(readings, freq_minutes, lo_us, day_from, "before", align_mode)
    posterior = None
    if fill_method in ("interpolate", "ffill_bfill"):
        posterior = align.edge_boundary(readings, freq_minutes, lo_us, day_us, "after", align_mode)
    source = readings if recent is None else recent(day_from, day_us + align.US_PER_DAY)
    grid = align.regular_grid(source, freq_minutes, align=align_mode, day_from_us=day_from,
                              day_to_us=day_us, bounds=(lo_us, hi_us), carry=True,
                              prior=prior if fill_method in ("ffill", "interpolate", "ffill_bfill") else None,
                              posterior=posterior, edges=prior.select("edge_id"))
    filled = align.fill(grid, fill_method).withColumn("speed", clip("speed"))
    return filled, F.timestamp_micros(F.lit(day_us))


def heldout_windows(readings: DataFrame, freq_minutes: int, t_in: int = 12, t_out: int = 12,
                    fill_method: str = "ffill", align_mode: str = "exact",
                    recent: Callable[[int, int], DataFrame] | None = None) -> DataFrame:
    """W12 windows on the last full day (cross-sensor complete)."""
    grid, day = heldout_grid(readings, freq_minutes, fill_method, align_mode, recent)
    return sliding_windows(grid, freq_minutes, t_in, t_out, label_day=day)


def heldout_evaluation(readings: DataFrame, freq_minutes: int, t_in: int = 12, t_out: int = 12,
                       fill_method: str = "ffill", alpha: float = EVAL_EMA_ALPHA,
                       horizons=HORIZONS_MIN, recent: Callable[[int, int], DataFrame] | None = None) -> DataFrame:
    """Flagship: EMA baseline vs last-value MAE/RMSE per horizon on the last full day."""
    w = heldout_windows(readings, freq_minutes, t_in, t_out, fill_method, recent=recent)
    return forecast.evaluation_report(w, t_out, horizons, alpha)
