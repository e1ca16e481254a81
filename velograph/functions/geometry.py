"""Planar geometry on ``ARRAY<STRUCT<lon, lat>>`` polylines (degrees), HOFs only.

Formulas are produced as SQL text by one builder and used by Spark (through
``F.expr``) and by the DuckDB oracle, so both evaluate the same operations in
the same order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def num(x: float, dialect: str = "spark") -> str:
    return f"{float(x)!r}D" if dialect == "spark" else f"{float(x)!r}::DOUBLE"


def seg_dist_sql(px: str, py: str, ax: str, ay: str, bx: str, by: str, dialect: str = "spark") -> str:
    """Distance from point p to segment ab (projection clamped to [0, 1])."""
    z, one = num(0.0, dialect), num(1.0, dialect)
    vx, vy = f"({bx} - {ax})", f"({by} - {ay})"
    wx, wy = f"({px} - {ax})", f"({py} - {ay})"
    l2 = f"({vx} * {vx} + {vy} * {vy})"
    t = f"(CASE WHEN {l2} = {z} THEN {z} ELSE greatest({z}, least({one}, ({wx} * {vx} + {wy} * {vy}) / {l2})) END)"
    dx = f"({px} - ({ax} + {t} * {vx}))"
    dy = f"({py} - ({ay} + {t} * {vy}))"
    return f"sqrt({dx} * {dx} + {dy} * {dy})"


def seg_len_sql(ax: str, ay: str, bx: str, by: str) -> str:
    return f"sqrt(({bx} - {ax}) * ({bx} - {ax}) + ({by} - {ay}) * ({by} - {ay}))"


def point_line_distance(px: str, py: str, geom: str = "geom") -> Column:
    """Min distance from (px, py) to any segment of ``geom``."""
    d = seg_dist_sql(px, py, "a.lon", "a.lat", f"{geom}[i + 1].lon", f"{geom}[i + 1].lat")
    return F.expr(f"array_min(transform(slice({geom}, 1, size({geom}) - 1), (a, i) -> {d}))")


def line_length(geom: str = "geom") -> Column:
    seg = seg_len_sql("a.lon", "a.lat", f"{geom}[i + 1].lon", f"{geom}[i + 1].lat")
    return F.expr(f"aggregate(transform(slice({geom}, 1, size({geom}) - 1), (a, i) -> {seg}), 0D, (s, v) -> s + v)")


def line_centroid(geom: str = "geom") -> tuple[Column, Column]:
    """Length-weighted mean of segment midpoints."""
    seg = seg_len_sql("a.lon", "a.lat", f"{geom}[i + 1].lon", f"{geom}[i + 1].lat")
    parts = f"transform(slice({geom}, 1, size({geom}) - 1), (a, i) -> named_struct(" \
            f"'l', {seg}, 'mx', (a.lon + {geom}[i + 1].lon) / 2D, 'my', (a.lat + {geom}[i + 1].lat) / 2D))"
    tot = f"aggregate({parts}, 0D, (s, p) -> s + p.l)"
    cx = f"aggregate({parts}, 0D, (s, p) -> s + p.l * p.mx) / {tot}"
    cy = f"aggregate({parts}, 0D, (s, p) -> s + p.l * p.my) / {tot}"
    return F.expr(cx), F.expr(cy)


def bbox(geom: str = "geom") -> dict[str, Column]:
    return {
        "min_lon": F.expr(f"array_min(transform({geom}, p -> p.lon))"),
        "max_lon": F.expr(f"array_max(transform({geom}, p -> p.lon))"),
        "min_lat": F.expr(f"array_min(transform({geom}, p -> p.lat))"),
        "max_lat": F.expr(f"array_max(transform({geom}, p -> p.lat))"),
    }


def point_distance(ax: str, ay: str, bx: str, by: str) -> Column:
    return F.expr(seg_len_sql(ax, ay, bx, by))
