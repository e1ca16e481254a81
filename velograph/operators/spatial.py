"""Sensor ↔ road-edge mapping, IDW interpolation and mapping QA
(J4–J16, A11, A12, P8, P11, P12, P20, S16, C2, C6).

Distance ("theta") joins are written as equi-joins on grid cells: every
sensor sits in exactly one cell, every edge is expanded to the cells its
bounding box (grown by the search radius) touches, the join is on the cell,
and the exact distance filters afterwards — no nested-loop or cartesian join.
Top-k per edge runs in two stages over a salted key, so one edge with a huge
candidate set never sorts in a single task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velograph.functions import geometry as geo
from velograph.operators.windows import numbered
from velograph.session import materialize

# Fixed values that must equal the reference's.
MAP_RADIUS_DEG = 0.001        # sensor → edge candidate radius (~100 m)
IDW_RADIUS_DEG = 0.02         # interpolation radius (~2 km)
IDW_K = 5                     # nearest sensors per uncovered edge
KM_PER_DEG = 111.0
SPLIT_MIN_LENGTH_DEG = 0.001
QA_MAX_INTERP_KM = 3.0
QA_MAX_ERRORS = 10
MAJOR_ROADS = ["motorway", "trunk", "primary", "secondary", "motorway_link"]
BAY_AREA_BBOX = {"north": 38.0, "south": 37.2, "east": -121.7, "west": -122.5}
# Known sensor coordinates: sensor_id, latitude, longitude, highway, direction.
KNOWN_SENSORS = [
    (400001, 37.3382, -121.8863, "I-880", "North"),
    (400002, 37.3352, -121.8833, "I-880", "South"),
    (400003, 37.4419, -122.1430, "US-101", "North"),
    (400004, 37.4389, -122.1400, "US-101", "South"),
    (400005, 37.3688, -122.0363, "I-280", "North"),
    (400006, 37.3658, -122.0333, "I-280", "South"),
]


# --------------------------------------------------------------------------- sources


def sensor_table(ids: DataFrame) -> DataFrame:
    """``(sensor_id, idx)`` → sensor metadata; known coordinates win,
    everything else gets the index-derived fallback position."""
    spark = ids.sparkSession
    # a JVM-side literal table (no Python-backed RDD, no Python workers)
    known = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(sid).cast("long").alias("sensor_id"), F.lit(lat).alias("k_lat"),
                 F.lit(lon).alias("k_lon"), F.lit(hw).alias("k_highway"), F.lit(dr).alias("k_direction"))
        for sid, lat, lon, hw, dr in KNOWN_SENSORS])))
    i = F.col("idx")
    j = ids.join(F.broadcast(known), "sensor_id", "left")  # fixed 6-row table
    return j.select(
        "sensor_id",
        F.coalesce("k_lat", F.lit(37.4) + (i % 50).cast("double") * F.lit(0.01)).alias("latitude"),
        F.coalesce("k_lon", F.lit(-122.2) + F.expr("idx div 50").cast("double") * F.lit(0.01)).alias("longitude"),
        F.coalesce("k_highway", F.concat(F.lit("Highway-"), F.expr("idx div 10").cast("string"))).alias("highway"),
        F.coalesce("k_direction", F.when(i % 2 == 0, "North").otherwise("South")).alias("direction"))


def major_roads(edges: DataFrame, classes=MAJOR_ROADS) -> DataFrame:
    """Keep major road classes."""
    return edges.where(F.col("highway").isin(list(classes)))


def in_bbox(df: DataFrame, lat: str = "latitude", lon: str = "longitude", box=BAY_AREA_BBOX) -> DataFrame:
    """Bounding-box filter."""
    return df.where(F.col(lat).between(box["south"], box["north"]) &
                    F.col(lon).between(box["west"], box["east"]))


def edge_geometry(edges: DataFrame) -> DataFrame:
    """Bounding box, length and centroid columns for road edges. Geometry is costly per
    row, so the rows are dealt over all shuffle partitions, whatever files they come from."""
    cx, cy = geo.line_centroid("geom")
    n = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return edges.repartition(n, "edge_id").select("*", *[c.alias(n) for n, c in geo.bbox("geom").items()],
                        geo.line_length("geom").alias("length"), cx.alias("cx"), cy.alias("cy"))


# --------------------------------------------------------------------------- joins


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / F.lit(size)).cast("long")


DENSE_CELL = 4096     # sensors of one cell that one task joins


def _join_cells(sensors: DataFrame, others: DataFrame, limit: int = DENSE_CELL) -> DataFrame:
    """Equi-join on the cell ``(gx, gy)``. The sensors of a cell with more than ``limit``
    are dealt over so many parts, and the cell's other rows go to each of them, so a
    dense cell is no single task. Only dense cells are listed for this."""
    dense = (sensors.groupBy("gx", "gy").agg(F.count("*").alias("_n")).where(F.col("_n") > limit)
             .select("gx", "gy", F.ceil(F.col("_n") / limit).cast("int").alias("_parts")))
    left = sensors.join(dense, ["gx", "gy"], "left").withColumn(
        "_part", F.pmod(F.xxhash64("sensor_id"), F.coalesce("_parts", F.lit(1))).cast("int")).drop("_parts")
    right = others.join(dense, ["gx", "gy"], "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return left.join(right, ["gx", "gy", "_part"]).drop("_part")


def candidates(sensors: DataFrame, edges: DataFrame, radius: float = MAP_RADIUS_DEG,
               cell: float | None = None) -> DataFrame:
    """Every (sensor, edge) with point–polyline distance < radius.

    ``cell`` (default 4×radius) trades exploded edge-cell rows against
    candidate pairs per cell; any cell size ≥ radius gives the exact answer.
    """
    c = max(cell or 4 * radius, radius)
    keep = [x for x in ("direction",) if x in sensors.columns]
    s = sensors.select("sensor_id", "latitude", "longitude", *keep,
                       _cell(F.col("longitude"), c).alias("gx"), _cell(F.col("latitude"), c).alias("gy"))
    e = edge_geometry(edges).select(
        "edge_id", "bearing", "geom",
        F.explode(F.sequence(_cell(F.col("min_lon") - radius, c), _cell(F.col("max_lon") + radius, c))).alias("gx"),
        "min_lat", "max_lat")
    e = e.select("edge_id", "bearing", "geom", "gx", F.explode(F.sequence(
        _cell(F.col("min_lat") - radius, c), _cell(F.col("max_lat") + radius, c))).alias("gy"))
    j = _join_cells(s, e)
    d = geo.point_line_distance("longitude", "latitude", "geom")
    return (j.select("sensor_id", "edge_id", "bearing", *keep, d.alias("dist"))
            .where(F.col("dist") < F.lit(radius)))


def direction_ok(direction: Column, bearing: Column) -> Column:
    """North/East need bearing > 0, South/West bearing < 0, others pass."""
    return (F.when(direction.isin("North", "East"), bearing > 0)
            .when(direction.isin("South", "West"), bearing < 0).otherwise(F.lit(True)))


def nearest(cands: DataFrame, key: str = "sensor_id", other: str = "edge_id") -> DataFrame:
    """Nearest partner per key, ties → smallest partner id (an aggregate, skew-safe)."""
    best = cands.groupBy(key).agg(F.min(F.struct(F.col("dist"), F.col(other))).alias("_b"))
    return best.select(key, F.col(f"_b.{other}").alias(other), F.col("_b.dist").alias("dist"))


def map_sensors(sensors: DataFrame, edges: DataFrame, radius: float = MAP_RADIUS_DEG,
                cand: DataFrame | None = None) -> dict[str, DataFrame]:
    """J4–J8 + P20: mapping, unmapped sensors, sensor status, covered/uncovered edges
    (``cand`` may be a precomputed/stored ``candidates`` table)."""
    cand = cand if cand is not None else candidates(sensors, edges, radius)
    ok = cand.where(direction_ok(F.col("direction"), F.col("bearing")))
    mapping = nearest(ok)
    unmapped = sensors.select("sensor_id").join(cand.select("sensor_id"), "sensor_id", "left_anti")
    status = (sensors.select("sensor_id")
              .join(mapping.select("sensor_id", F.lit(1).alias("_m")), "sensor_id", "left")
              .join(unmapped.select("sensor_id", F.lit(1).alias("_u")), "sensor_id", "left")
              .select("sensor_id", F.when(F.col("_m").isNotNull(), "mapped")
                      .when(F.col("_u").isNotNull(), "unmapped").otherwise("unknown").alias("status")))
    covered = mapping.select("edge_id").distinct()
    uncovered = edges.select("edge_id").join(covered, "edge_id", "left_anti")
    return {"candidates": cand, "mapping": mapping, "unmapped": unmapped, "status": status,
            "covered": covered, "uncovered": uncovered}


def edge_sensors(mapping: DataFrame) -> DataFrame:
    """The sensors of every edge in order, in long form ``(edge_id, ordinal, sensor_id)``.

    All rows are numbered in (edge, sensor) order and an edge's numbers start at its
    first row's, so an edge with a third of all sensors is no group of one task."""
    rows = numbered(mapping.select("edge_id", "sensor_id"), ["edge_id", "sensor_id"])
    first = rows.groupBy("edge_id").agg(F.min("position").alias("_first"))
    return rows.join(first, "edge_id").select("edge_id", (F.col("position") - F.col("_first") + 1).alias("ordinal"), "sensor_id")


def top_k(df: DataFrame, key: str, order: list[Column], k: int, salt_col: str,
          buckets: int = 16) -> DataFrame:
    """Exact top-k per key in two stages: top-k per (key, salt), then per key."""
    salt = F.pmod(F.xxhash64(F.col(salt_col)), F.lit(buckets))
    w1 = Window.partitionBy(key, "_salt").orderBy(*order)
    stage1 = (df.withColumn("_salt", salt).withColumn("_r", F.row_number().over(w1))
              .where(F.col("_r") <= k).drop("_r", "_salt"))
    w2 = Window.partitionBy(key).orderBy(*order)
    return stage1.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k)


def knn_idw(sensors: DataFrame, targets: DataFrame, k: int = IDW_K,
            radius: float = IDW_RADIUS_DEG, power: int = 2) -> DataFrame:
    """J9 + J10: up to k sensors within ``radius`` of each target centroid and
    their weights 1 / d^``power`` (2: inverse distance squared; 1: C2 ``linear``). A coincident sensor (d = 0) takes
    all the weight (shared if several), settled before ranking.

    ``targets(edge_id, cx, cy)``; output ``(edge_id, sensor_id, rank, dist, weight)``.
    """
    s = sensors.select("sensor_id", "latitude", "longitude",
                       _cell(F.col("longitude"), radius).alias("gx"),
                       _cell(F.col("latitude"), radius).alias("gy"))
    off = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    t = targets.select("edge_id", "cx", "cy", F.explode(off).alias("ox")) \
        .select("edge_id", "cx", "cy", "ox", F.explode(off).alias("oy")) \
        .select("edge_id", "cx", "cy", (_cell(F.col("cx"), radius) + F.col("ox")).alias("gx"),
                (_cell(F.col("cy"), radius) + F.col("oy")).alias("gy"))
    j = _join_cells(s, t)
    d = geo.point_distance("longitude", "latitude", "cx", "cy")
    c = j.select("edge_id", "sensor_id", d.alias("dist")).where(F.col("dist") < F.lit(radius))
    ranked = top_k(c, "edge_id", [F.col("dist"), F.col("sensor_id")], k, "sensor_id")
    # ≤ k rows per edge and already partitioned by edge: window sums, no join back
    per_edge = Window.partitionBy("edge_id")
    weight = F.lit(1.0) / (F.col("dist") if power == 1 else F.pow("dist", F.lit(float(power))) if power != 2 else F.col("dist") * F.col("dist"))
    inv = F.sum(F.when(F.col("dist") > 0, weight)).over(per_edge)
    zero = F.sum(F.when(F.col("dist") == 0, F.lit(1)).otherwise(F.lit(0))).over(per_edge)
    out = ranked.withColumn("_inv", inv).withColumn("_zero", zero).withColumn(
        "weight",
        F.when(F.col("_zero") > 0, F.when(F.col("dist") == 0, F.lit(1.0) / F.col("_zero")).otherwise(F.lit(0.0)))
        .otherwise(weight / F.col("_inv")))
    return out.select("edge_id", "sensor_id", "rank", "dist", "weight")


def interpolation_summary(weights: DataFrame) -> DataFrame:
    """Per interpolated edge, sensor count and mean distance in km."""
    return weights.groupBy("edge_id").agg(F.count("*").alias("n_sensors"),
                                          (F.avg("dist") * F.lit(KM_PER_DEG)).alias("avg_distance_km"))


SET_EDGES = 4096      # edges of one sensor set that one task joins


def idw_speed(weights: DataFrame, sensor_speeds: DataFrame, limit: int = SET_EDGES) -> DataFrame:
    """Edge speed = Σ w·v / Σ w over the sensors that reported at that instant.

    Neighbouring edges have the same sensors, so readings are gathered by sensor set and
    instant, once for all edges of the set, and no row per edge and instant is shuffled:
    those come out of the last join. A set of more than ``limit`` edges is dealt over
    several parts, each with the set's readings."""
    n = int(weights.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = F.sort_array(F.collect_list(F.struct("sensor_id", "weight")))  # at most k an edge
    edges = weights.where("sensor_id IS NOT NULL").groupBy("edge_id").agg(own.alias("_own"))
    edges = materialize(edges.select("edge_id", F.col("_own.sensor_id").alias("_set"), F.col("_own.weight").alias("_w")), "idw-sets")
    sets = edges.groupBy("_set").agg(F.ceil(F.count("*") / limit).cast("int").alias("_parts"))
    crowded = sets.where("_parts > 1")
    edges = edges.join(crowded, "_set", "left").withColumn(
        "_part", F.pmod(F.xxhash64("edge_id"), F.coalesce("_parts", F.lit(1))).cast("int")).drop("_parts").repartition(n, "_set", "_part")
    seats = sets.select("_set", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"))
    seats = seats.select("_set", "_part", F.posexplode("_set").alias("pos", "sensor_id"))
    seen = seats.join(sensor_speeds.select("sensor_id", "timestamp", "speed"), "sensor_id").repartition(n, "_set", "_part")
    seen = seen.groupBy("_set", "_part", "timestamp").agg(F.collect_list(F.struct("pos", "speed")).alias("_seen"))

    def total(value):  # as F.sum adds: without nulls, null of nothing
        def add(have, s):
            return F.coalesce(have + value(s), have, value(s))
        return F.aggregate("_seen", F.lit(None).cast("double"), add)

    def weight(s):
        return F.get("_w", s["pos"])

    return seen.join(edges, ["_set", "_part"]).select(
        "edge_id", "timestamp", (total(lambda s: weight(s) * s["speed"]) / total(weight)).alias("speed"), F.size("_seen").cast("long").alias("n_sensors"))


PYRAMID_STEP = 8      # a cell of one level has 8 x 8 cells of the next
PYRAMID_CELL = 16     # edges of a finest cell on average, if these lie evenly
PYRAMID_SMALL = 40_000  # cells of a level that is sent to all executors
BOX = ("min_lon", "min_lat", "max_lon", "max_lat")


def _pyramid(edges: DataFrame, size: float) -> tuple[list[DataFrame], DataFrame, float]:
    """Occupied cells per level, finest first: (gx, gy) and the box around the cell's
    edges; the edges by finest cell; and this cell's width, ``size`` or less. An edge
    belongs to the one cell that holds the middle of its box, so narrow cells copy
    none; a box may stick out of its cell. The top level has a few cells."""
    e = edge_geometry(edges).where("min_lon IS NOT NULL AND min_lat IS NOT NULL")
    e = materialize(e.select("edge_id", "geom", *BOX), "edge-boxes")
    mid_x, mid_y = (F.col("min_lon") + F.col("max_lon")) / 2, (F.col("min_lat") + F.col("max_lat")) / 2
    low_x, low_y, high_x, high_y, n = e.agg(F.min("min_lon"), F.min("min_lat"), F.max("max_lon"), F.max("max_lat"), F.count("*")).first()
    if not n:
        return [], e.withColumns({"gx": F.lit(0).cast("long"), "gy": F.lit(0).cast("long")}), size
    span = max(high_x - low_x, high_y - low_y)
    wanted = math.sqrt(max(high_x - low_x, size) * max(high_y - low_y, size) * PYRAMID_CELL / n)
    if wanted < size:
        size = max(wanted, span * 1e-9)
    cells = e.withColumns({"gx": _cell(mid_x, size), "gy": _cell(mid_y, size)})
    box = [F.min("min_lon").alias("min_lon"), F.min("min_lat").alias("min_lat"), F.max("max_lon").alias("max_lon"), F.max("max_lat").alias("max_lat")]
    level = materialize(cells.groupBy("gx", "gy").agg(*box), "pyramid")
    levels = [level]
    while size * PYRAMID_STEP ** (len(levels) - 1) < span:
        up = lambda c: F.floor(F.col(c) / PYRAMID_STEP).cast("long").alias(c)
        level = level.groupBy(up("gx"), up("gy")).agg(*box)
        levels.append(level)
    return levels, cells, size


def nearest_edge_unbounded(sensors: DataFrame, edges: DataFrame, size: float = 4 * MAP_RADIUS_DEG) -> DataFrame:
    """J14 helper: nearest edge per sensor with no radius limit, ``(sensor_id, edge_id,
    dist)``; a sensor without a position, or without any edge to map to, has NULLs.

    A pyramid of occupied cells is searched from the top: at each level a sensor keeps
    the cells that can hold a nearer edge than the nearest that some cell is sure to
    hold, and goes on to their occupied sub-cells. Of the edges of the finest cells left,
    those are measured whose own box can be the nearest. Every step is an equi-join on
    the cell; the sensors of a crowded cell are dealt over several tasks."""
    levels, by_cell, _ = _pyramid(edges, size)
    todo = sensors.where("latitude IS NOT NULL AND longitude IS NOT NULL").select("sensor_id", "latitude", "longitude")
    if levels:
        cell = ("gx", "gy", *BOX)
        top = levels[-1].collect()  # at most 2 x 2 cells, or 3 x 3 by rounding
        cells = F.array(*[F.struct(*[F.lit(r[c]).alias(c) for c in cell]) for r in top])
        n = int(sensors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        found = _can_be_nearest(todo.repartition(n, "sensor_id").select("*", F.inline(cells)))
        for depth in range(len(levels) - 2, -1, -1):
            below = levels[depth].select(*cell, F.floor(F.col("gx") / PYRAMID_STEP).cast("long").alias("ux"),
                                         F.floor(F.col("gy") / PYRAMID_STEP).cast("long").alias("uy"))
            if len(top) * PYRAMID_STEP ** (2 * (len(levels) - 1 - depth)) <= PYRAMID_SMALL:
                below = F.broadcast(below)
            found = found.select("sensor_id", "latitude", "longitude", F.col("gx").alias("ux"), F.col("gy").alias("uy")).join(below, ["ux", "uy"])
            found = _can_be_nearest(found)
        found = materialize(found.select("sensor_id", "latitude", "longitude", "_reach", "gx", "gy"), "nearest-cells")
        # both are small in bytes and read as a few tasks' work, whichever side is broadcast
        found = _can_be_nearest(_join_cells(found.repartition(n, "sensor_id", "gx", "gy"), by_cell.repartition(n, "edge_id")))
        best = nearest(found.select("sensor_id", "edge_id", geo.point_line_distance("longitude", "latitude", "geom").alias("dist")))
    else:
        best = by_cell.select(F.lit(None).cast(sensors.schema["sensor_id"].dataType).alias("sensor_id"), "edge_id", F.lit(0.0).alias("dist"))
    return sensors.select("sensor_id").join(best, "sensor_id", "left")


def _can_be_nearest(found: DataFrame) -> DataFrame:
    """Rows (sensor, box) whose box is no farther than ``_reach``, the sensor's nearest
    distance within which some edge is sure to lie; a given ``_reach`` is used as it is.

    An edge touches each side of the box around it or its cell's edges, so one lies no
    farther than the far end of the side that is nearer in one direction."""
    x, y = F.col("longitude"), F.col("latitude")
    gap_x, gap_y = (F.greatest(F.col(low) - at, at - F.col(high), F.lit(0.0)) for at, low, high in ((x, "min_lon", "max_lon"), (y, "min_lat", "max_lat")))
    near_x, far_x, near_y, far_y = (f(F.abs(at - F.col(low)), F.abs(at - F.col(high))) for at, low, high in ((x, "min_lon", "max_lon"), (y, "min_lat", "max_lat"))
                                    for f in (F.least, F.greatest))
    if "_reach" not in found.columns:
        sure = F.least(F.hypot(near_x, far_y), F.hypot(far_x, near_y))
        found = found.withColumn("_reach", F.min(sure).over(Window.partitionBy("sensor_id")))
    return found.where(F.hypot(gap_x, gap_y) <= F.col("_reach") * F.lit(1 + 1e-9) + F.lit(1e-9))


def split_candidates(sensors: DataFrame, edges: DataFrame) -> DataFrame:
    """Nearest edge of each sensor whose length exceeds 0.001°."""
    near = nearest_edge_unbounded(sensors, edges).where("edge_id IS NOT NULL")
    lens = edges.select("edge_id", geo.line_length("geom").alias("length"))
    return near.join(lens, "edge_id").where(F.col("length") > F.lit(SPLIT_MIN_LENGTH_DEG))


def qa_errors(sensors: DataFrame, parts: dict[str, DataFrame], interp: DataFrame,
              max_km: float = QA_MAX_INTERP_KM) -> DataFrame:
    """Rule violations as ``(rule, key, message)`` rows."""
    r1 = (parts["status"].where(F.col("status") == "unknown")
          .select(F.lit(1).alias("rule"), F.col("sensor_id").cast("string").alias("key"),
                  F.concat(F.lit("Sensor "), F.col("sensor_id").cast("string"),
                           F.lit(" has no mapping")).alias("message")))
    r3 = (interp.where(F.col("avg_distance_km") > F.lit(max_km))
          .select(F.lit(3).alias("rule"), F.col("edge_id").cast("string").alias("key"),
                  F.concat(F.lit("Edge "), F.col("edge_id").cast("string"),
                           F.lit(" has interpolation distance > 3km")).alias("message")))
    return r1.unionByName(r3)


def qa_report(errors: DataFrame, n: int = QA_MAX_ERRORS) -> DataFrame:
    """One row ``(validation_passed, validation_errors, errors)`` with the first n messages."""
    total = errors.agg(F.count("*").alias("validation_errors"))
    first = first_errors(errors, n).agg(F.array_sort(F.collect_list(F.struct("rule", "key", "message"))).alias("_f"))  # n rows
    return total.join(first).select((F.col("validation_errors") == 0).alias("validation_passed"), "validation_errors",
                                    F.transform("_f", lambda e: e["message"]).alias("errors"))


def first_errors(errors: DataFrame, n: int = QA_MAX_ERRORS) -> DataFrame:
    """J15 report: the first n errors (the report keeps ten)."""
    return errors.orderBy("rule", "key").limit(n)


def mapping_stats(sensors: DataFrame, edges: DataFrame, parts: dict[str, DataFrame],
                  interp: DataFrame, errors: DataFrame, run_at: str | None = None) -> DataFrame:
    """Coverage statistics, one row (averages default to 0 when empty), with the
    instant of the run (a parameter, as text yyyyMMdd_HHmmss; NULL if not given)."""
    # one union of per-sensor, per-edge and per-error fact rows, one aggregate
    null_s, null_d = F.lit(None).cast("string"), F.lit(None).cast("double")
    sensor_rows = parts["status"].select(F.lit("s").alias("kind"), F.col("status"),
                                         F.lit(False).alias("covered"), F.lit(False).alias("interp"),
                                         null_d.alias("km"))
    edge_rows = (edges.select("edge_id")
                 .join(parts["covered"].select("edge_id", F.lit(True).alias("_c")), "edge_id", "left")
                 .join(interp.select("edge_id", F.lit(True).alias("_i"), "avg_distance_km"), "edge_id", "left")
                 .select(F.lit("e").alias("kind"), null_s.alias("status"),
                         F.coalesce("_c", F.lit(False)).alias("covered"),
                         F.coalesce("_i", F.lit(False)).alias("interp"), F.col("avg_distance_km").alias("km")))
    error_rows = errors.select(F.lit("x").alias("kind"), null_s.alias("status"), F.lit(False).alias("covered"),
                               F.lit(False).alias("interp"), null_d.alias("km"))
    k = F.col("kind")
    one = sensor_rows.unionByName(edge_rows).unionByName(error_rows).agg(
        F.count_if(k == "s").alias("total_sensors"),
        F.count_if((k == "s") & (F.col("status") == "mapped")).alias("mapped_sensors"),
        F.count_if((k == "s") & (F.col("status") == "unmapped")).alias("unmapped_sensors"),
        F.count_if(k == "e").alias("total_edges"),
        F.count_if((k == "e") & F.col("covered")).alias("edges_with_sensors"),
        F.count_if((k == "e") & F.col("interp")).alias("edges_with_interpolation"),
        F.coalesce(F.avg(F.when(k == "e", F.col("km"))), F.lit(0.0)).alias("avg_interpolation_distance_km"),
        F.count_if(k == "x").alias("validation_errors"))
    return one.select(
        "total_sensors", "mapped_sensors", "unmapped_sensors",
        (F.col("mapped_sensors") / F.col("total_sensors") * 100).alias("coverage_percent"),
        "total_edges", "edges_with_sensors", "edges_with_interpolation",
        ((F.col("edges_with_sensors") + F.col("edges_with_interpolation")) / F.col("total_edges") * 100)
        .alias("edge_coverage_percent"),
        "avg_interpolation_distance_km", "validation_errors",
        F.date_format(F.lit(run_at).cast("timestamp"), "yyyyMMdd_HHmmss").alias("timestamp"))


def mapping_detail(mapping: DataFrame, sensors: DataFrame) -> DataFrame:
    """Mapping rows with the sensor's position, highway and direction."""
    return mapping.join(sensors, "sensor_id").select(
        "sensor_id", "edge_id", F.col("latitude").alias("sensor_lat"),
        F.col("longitude").alias("sensor_lon"), "highway", "direction")


def geo_knn_adjacency(sensors: DataFrame, k: int = 10, max_km: float = 2.0) -> DataFrame:
    """K-NN sensor graph within ``max_km`` → edge list ``(src, dst, dist_km)``."""
    radius = max_km / KM_PER_DEG
    t = sensors.select(F.col("sensor_id").alias("edge_id"), F.col("longitude").alias("cx"),
                       F.col("latitude").alias("cy"))
    nn = knn_idw(sensors, t, k + 1, radius).where(F.col("edge_id") != F.col("sensor_id"))
    return nn.select(F.col("edge_id").alias("src"), F.col("sensor_id").alias("dst"),
                     (F.col("dist") * F.lit(KM_PER_DEG)).alias("dist_km"))
