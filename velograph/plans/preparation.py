"""E1 batch preparation and E5 draft processor as single Spark plans.

E1: matrix → long readings → congestion weights (on raw speeds) → per-sensor
    z-score → raw / normalised / weights Parquet partitioned by date + sidecar.
E5: calendar features → forward+backward fill on the grid → z-score → ordered
    split → per-split Parquet by date/hour + temp views (incl. hourly averages)
    → graph normalisation and stats → linear congestion weights → summary row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velograph.operators import align, features, graph
from velograph.sources import io


def prepare(readings: DataFrame, out_dir: str, freq_minutes: int = 5) -> dict[str, str]:
    """E1 on canonical readings (e.g. ``io.matrix_to_readings``)."""
    out = out_dir.rstrip("/")
    stats = features.sensor_stats(readings, percentile=True)
    weights = features.congestion_step_weights(readings, stats)          # before normalising
    norm = features.normalize(readings, features.norm_params(stats, "z_score"))
    norm = norm.select("timestamp", "edge_id", F.col("value").alias("speed"))
    io.write_partitioned(readings, f"{out}/speeds_raw")
    io.write_partitioned(norm, f"{out}/speeds_norm")
    io.write_partitioned(weights.select("timestamp", "edge_id", F.col("weight").alias("speed")), f"{out}/weights")
    io.write_sidecar(stats, f"{out}/meta", freq_minutes)
    return {k: f"{out}/{k}" for k in ("speeds_raw", "speeds_norm", "weights", "meta")}


def draft_process(readings: DataFrame, edges: DataFrame, n_nodes: int, out_dir: str,
                  freq_minutes: int = 5) -> DataFrame:
    """E5; writes the splits and returns the one-row dataset summary."""
    spark = readings.sparkSession
    out = out_dir.rstrip("/")
    lo, hi = align.grid_bounds(readings)
    grid = align.fill(align.regular_grid(readings, freq_minutes, bounds=(lo, hi), carry=True), "ffill_bfill")
    params = features.norm_params(features.sensor_stats(grid), "z_score")
    norm = features.normalize(grid.select("edge_id", "timestamp", "speed"), params)
    norm = features.with_calendar(norm.select("timestamp", "edge_id", F.col("value").alias("speed")))
    split = features.ordered_split_grid(norm, lo, hi, freq_minutes)
    counts = {}
    for name in ("train", "val", "test"):
        part = split.where(F.col("split") == name).drop("split", "hour")
        io.write_partitioned(part, f"{out}/{name}", by_hour=True)
        view = io.read_partitioned(spark, f"{out}/{name}", view=name)
        counts[name] = view.agg(F.count("*").alias("n")).select("n").scalar()
    spark.sql("SELECT edge_id, hour, avg(speed) AS avg_speed, count(*) AS sample_count "
              "FROM train GROUP BY edge_id, hour").createOrReplaceTempView("hourly_avg")
    g = graph.with_self_loops(graph.clean_edges(edges, n_nodes), n_nodes)
    graph.row_normalize(g).write.mode("overwrite").parquet(f"{out}/adj_normalized")
    gs = graph.graph_stats(g, n_nodes)
    features.congestion_linear_weights(grid).write.mode("overwrite").parquet(f"{out}/congestion_weights")
    params.write.mode("overwrite").parquet(f"{out}/normalization_params")
    n_sensors = grid.agg(F.countDistinct("edge_id").alias("n")).select("n").scalar()
    return gs.select(n_sensors.alias("num_sensors"), counts["train"].alias("train_samples"),
                     counts["val"].alias("val_samples"), counts["test"].alias("test_samples"),
                     "num_nodes", "num_edges", "avg_degree", "density")
