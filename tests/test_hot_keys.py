"""Joins on a key that holds a third of all rows, with broadcasts off: AQE must split it."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from velograph.operators import features, forecast, graph, quality
from velograph.session import configure

SMALL = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
         "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k"}


@pytest.fixture()
def readings(spark, tmp_path):
    """60,000 readings, a third of them of one sensor."""
    rows = spark.range(60_000).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).alias("timestamp"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 2000)).alias("edge_id"), (F.rand(3) * 80).alias("speed"))
    rows.write.parquet(f"{tmp_path}/r")
    before = {k: spark.conf.get(k, None) for k in SMALL}
    configure(spark)
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield spark.read.parquet(f"{tmp_path}/r")
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def split(df) -> bool:
    df.collect()
    return "SortMergeJoin(skew=true)" in df._jdf.queryExecution().executedPlan().toString()


def _params(r, method="z_score"):
    return features.norm_params(features.sensor_stats(r), method)


def _windows(r):
    return r.select(F.col("timestamp").alias("label_start"), "edge_id", F.array_repeat("speed", 3).alias("x"), F.array_repeat("speed", 2).alias("y"))


CASES = {
    "normalize": lambda r: features.normalize(r, _params(r)),
    "min_max": lambda r: features.normalize(r, _params(r, "min_max")),
    "denormalize": lambda r: features.denormalize(r.withColumn("value", F.lit(0.5)), _params(r)),
    "step_weights": lambda r: features.congestion_step_weights(r),
    "congestion_factor": lambda r: quality.congestion_factor_weights(r, features.exact_percentile(r, "edge_id", "speed", 0.9, "free_flow")),
    "percentile": lambda r: features.exact_percentile(r, "edge_id", "speed", 0.9),
    "row_normalize": lambda r: graph.row_normalize(r.select(F.col("edge_id").alias("src"), F.col("timestamp").alias("dst"), F.col("speed").alias("w"))),
    "residual": lambda r: forecast.residual_forecast(_windows(r), forecast.fit_residual(_windows(r))),
}


@pytest.mark.parametrize("name", CASES)
def test_hot_sensor_is_split(readings, name):
    assert split(CASES[name](readings))


def test_percentile_equals_numpy(spark):
    pick = np.random.default_rng(2)
    groups = {"few": [3.0], "two": [1.0, 2.0], "ties": [5.0] * 9000, "many": pick.normal(size=30_000).round(2).tolist(),
              "wide": (pick.normal(size=20_000) * 1e6).tolist(), "some": pick.random(700).tolist()}
    rows = spark.createDataFrame([(k, float(x)) for k, v in groups.items() for x in v] + [("null", None), ("few", None)], "edge_id string, speed double")
    for q in (0.9, 0.0, 1.0, 0.5):
        got = {r.edge_id: r.p for r in features.exact_percentile(rows, "edge_id", "speed", q).collect()}
        assert got.keys() == groups.keys()
        assert all(math.isclose(got[k], np.quantile(groups[k], q), rel_tol=1e-12) for k in groups), q


def test_percentile_joins_its_bounds_once(readings):
    plan = features.exact_percentile(readings, "edge_id", "speed", 0.9)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan")[0].count("SortMergeJoin") == 1 and plan.count("FileScan") == 2


def test_sketches_merge_over_days(readings):
    """Percentiles from daily sketches are within the documented rank error; days can be added."""
    first, rest = (features.daily_sketches(readings.where(w)) for w in ("timestamp < '2024-01-20'", "timestamp >= '2024-01-20'"))
    for q in (0.1, 0.5, 0.9):
        got = {r.edge_id: r for r in features.sketch_percentile(first.unionByName(rest), q).collect()}
        values = {}
        for r in readings.where("edge_id IN ('hot', 's1', 's2')").collect():
            values.setdefault(r.edge_id, []).append(r.speed)
        for k, v in values.items():
            v = np.sort(v)
            low, high = np.searchsorted(v, got[k].p, "left") / len(v), np.searchsorted(v, got[k].p, "right") / len(v)
            assert low - 0.01 <= q <= high + 0.01 + 1 / len(v) and got[k].n == len(v)
    assert got["hot"].n_days == readings.select(F.to_date("timestamp")).distinct().count()


def test_profile_does_not_expand(readings):
    df = features.profile(readings)
    row = df.first()
    assert (row.n_rows, row.n_sensors, row.n_instants, row.n_missing) == (60_000, readings.select("edge_id").distinct().count(), 60_000, 0)
    assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()
    empty = features.profile(readings.limit(0)).first()
    assert (empty.n_rows, empty.n_sensors, empty.n_instants, empty.first_ts, empty.n_missing) == (0, 0, 0, None, 0)


def test_affine_scan_equals_a_loop(spark):
    pick = np.random.default_rng(5)
    rows = [(f"k{k}", i, float(pick.random()), float(pick.normal())) for k, n in enumerate((1, 7, 8, 9, 200)) for i in range(n)]
    got = quality.affine_scan(spark.createDataFrame(rows, "k string, i int, scale double, shift double"), ["k"], "i", 3)
    got = {(r.k, r.i): (r.scale, r.shift) for r in got.collect()}
    scale, shift = {}, {}
    for k, i, a, b in rows:
        scale[k], shift[k] = scale.get(k, 1.0) * a, shift.get(k, 0.0) * a + b
        assert math.isclose(got[k, i][0], scale[k], rel_tol=1e-9, abs_tol=1e-300) and math.isclose(got[k, i][1], shift[k], rel_tol=1e-9, abs_tol=1e-12)


def test_bias_over_long_gaps_and_unknown_days(spark):
    """Days far apart (several blocks), days without any label, a sensor without one."""
    pick = np.random.default_rng(1)
    days = [0, 1, 2, 63, 64, 65, 300, 301, 9000]
    rows = []
    for d in days:
        for h in range(3):
            y = None if d in (2, 64) or (d == 0 and h == 0) else float(40 + pick.normal())
            rows.append(("a", d * 86400, d * 86400 + h * 3600, y, 40.0))
            rows.append(("b", d * 86400, d * 86400 + h * 3600, None, 30.0))
    df = spark.createDataFrame(rows, "edge_id string, d long, t long, y double, pred double").select(
        "edge_id", F.timestamp_seconds("d").alias("day"), F.timestamp_seconds("t").alias("timestamp"), "t", "y", "pred")
    got = {(r.edge_id, r.t): r.bias for r in quality.bias_corrected(df).collect()}
    state = None
    for k, _, t, y, pred in rows:
        if k == "a":
            assert math.isclose(got[k, t], 0.0 if state is None else state, rel_tol=1e-9, abs_tol=1e-12), t
            if y is not None:
                state = y - pred if state is None else 0.95 * state + 0.05 * (y - pred)
    assert len(got) == len(rows) and all(b == 0 for (k, _), b in got.items() if k == "b")


def test_model_file_is_loaded_once_a_worker(spark, tmp_path):
    with open(f"{tmp_path}/model.csv", "w") as f:
        f.write("0.5,0.25\n")
    log = f"{tmp_path}/loads"

    def load(path):
        import os
        with open(log, "a") as out:
            out.write(f"{os.getpid()}\n")
        slope = np.loadtxt(path, delimiter=",")
        return lambda x: x[:, -1:] * slope[0] + slope[1] * np.arange(1, 3)

    w = spark.range(4000).select(F.timestamp_seconds("id").alias("label_start"), F.concat(F.lit("s"), F.col("id") % 3).alias("edge_id"),
                                 F.array(F.lit(10.0), F.col("id") % 70 + F.lit(0.0)).alias("x"), F.array(F.lit(1.0)).alias("y")).repartition(16)
    params = spark.createDataFrame([("s0", 20.0, 4.0), ("s1", 30.0, 0.0)], "edge_id string, mu double, sigma double")
    for _ in range(2):
        got = forecast.score_with_artifact(w, f"{tmp_path}/model.csv", load, 2, params).collect()
    assert len(got) == 4000
    for r in got[:300]:
        mu, sd = {"s0": (20.0, 4.0), "s1": (30.0, 1.0), "s2": (0.0, 1.0)}[r.edge_id]
        x = float(int(r.label_start.timestamp()) % 70)
        want = [min(150.0, max(0.0, (0.5 * (x - mu) / sd + 0.25 * i) * sd + mu)) for i in (1, 2)]
        assert np.allclose(r.pred, want)
    with open(log) as f:
        loads = f.read().split()
    assert len(loads) == len(set(loads)) <= 16  # 32 tasks; once in each process
