"""Steps whose work must grow with the input alone: checked on row counts and plans."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from velograph.functions import geometry as geo
from velograph.operators import align, spatial
from velograph.session import setting


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_far_sensors_measure_few_edges(spark, monkeypatch):
    """Sensors far off one side of a wide field of edges, and some inside it."""
    pick = np.random.default_rng(7)
    edges = []
    for i in range(3000):
        x, y = (i % 60) * 0.01 + int(pick.integers(0, 3)) * 0.0003, (i // 60) * 0.01
        edges.append((i, [(x, y), (x + 0.002 * (i % 4), y + 0.001 * (i % 3))] + ([(x + 0.004, y - 0.001)] if i % 5 == 0 else [])))
    at = [(j, float(y), float(x)) for j, (x, y) in enumerate([(40 + 3 * pick.random(), 0.5 * pick.random()) for _ in range(30)]
                                                             + [(0.6 * pick.random(), 0.5 * pick.random()) for _ in range(30)] + [(-9.0, -9.0), (0.0, 0.0)])]
    e = spark.createDataFrame([(i, [{"lon": x, "lat": y} for x, y in g]) for i, g in edges], "edge_id long, geom array<struct<lon:double,lat:double>>")
    s = spark.createDataFrame(at, "sensor_id long, latitude double, longitude double")
    every = s.crossJoin(e).select("sensor_id", "edge_id", geo.point_line_distance("longitude", "latitude", "geom").alias("dist"))
    want = {r.sensor_id: (r.edge_id, r.dist) for r in spatial.nearest(every).collect()}
    measured, nearest = [], spatial.nearest
    monkeypatch.setattr(spatial, "nearest", lambda c, *a: measured.append(c.count()) or nearest(c, *a))
    got = {r.sensor_id: (r.edge_id, r.dist) for r in spatial.nearest_edge_unbounded(s, e).collect()}
    assert got == want
    assert measured[0] <= 10 * len(at)


def test_edges_of_one_sensor_set_share_its_readings(spark):
    """Sums of the definition; no aggregate by edge and instant, so no shuffle of its rows."""
    pick = np.random.default_rng(3)
    weights = [(i, int(s), float(pick.random() + 0.1)) for i in range(40) for s in ((1, 2, 3) if i < 30 else pick.choice(9, 3, replace=False))]
    weights += [(50, 1, 0.5), (50, 1, 0.25), (51, 77, 1.0), (None, 2, 1.0), (52, None, 1.0)]
    speeds = [(s, t, None if (s + t) % 7 == 0 else float(pick.random())) for s in range(9) for t in range(20) if (s * t) % 3 != 1]
    speeds += [(1, 3, 9.0), (2, None, 4.0), (None, 3, 1.0)]
    w = spark.createDataFrame(weights, "edge_id long, sensor_id long, weight double")
    v = spark.createDataFrame(speeds, "sensor_id long, timestamp long, speed double")
    want = {}
    for e, s, a in weights:
        for s2, t, b in speeds:
            if s is not None and s == s2:
                want.setdefault((e, t), []).append((a, b))
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        for limit in (4096, 7):
            df = spatial.idw_speed(w, v, limit)
            got = {(r.edge_id, r.timestamp): r for r in df.collect()}
            assert got.keys() == want.keys()
            for k, pairs in want.items():
                known = [a * b for a, b in pairs if b is not None]
                assert got[k].n_sensors == len(pairs)
                assert got[k].speed is None if not known else math.isclose(got[k].speed, sum(known) / sum(a for a, _ in pairs))
            assert df.schema["n_sensors"].dataType.typeName() == "long"
            plan = _plan(df).split("== Initial Plan")[0]
            assert plan.index("SortMergeJoin") < plan.index("Aggregate")


@pytest.mark.parametrize("method", ["ffill", "interpolate", "ffill_bfill"])
def test_fill_sorts_no_grid_rows(spark, method):
    """The fill of a grid with carries equals that of one without, and sits above no sort of ticks."""
    pick = np.random.default_rng(5)
    rows = [(f"s{i % 4}", int(t) * 3600, float(pick.random())) for i, t in enumerate(pick.choice(24 * 9, 60, replace=False))] + [("one", 3600 * 50, 2.0), ("s1", 0, 1.0), (None, 7200, 3.0)]
    r = spark.createDataFrame(rows, "edge_id string, t long, speed double").select("edge_id", F.timestamp_seconds("t").alias("timestamp"), "speed")
    carried = align.fill(align.regular_grid(r, 60, carry=True), method)
    plain = align.fill(align.regular_grid(r, 60), method)
    keyed = [{(x.edge_id, x.timestamp): (x.speed, x.n_obs) for x in g.collect()} for g in (carried, plain)]
    known = [k for k in keyed[0] if k[0] is not None]
    assert keyed[0].keys() == keyed[1].keys() and [keyed[0][k] for k in known] == [keyed[1][k] for k in known]
    above = _plan(carried).split("Generate")[0]
    assert "Window" not in above and "Sort" not in above
