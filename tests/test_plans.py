"""Plan-shape checks: pushdown, shuffle reuse, no cartesian or nested-loop joins."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from velograph.operators import align, spatial, windows
from velograph.sources import tables

SF = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_day_range_reaches_the_scan(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(hours=i), f"s{i % 3}", float(i), "x") for i in range(24 * 10)]
    path = tempfile.mkdtemp(prefix="vg-plan-") + "/r"
    spark.createDataFrame(rows, "timestamp timestamp, edge_id string, speed double, junk string").write.parquet(path)
    r = spark.read.parquet(path)
    lo = int(t0.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)
    day = lo + 5 * align.US_PER_DAY
    g = align.regular_grid(r, 60, bounds=(lo, lo + 239 * 3_600_000_000), day_from_us=day, day_to_us=day)
    p = plan(g)
    assert "GreaterThanOrEqual(timestamp,2024-01-06" in p          # day range pushed into the scan
    assert all("junk" not in part.split("\n")[0] for part in p.split("ReadSchema")[1:])  # pruned


def test_readings_never_meet_by_sensor_alone(spark):
    r = tables.readings(spark, SF, edge="user")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        g = align.fill(align.regular_grid(r, 60, carry=True), "interpolate")
        p = plan(g)
        by_sensor = [x for x in p.split("\n") if "Exchange hashpartitioning(edge_id#" in x and ", day#" not in x.split("hashpartitioning(")[1].split(")")[0]]
        assert by_sensor  # the carries: first and last reading of each day
        assert "_obs" not in "".join(by_sensor) and "RangePartitioning" not in p
        w = plan(windows.sliding_windows(g, 60, 12, 12))
        assert "CartesianProduct" not in w and "NestedLoopJoin" not in w
        # ticks that a sensor misses are aggregated, not a window over all sensors of a tick
        assert "windowspecdefinition(timestamp" not in w
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_heldout_range_reaches_the_scan_of_events(spark):
    from velograph.plans import catalog
    p = plan(catalog.QUERIES["e2_heldout_eval"](spark, SF))
    pushed = [x for x in p.split("PushedFilters: ")[1:] if "GreaterThanOrEqual(ts," in x.split("]")[0] and "LessThan(ts," in x.split("]")[0]]
    assert pushed


def test_statistics_without_percentile_do_not_sort_or_write(spark):
    from velograph.plans import catalog
    p = plan(catalog.QUERIES["p02_zscore"](spark, SF))
    assert "rangepartitioning" not in p and "percentile-ranks" not in p


def test_checkpoint_folder_is_required_on_a_cluster(spark):
    import pytest

    from velograph import session

    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getConf():
            return {}

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(ValueError, match="shared folder"):
        session.checkpoint_dir(Session)


def test_dense_cell_is_split_and_exact(spark):
    s = spark.range(300).select(F.col("id").alias("sensor_id"), (F.lit(37.4) + F.col("id") * 1e-7).alias("latitude"),
                                (F.lit(-122.0) + F.col("id") * 1e-7).alias("longitude"))
    o = s.select(F.col("sensor_id").alias("edge_id"), F.lit(1).alias("gx"), F.lit(1).alias("gy"))
    cells = s.withColumn("gx", F.lit(1)).withColumn("gy", F.lit(1))
    one, many = spatial._join_cells(cells, o, limit=10_000), spatial._join_cells(cells, o, limit=7)
    assert one.count() == many.count() == 90_000 and many.distinct().count() == 90_000


def test_nearest_edge_has_every_sensor(spark):
    s = spark.createDataFrame([(1, 37.4, -122.2), (2, 80.0, 170.0), (3, None, -122.0), (4, -37.0, 10.0)], "sensor_id long, latitude double, longitude double")
    e = tables.road_edges(spark, SF)
    got = {r.sensor_id: (r.edge_id, r.dist) for r in spatial.nearest_edge_unbounded(s, e).collect()}
    lines = [(r.edge_id, [(p.lon, p.lat) for p in r.geom]) for r in e.collect()]

    def away(x, y, a, b):
        vx, vy = b[0] - a[0], b[1] - a[1]
        t = max(0.0, min(1.0, ((x - a[0]) * vx + (y - a[1]) * vy) / (vx * vx + vy * vy)))
        return ((x - a[0] - t * vx) ** 2 + (y - a[1] - t * vy) ** 2) ** 0.5

    for sid, y, x in [(1, 37.4, -122.2), (2, 80.0, 170.0), (4, -37.0, 10.0)]:
        want = min((min(away(x, y, a, b) for a, b in zip(g, g[1:], strict=False)), i) for i, g in lines)
        assert abs(got[sid][1] - want[0]) < 1e-9
    assert got[3] == (None, None)
    none = spatial.nearest_edge_unbounded(s, e.where("false")).collect()
    assert len(none) == 4 and all(r.edge_id is None for r in none)


def test_every_main_column_has_values(spark):
    from velograph.plans import catalog
    for name, column in {"p03_zscore_unguarded": "z", "p02_zscore": "z", "m02_score_with_callable": "mae", "c09_bias_applied": "bias"}.items():
        df = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
        known, every = df.agg(F.count(column), F.count("*")).first()
        assert known > 0.3 * every, name


def test_spatial_joins_are_equi_joins(spark):
    s = spatial.sensor_table(tables.sensor_index(spark, SF))
    e = tables.road_edges(spark, SF)
    m = spatial.map_sensors(s, e)
    t = spatial.edge_geometry(e).join(m["covered"], "edge_id", "left_anti").select("edge_id", "cx", "cy")
    for df in (m["mapping"], spatial.knn_idw(s, t)):
        p = plan(df)
        assert "CartesianProduct" not in p and "NestedLoopJoin" not in p
    assert "WindowGroupLimit" in plan(spatial.knn_idw(s, t))


def test_no_python_udf_in_core_plans(spark):
    r = tables.readings(spark, SF)
    g = align.fill(align.regular_grid(r, 60, carry=True), "interpolate")
    assert "BatchEvalPython" not in plan(g) and "ArrowEvalPython" not in plan(g)
