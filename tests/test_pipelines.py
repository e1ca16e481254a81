"""E1 / E5 plans end to end on the supplied tables (smallest scale)."""

import tempfile

from pyspark.sql import functions as F

from velograph.plans import preparation
from velograph.sources import io, tables

SF = "/root/testdata/sf0.001"


def test_prepare_from_matrix(spark):
    out = tempfile.mkdtemp(prefix="vg-e1-")
    r = io.matrix_to_readings(tables.speed_matrix(spark, SF), 5)
    paths = preparation.prepare(r, out, 5)
    raw = spark.read.parquet(paths["speeds_raw"])
    norm = spark.read.parquet(paths["speeds_norm"])
    assert raw.count() == r.count() == norm.count()
    z = norm.groupBy("edge_id").agg(F.avg("speed").alias("m")).collect()
    assert all(abs(x.m) < 1e-9 for x in z)                    # z-scored per sensor
    meta = io.read_sidecar(spark, paths["meta"])
    assert meta.count() == 64


def test_draft_processor(spark):
    out = tempfile.mkdtemp(prefix="vg-e5-")
    r = tables.readings(spark, SF)
    summary = preparation.draft_process(r, tables.graph_edges(spark, SF), 25, out, 60).collect()[0]
    total = summary.train_samples + summary.val_samples + summary.test_samples
    assert summary.num_sensors == 5 and total == 5 * 720
    assert summary.train_samples == 5 * int(720 * 0.7)
    assert spark.sql("SELECT count(*) FROM hourly_avg").collect()[0][0] > 0
