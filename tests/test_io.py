"""Reader/writer round trips."""

import datetime as dt
import os
import tempfile

import pytest

from velograph.operators import features
from velograph.sources import io

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="vg-io-")


def _tall(spark, n=48):
    rows = [(T0 + dt.timedelta(hours=i), f"s{i % 3}", float(i)) for i in range(n)]
    return spark.createDataFrame(rows, "timestamp timestamp, edge_id string, speed double")


def test_read_table_by_suffix(spark, tmp):
    df = _tall(spark)
    df.write.parquet(f"{tmp}/a.parquet")
    df.write.option("header", True).csv(f"{tmp}/b.csv")
    assert io.read_table(spark, f"{tmp}/a.parquet").count() == 48
    assert io.read_table(spark, f"{tmp}/b.csv").count() == 48
    with pytest.raises(ValueError):
        io.read_table(spark, f"{tmp}/c.txt")


def test_read_dir_mixed(spark, tmp):
    df = _tall(spark)
    df.limit(10).write.parquet(f"{tmp}/x/p1")
    df.limit(5).write.option("header", True).csv(f"{tmp}/x/deep/c1")
    out = io.normalize_readings(io.read_dir(spark, f"{tmp}/x"))
    assert out.count() == 15
    with pytest.raises(FileNotFoundError):
        io.read_dir(spark, f"{tmp}/missing")


def test_normalize_tall_and_wide(spark):
    tall = spark.createDataFrame([(T0, "a", "1.5", "2024-01-01", 0)],
                                 "ts timestamp, Edge_ID string, SPEED string, date string, hour int")
    t = io.normalize_readings(tall).collect()
    assert [(r.edge_id, r.speed) for r in t] == [("a", 1.5)]
    wide = spark.createDataFrame([(T0, "abc", "2.0")], "timestamp timestamp, s0 string, s1 string")
    w = {r.edge_id: r.speed for r in io.normalize_readings(wide).collect()}
    assert w == {"s0": None, "s1": 2.0}
    with pytest.raises(ValueError):
        io.normalize_readings(spark.createDataFrame([(1,)], "x int"))


def test_matrix_orientation(spark):
    m = spark.createDataFrame([(0, [1.0, 2.0, 3.0]), (1, [4.0, 5.0, 6.0])], "row_idx long, values array<double>")
    r = io.matrix_to_readings(m, 5).collect()   # 2 rows < 3 cols → N×T, transposed
    got = {(x.edge_id, x.timestamp): x.speed for x in r}
    assert got[("s1", dt.datetime(2017, 1, 1, 0, 5))] == 5.0 and len(got) == 6


def test_partitioned_roundtrip_and_view(spark, tmp):
    df = _tall(spark)
    io.write_partitioned(df, f"{tmp}/p", by_hour=True)
    assert {"date=2024-01-01", "date=2024-01-02"} <= set(os.listdir(f"{tmp}/p"))
    back = io.read_partitioned(spark, f"{tmp}/p", view="speeds")
    assert spark.sql("SELECT count(*) FROM speeds WHERE date = '2024-01-02'").collect()[0][0] == 24
    assert back.where("hour = 3").count() == 2


def test_sidecar_roundtrip(spark, tmp):
    st = features.sensor_stats(_tall(spark))
    io.write_sidecar(st, f"{tmp}/meta", 60)
    back = {r.edge_id: (r.mu, r.sigma, r.freq_minutes) for r in io.read_sidecar(spark, f"{tmp}/meta").collect()}
    want = {r.edge_id: (r.mu, r.sigma, 60) for r in st.collect()}
    assert back == want


def test_windows_and_edge_list_and_reports(spark, tmp):
    w = spark.createDataFrame([(T0, "a", [1.0], [2.0])], "label_start timestamp, edge_id string, x array<double>, y array<double>")
    path = io.write_windows(w, tmp, 60, 720, 12)
    assert path.endswith("heldout_day_t12_o720")
    r = spark.read.parquet(path).collect()[0]
    assert (r.freq_minutes, r.horizon_minutes, r.t_in) == (60, 720, 12)
    with open(f"{tmp}/edges.csv", "w") as f:
        f.write("src,dst,w\n0,1,2.5\n1,0,\n")
    e = {(x.src, x.dst): x.w for x in io.read_edge_list(spark, f"{tmp}/edges.csv").collect()}
    assert e == {(0, 1): 2.5, (1, 0): 1.0}
    io.write_report(w.select("edge_id"), f"{tmp}/rep_csv", "csv")
    io.write_report(w.select("edge_id"), f"{tmp}/rep_json", "json")
    assert spark.read.option("header", True).csv(f"{tmp}/rep_csv").count() == 1
    assert spark.read.json(f"{tmp}/rep_json").count() == 1


def test_to_wide_takes_the_named_sensors(spark):
    wide = io.to_wide(_tall(spark), ["s0", "s1", "s2"])
    assert wide.count() == 48 and set(wide.columns) == {"timestamp", "s0", "s1", "s2"}


def test_read_dir_reads_all_kinds_and_raises_on_a_bad_file(spark, tmp):
    df = _tall(spark)
    df.where("edge_id = 's0'").write.parquet(f"{tmp}/d/a")
    df.where("edge_id <> 's0'").write.option("header", True).csv(f"{tmp}/d/b")
    assert io.normalize_readings(io.read_dir(spark, f"{tmp}/d")).count() == df.count()
    with open(f"{tmp}/d/a/broken.parquet", "wb") as f:
        f.write(b"PAR1 not a file PAR1")
    with pytest.raises(Exception, match="(?i)parquet|footer|magic|corrupt|cannot read"):
        io.read_dir(spark, f"{tmp}/d").count()
    with pytest.raises(FileNotFoundError):
        io.read_dir(spark, f"{tmp}/nothing-here")


def _put(root, name, text):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def _cells(df):
    return {(r.edge_id, r.timestamp.hour): r.speed for r in io.normalize_readings(df).collect() if r.speed is not None}


def test_read_dir_matches_csv_columns_by_name(spark, tmp):
    """Columns in another order, other sensors, quoted names, a byte order mark, empty and
    header-only files, upper-case suffixes and odd file names."""
    _put(tmp, "one.csv", "timestamp,s1,s2\n2024-01-01 00:00:00,1,2\n")
    _put(tmp, "two.csv", "timestamp,s2,s1\n2024-01-01 01:00:00,20,10\n")
    _put(tmp, "deep/B.CSV", "﻿timestamp,s3\r\n2024-01-01 02:00:00,7\r\n")
    _put(tmp, "deep/quoted.csv", '"timestamp","s1"\n2024-01-01 03:00:00,"5"\n')
    _put(tmp, "deep/x y é,{1}[2].csv", "\n\nTimestamp,s1\n2024-01-01 04:00:00,9\n")
    _put(tmp, "empty.csv", "")
    _put(tmp, "blank.csv", "\n\n")
    _put(tmp, "only.csv", "timestamp,s9\n")
    _put(tmp, "notes.txt", "timestamp,s1\n2024-01-01 05:00:00,1\n")
    _put(tmp, "_hidden.csv", "timestamp,s1\n2024-01-01 06:00:00,1\n")
    got = io.read_dir(spark, tmp)
    assert sorted(got.columns) == ["s1", "s2", "s3", "s9", "timestamp"]
    assert _cells(got) == {("s1", 0): 1.0, ("s2", 0): 2.0, ("s2", 1): 20.0, ("s1", 1): 10.0, ("s3", 2): 7.0, ("s1", 3): 5.0, ("s1", 4): 9.0}


def test_read_dir_without_any_column(spark, tmp):
    _put(tmp, "empty.csv", "")
    with pytest.raises(FileNotFoundError):
        io.read_dir(spark, tmp)


def test_read_dir_merges_parquet_columns(spark, tmp):
    spark.createDataFrame([(1, 2)], "a int, b int").coalesce(1).write.parquet(f"{tmp}/p/1")
    spark.createDataFrame([(3, 3.5)], "a int, c double").coalesce(1).write.parquet(f"{tmp}/p/2")
    assert {(r.a, r.b, r.c) for r in io.read_dir(spark, tmp).collect()} == {(1, 2, None), (3, None, 3.5)}
    # types that clash: numbers widen
    spark.createDataFrame([(1 << 40, 2.5)], "a long, b double").coalesce(1).write.parquet(f"{tmp}/p/3")
    assert {(r.a, r.b, r.c) for r in io.read_dir(spark, tmp).collect()} == {(1, 2.0, None), (3, None, 3.5), (1 << 40, 2.5, None)}
    # text in one file and numbers in another: text, which the lenient parse takes
    _put(tmp, "z.CSV", "A,b\nx,1.25\n")
    assert {(r.a, r.b) for r in io.read_dir(spark, tmp).collect()} == {("1", "2"), ("3", None), (str(1 << 40), "2.5"), ("x", "1.25")}


def test_hot_day_is_several_files(spark, tmp):
    """AQE splits the tasks of a day that is much larger than the others; conf is restored."""
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    n = 60_000
    rows = spark.range(n).selectExpr("timestamp_seconds(1704067200 + CASE WHEN id % 3 > 0 THEN id % 86400 ELSE (id % 20) * 86400 END) AS timestamp",
                                     "concat('s', id % 50) AS edge_id", "rand(7) * 80 AS speed")
    io.write_partitioned(rows, f"{tmp}/h", file_bytes=150_000)
    files = {d: sum(f.endswith(".parquet") for f in os.listdir(f"{tmp}/h/{d}")) for d in os.listdir(f"{tmp}/h") if d.startswith("date=")}
    assert len(files) == 20 and files["date=2024-01-01"] >= 4
    assert sum(k == 1 for k in files.values()) >= 12  # days that share no task with the large one
    assert spark.read.parquet(f"{tmp}/h").count() == n
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before


def test_partition_filter_prunes(spark, tmp):
    io.write_partitioned(_tall(spark), f"{tmp}/p", by_hour=True)
    plan = io.read_partitioned(spark, f"{tmp}/p").where("hour < 6")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hour" in plan and "< 6)" in plan.split("PartitionFilters")[1].split("]")[0]
