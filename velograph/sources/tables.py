"""Adapters: derive the sensor-domain tables from the supplied parquet tables.

Each adapter is a projection/aggregate over one of the given tables, so its
work grows with the data. The exact same formulas appear in the DuckDB
oracle SQL (``velograph.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velograph.functions.columns import nan_to_null
from velograph.session import configure

ROAD_CLASSES = ["motorway", "trunk", "primary", "secondary", "tertiary", "residential"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str, grain: str = "hour",
             edge: str = "event_type", between: tuple[int, int] | None = None) -> DataFrame:
    """Tall readings from ``events``.

    ``between`` (epoch micros from, to) limits the raw instants, a filter that reaches
    the scan; with both on the grain it selects the same floored instants.

    ``edge='event_type'`` gives 5 sensors; ``edge='user'`` gives one sensor per
    user (``u<user_id>``). ``grain`` floors the raw instant ('hour', 'minute').
    """
    ev = table(spark, sf_dir, "events")
    if between is not None:
        low, high = (F.timestamp_micros(F.lit(x)).cast(ev.schema["ts"].dataType) for x in between)
        ev = ev.where((F.col("ts") >= low) & (F.col("ts") < high))
    edge_col = (F.col("event_type") if edge == "event_type"
                else F.concat(F.lit("u"), F.col("user_id").cast("string")))
    return ev.select(
        F.date_trunc(grain, F.col("ts").cast("timestamp")).alias("timestamp"),
        edge_col.alias("edge_id"),
        nan_to_null("value").alias("speed"),
    )


def speed_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matrix rows ``(row_idx, values ARRAY<DOUBLE>)`` from ``embeddings``."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").alias("row_idx"),
                      F.col("embedding").cast("array<double>").alias("values"))


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted nation graph: supplier nation → customer nation, w = Σ quantity."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = (li.join(od, li.l_orderkey == od.o_orderkey)
         .join(cu, F.col("o_custkey") == cu.c_custkey)
         .join(su, F.col("l_suppkey") == su.s_suppkey))
    return (j.groupBy(F.col("s_nationkey").alias("src"), F.col("c_nationkey").alias("dst"))
            .agg(F.sum("l_quantity").alias("w")))


def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node table ``(idx, sensor_id)`` from ``nation``."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("idx"), F.col("n_name").alias("sensor_id"))


def sensor_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor ids with their positional index (supplier key)."""
    su = table(spark, sf_dir, "supplier")
    return su.select(F.col("s_suppkey").alias("sensor_id"), F.col("s_suppkey").alias("idx"))


def road_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road edges ``(edge_id, highway, bearing, geom)`` computed from ``customer``.

    Start point on a 0.01° lattice with a small key-dependent offset; the first
    segment runs N/S/E/W by ``k % 4`` with length 0.0005·(1 + k % 9); every third
    edge gets a third point 0.001° NE of the second.
    """
    cu = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    lat0 = (F.lit(37.4) + (k % 61).cast("double") * F.lit(0.01)
            + ((k % 7) - 3).cast("double") * F.lit(0.0004))
    lon0 = (F.lit(-122.2) + ((F.expr("c_custkey div 61")) % 23).cast("double") * F.lit(0.01)
            + ((k % 5) - 2).cast("double") * F.lit(0.0003))
    length = F.lit(0.0005) + (k % 9).cast("double") * F.lit(0.0005)
    d = k % 4
    dlat = F.when(d == 0, length).when(d == 1, -length).otherwise(F.lit(0.0))
    dlon = F.when(d == 2, length).when(d == 3, -length).otherwise(F.lit(0.0))
    p0 = F.struct(lon0.alias("lon"), lat0.alias("lat"))
    p1 = F.struct((lon0 + dlon).alias("lon"), (lat0 + dlat).alias("lat"))
    p2 = F.struct((lon0 + dlon + F.lit(0.001)).alias("lon"), (lat0 + dlat + F.lit(0.001)).alias("lat"))
    geom = F.when(k % 3 == 0, F.array(p0, p1, p2)).otherwise(F.array(p0, p1))
    mag = (F.lit(1) + k % 89).cast("double")
    bearing = F.when((d == 0) | (d == 2), mag).otherwise(-mag)
    highway = F.element_at(F.array(*[F.lit(c) for c in ROAD_CLASSES]),
                           (k % len(ROAD_CLASSES) + 1).cast("int"))
    return cu.select(k.alias("edge_id"), highway.alias("highway"),
                     bearing.alias("bearing"), geom.alias("geom"))
