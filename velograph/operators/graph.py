"""Sensor-graph operators on edge lists (G1–G8). No dense matrices anywhere.

Per-node sums are partial-aggregating ``groupBy`` + join: a hub node with a huge
degree is combined map-side and its edges split by AQE (``off_its_keys``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velograph.session import off_its_keys



def parse_edge_list(df: DataFrame) -> DataFrame:
    """``src, dst[, w]`` with empty / missing ``w`` → 1.0."""
    w = (F.coalesce(F.nullif(F.trim(F.col("w").cast("string")), F.lit("")).try_cast("double"), F.lit(1.0))
         if "w" in df.columns else F.lit(1.0))
    return df.select(F.col("src").cast("int").alias("src"), F.col("dst").cast("int").alias("dst"),
                     w.alias("w"))


def clean_edges(edges: DataFrame, n_nodes: int) -> DataFrame:
    """G1 + G2: keep ids in [0, N); duplicates → max(0, w…); zero weights vanish."""
    return (crop(edges, n_nodes).groupBy("src", "dst").agg(F.greatest(F.lit(0.0), F.max("w")).alias("w"))
            .where(F.col("w") > 0))


def crop(edges: DataFrame, n_nodes: int) -> DataFrame:
    """The subgraph of the first ``n_nodes`` nodes."""
    return edges.where((F.col("src") >= 0) & (F.col("src") < n_nodes) & (F.col("dst") >= 0) & (F.col("dst") < n_nodes))


def identity_graph(spark: SparkSession, n_nodes: int) -> DataFrame:
    """Self-loops only (no graph available)."""
    return spark.range(n_nodes).select(F.col("id").cast("int").alias("src"),
                                       F.col("id").cast("int").alias("dst"), F.lit(1.0).alias("w"))


def with_self_loops(edges: DataFrame, n_nodes: int) -> DataFrame:
    """The diagonal is overwritten with 1.0 for every node."""
    off = edges.where(F.col("src") != F.col("dst")).select("src", "dst", "w")
    return off.unionByName(identity_graph(edges.sparkSession, n_nodes))


def row_normalize(edges: DataFrame) -> DataFrame:
    """Random-walk normalisation ``w / rowsum`` (0 when rowsum ≤ 0)."""
    rs = edges.groupBy("src").agg(F.sum("w").alias("_rs"))
    return (edges.join(off_its_keys(rs), "src")
            .withColumn("w", F.when(F.col("_rs") > 0, F.col("w") / F.col("_rs")).otherwise(F.lit(0.0)))
            .drop("_rs"))


def graph_stats(edges: DataFrame, n_nodes: int) -> DataFrame:
    """Nodes, edges with w > 0, average out-degree (edges / N), density (edges / N²)."""
    e = edges.where(F.col("w") > 0).agg(F.count("*").alias("num_edges"))
    return e.select(F.lit(n_nodes).alias("num_nodes"), "num_edges",
                    (F.col("num_edges") / F.lit(float(n_nodes))).alias("avg_degree"),
                    (F.col("num_edges") / F.lit(float(n_nodes * n_nodes))).alias("density"))


def neighbour_mix(values: DataFrame, edges: DataFrame, w_param: DataFrame | None = None) -> DataFrame:
    """``y[t, m] = Σ_n x[t, n]·(softplus(W[n, m])·mask[n, m] + δ[n, m])``.

    ``values(t, node, x)``, ``edges(src, dst, w)`` define the mask (w > 0, self
    loops included as in the reference), ``w_param(src, dst, W)`` the learnable
    weights (absent → 0, softplus(0) = ln 2).
    """
    mask = edges.where(F.col("w") > 0).select("src", "dst")
    if w_param is not None:
        mask = mask.join(w_param.select("src", "dst", "W"), ["src", "dst"], "left")
    else:
        mask = mask.withColumn("W", F.lit(None).cast("double"))
    soft = F.log1p(F.exp(F.coalesce(F.col("W"), F.lit(0.0))))
    coef = soft + F.when(F.col("src") == F.col("dst"), F.lit(1.0)).otherwise(F.lit(0.0))
    m = mask.select("src", "dst", coef.alias("c"))
    j = values.join(m, values.node == m.src)
    return j.groupBy("t", F.col("dst").alias("node")).agg(F.sum(F.col("x") * F.col("c")).alias("y"))
