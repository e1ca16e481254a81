"""Forecasting and scoring on windows.

Scores are computed in long form: one row per (window, sensor, label step),
then two aggregation levels — per window, then per horizon — all with partial
aggregation before each shuffle.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Callable, Sequence

from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velograph.functions.columns import clip, round_to, sigma_guard
from velograph.operators.windows import (EVAL_EMA_ALPHA, HORIZONS_MIN, REPLAY_EMA_ALPHA, ema,
                                         last_value, prefix_steps)
from velograph.session import off_its_keys, scratch_folder

# Fixed values that must equal the reference's.
SMOOTH_L1_BETA = 0.02
STEP_WEIGHT_MAX = 1.3
HUBER_DELTA = 1.0
GLOBAL_STD_EPS = 1e-6


def ema_forecast(windows: DataFrame, alpha: float = EVAL_EMA_ALPHA) -> DataFrame:
    """M1: EMA of the history, repeated over the label span, clipped."""
    return windows.withColumn("pred", clip(ema("x", alpha)))


def last_value_forecast(windows: DataFrame) -> DataFrame:
    """W16 as a forecaster: repeat the last tick, clipped."""
    return windows.withColumn("pred", clip(last_value("x")))


def label_steps(windows: DataFrame) -> DataFrame:
    """Explode labels to ``(label_start, edge_id, step, y[, pred ...])``."""
    keep = [c for c in windows.columns if c not in ("x", "y")]
    return windows.select(*keep, F.posexplode("y").alias("step", "y")).withColumn(
        "step", F.col("step") + 1)


def _with_pred_steps(windows: DataFrame, pred: str | Column = "pred") -> DataFrame:
    """Per (window, sensor, step) rows; ``pred`` is a scalar or an array column."""
    p = F.col(pred) if isinstance(pred, str) else pred
    is_array = windows.select(p).schema.fields[0].dataType.typeName() == "array"
    rows = windows.select("label_start", "edge_id", p.alias("_p"),
                          F.posexplode("y").alias("step", "y"))
    rows = rows.withColumn("step", F.col("step") + 1)
    if is_array:
        rows = rows.withColumn("_p", F.element_at("_p", F.col("step")))
    return rows.withColumnRenamed("_p", "pred")


def horizon_rows(steps: DataFrame, t_out: int, horizons: Sequence[int] = HORIZONS_MIN) -> DataFrame:
    """Attach each label step to every horizon whose prefix covers it."""
    pairs = [(h, prefix_steps(t_out, h)) for h in horizons]
    hz = F.array(*[F.struct(F.lit(h).alias("horizon"), F.lit(s).alias("steps")) for h, s in pairs])
    return (steps.withColumn("_h", F.explode(F.filter(hz, lambda z: F.col("step") <= z["steps"])))
            .withColumn("horizon", F.col("_h.horizon")).withColumn("steps", F.col("_h.steps"))
            .drop("_h"))


def window_metrics(windows: DataFrame, t_out: int, pred: str | Column = "pred",
                   horizons: Sequence[int] = HORIZONS_MIN) -> DataFrame:
    """MAE / RMSE of each window over (steps ≤ prefix) × sensors, per horizon."""
    rows = horizon_rows(_with_pred_steps(windows, pred), t_out, horizons)
    d = F.col("pred") - F.col("y")
    return (rows.groupBy("label_start", "horizon", "steps")
            .agg(F.avg(F.abs(d)).alias("mae"), F.sqrt(F.avg(d * d)).alias("rmse")))


def horizon_report(per_window: DataFrame, prefix: str = "") -> DataFrame:
    """Per horizon, the mean over windows of the per-window MAE and RMSE."""
    return (per_window.groupBy("horizon", "steps")
            .agg(F.avg("mae").alias(f"{prefix}mae"), F.avg("rmse").alias(f"{prefix}rmse"),
                 F.count("*").alias("n_windows")))


def evaluation_report(windows: DataFrame, t_out: int, horizons: Sequence[int] = HORIZONS_MIN,
                      alpha: float = EVAL_EMA_ALPHA, digits: int = 6) -> DataFrame:
    """M5: EMA baseline vs last-value model per horizon, side by side."""
    rows = windows.select("label_start", "edge_id",
                          clip(ema("x", alpha)).alias("pred"), clip(last_value("x")).alias("p_last"),
                          F.posexplode("y").alias("step", "y")).withColumn("step", F.col("step") + 1)
    rows = horizon_rows(rows, t_out, horizons)
    de = F.col("pred") - F.col("y")
    dl = F.col("p_last") - F.col("y")
    per_window = (rows.groupBy("label_start", "horizon", "steps")
                  .agg(F.avg(F.abs(de)).alias("ema_mae"), F.sqrt(F.avg(de * de)).alias("ema_rmse"),
                       F.avg(F.abs(dl)).alias("last_mae"), F.sqrt(F.avg(dl * dl)).alias("last_rmse")))
    return (per_window.groupBy("horizon", "steps")
            .agg(F.count("*").alias("n_windows"),
                 *[round_to(F.avg(c), digits).alias(c)
                   for c in ("ema_mae", "ema_rmse", "last_mae", "last_rmse")]))


def step_node_mae(windows: DataFrame, pred: str | Column = "pred") -> DataFrame:
    """A10: mean absolute error per (label step, sensor) over all windows."""
    rows = _with_pred_steps(windows, pred)
    return rows.groupBy("step", "edge_id").agg(F.avg(F.abs(F.col("pred") - F.col("y"))).alias("mae"))


def in_speed_units(step_node: DataFrame, stats: DataFrame) -> DataFrame:
    """M6: errors of forecasts in z-scores as speeds: ``mae_speed = mae * sigma`` of the
    sensor (a sensor without statistics, or of spread 0, counts as 1)."""
    j = step_node.join(off_its_keys(stats.select("edge_id", "sigma")), "edge_id", "left")
    return j.withColumn("mae_speed", F.col("mae") * sigma_guard("sigma")).drop("sigma")


def top_k_nodes(step_node: DataFrame, step: int, k: int = 20) -> DataFrame:
    """O2: the K sensors with the largest error at one step (a top-k report)."""
    if not 1 <= k:
        raise ValueError("k must be positive")
    return (step_node.where(F.col("step") == step)
            .orderBy(F.col("mae").desc(), F.col("edge_id")).limit(k))


def join_positions(step_node: DataFrame, nodes: DataFrame) -> DataFrame:
    """Error table ⋈ node positions (inner, on node id)."""
    return step_node.join(nodes, step_node.edge_id == nodes.node, "inner").drop("node")


def global_stats(windows: DataFrame) -> DataFrame:
    """A4: mean / population std over every element of X and Y (std 0 → 1)."""
    v = windows.select(F.explode(F.concat("x", "y")).alias("v"))
    s = v.agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))
    return s.withColumn("std", F.when((F.col("std") == 0) | F.col("std").isNull(), F.lit(1.0))
                        .otherwise(F.col("std")))


def zscore_global(c: str | Column, mean: Column, std: Column, eps: float = 0.0) -> Column:
    """P5: ``(x - mean) / std`` with tiny std → 1."""
    c = F.col(c) if isinstance(c, str) else c
    s = F.when(std <= F.lit(eps) if eps > 0 else std == 0, F.lit(1.0)).otherwise(std)
    return (c - mean) / s


def residual_features(windows: DataFrame, reference: str = "ema",
                      alpha: float = REPLAY_EMA_ALPHA) -> DataFrame:
    """M3 inputs: the reference level (EMA or last tick) and the last-minus-reference gap."""
    ref = ema("x", alpha) if reference == "ema" else last_value("x")
    return windows.withColumn("ref", ref).withColumn("gap", last_value("x") - F.col("ref"))


def fit_residual(train_windows: DataFrame, reference: str = "ema",
                 alpha: float = REPLAY_EMA_ALPHA) -> DataFrame:
    """M4: per (sensor, step) linear residual model ``y − ref ≈ a + b·(last − ref)``.

    One partial-aggregating ``groupBy`` over the exploded training labels;
    slope/intercept are NULL with < 2 points → 0.
    """
    rows = label_steps(residual_features(train_windows, reference, alpha))
    res = F.col("y") - F.col("ref")
    return (rows.groupBy("edge_id", "step")
            .agg(F.coalesce(F.regr_slope(res, F.col("gap")), F.lit(0.0)).alias("b"),
                 F.coalesce(F.regr_intercept(res, F.col("gap")), F.lit(0.0)).alias("a"),
                 F.count("*").alias("n")))


def residual_forecast(windows: DataFrame, model: DataFrame, reference: str = "ema",
                      alpha: float = REPLAY_EMA_ALPHA) -> DataFrame:
    """M3: ŷ[step] = ref + a + b·gap, clipped; one row per (window, sensor, step)."""
    rows = label_steps(residual_features(windows, reference, alpha))
    m = off_its_keys(model.select("edge_id", "step", "a", "b"))
    rows = rows.join(m, ["edge_id", "step"], "left")
    yhat = F.col("ref") + F.coalesce("a", F.lit(0.0)) + F.coalesce("b", F.lit(0.0)) * F.col("gap")
    return rows.select("label_start", "edge_id", "step", "y", clip(yhat).alias("pred"))


def step_weights(t_out: int, w_max: float = STEP_WEIGHT_MAX) -> list[float]:
    """``linspace(1, w_max, T_out) / mean`` (all ones when T_out = 1)."""
    if t_out <= 1:
        return [1.0] * max(t_out, 1)
    raw = [1.0 + (w_max - 1.0) * i / (t_out - 1) for i in range(t_out)]
    m = sum(raw) / len(raw)
    return [r / m for r in raw]


def smooth_l1_loss(step_rows: DataFrame, t_out: int, beta: float = SMOOTH_L1_BETA) -> DataFrame:
    """Mean smooth-L1 of step-weighted (pred − y)."""
    sw = F.array(*[F.lit(w) for w in step_weights(t_out)])
    d = F.element_at(sw, F.col("step")) * (F.col("pred") - F.col("y"))
    loss = F.when(F.abs(d) < F.lit(beta), F.lit(0.5) * d * d / F.lit(beta)) \
        .otherwise(F.abs(d) - F.lit(0.5 * beta))
    return step_rows.agg(F.avg(loss).alias("smooth_l1"))


def huber_loss(step_rows: DataFrame, delta: float = HUBER_DELTA) -> DataFrame:
    """C11: mean Huber loss."""
    d = F.col("pred") - F.col("y")
    loss = F.when(F.abs(d) <= F.lit(delta), F.lit(0.5) * d * d) \
        .otherwise(F.lit(delta) * (F.abs(d) - F.lit(0.5 * delta)))
    return step_rows.agg(F.avg(loss).alias("huber"))


def mape_weighted_mae(step_rows: DataFrame, weight: Column) -> DataFrame:
    """MAPE (zero labels skipped) and congestion-weighted MAE."""
    d = F.abs(F.col("pred") - F.col("y"))
    return step_rows.agg(
        F.avg(d / F.when(F.abs(F.col("y")) != 0, F.abs(F.col("y")))).alias("mape"),
        (F.sum(weight * d) / F.sum(weight)).alias("weighted_mae"))


def score_with(windows: DataFrame, predict: Callable, t_in: int, t_out: int,
               mean: float = 0.0, std: float = 1.0) -> DataFrame:
    """M2: batch scoring with a user ``predict(ndarray[B, T_in]) -> ndarray[B, T_out]``.

    Arrow batches of windows go through ``mapInPandas``; the callable sees
    normalised inputs, its output is de-normalised and clipped. The callable is
    captured once per Python worker.
    """
    import numpy as np

    std = 1.0 if abs(std) < GLOBAL_STD_EPS else std

    def run(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            x = np.stack(pdf["x"].to_numpy()).astype("float64")
            yhat = np.asarray(predict((x - mean) / std), dtype="float64") * std + mean
            yhat = np.clip(yhat, 0.0, 150.0)
            out = pdf[["label_start", "edge_id", "y"]].copy()
            out["pred"] = list(yhat.reshape(len(pdf), t_out))
            yield out

    schema = "label_start timestamp, edge_id string, y array<double>, pred array<double>"
    return windows.select("label_start", "edge_id", "x", "y").mapInPandas(run, schema)


def score_with_artifact(windows: DataFrame, artifact: str, load: Callable[[str], Callable], t_out: int,
                        params: DataFrame | None = None) -> DataFrame:
    """M2 with a model file: ``load(path)`` gives ``predict(ndarray[B, T_in]) -> ndarray[B, T_out]``.

    ``artifact`` is a file or folder on any file system Spark reads; every executor
    fetches its files once (``shipped``), and every Python worker loads it once, however
    many batches, tasks and queries it serves; a rewritten artifact is loaded anew. ``params(edge_id, mu, sigma)`` normalise each sensor's
    inputs and turn its forecasts back into speeds (missing: 0 and 1, a spread of 0
    counts as 1); forecasts are clipped. Returns ``(label_start, edge_id, y, pred)``.
    """
    import numpy as np

    token, files = shipped(windows.sparkSession, artifact)
    rows = windows.select("label_start", "edge_id", "x", "y")
    if params is None:
        rows = rows.withColumns({"mu": F.lit(0.0), "sigma": F.lit(1.0)})
    else:
        rows = rows.join(off_its_keys(params.select("edge_id", "mu", "sigma")), "edge_id", "left").withColumns(
            {"mu": F.coalesce("mu", F.lit(0.0)), "sigma": sigma_guard("sigma")})

    def run(batches):
        predict = loaded(token, files, load)
        for pdf in batches:
            if len(pdf) == 0:
                continue
            mu, sigma = (pdf[c].to_numpy(dtype="float64")[:, None] for c in ("mu", "sigma"))
            x = np.stack(pdf["x"].to_numpy()).astype("float64")
            yhat = np.asarray(predict((x - mu) / sigma), dtype="float64").reshape(len(pdf), t_out) * sigma + mu
            out = pdf[["label_start", "edge_id", "y"]].copy()
            out["pred"] = list(np.clip(yhat, 0.0, 150.0))
            yield out

    return rows.mapInPandas(run, "label_start timestamp, edge_id string, y array<double>, pred array<double>")


_SHIPPED: dict[tuple[str, str], list[tuple[str, str]]] = {}
_LOADED: dict[str, Callable] = {}


def shipped(spark: SparkSession, artifact: str) -> tuple[str, list[tuple[str, str]]]:
    """A token of the artifact's present state and its files as ``(path in the artifact,
    name under SparkFiles)``, made known to all executors.

    Spark ships no local folder beyond one process and no two files of one name, so each
    file goes by itself, from a copy of its own name in the shared folder."""
    sc = spark.sparkContext
    jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    source = jvm.org.apache.hadoop.fs.Path(artifact)
    fs = source.getFileSystem(conf)
    root = fs.makeQualified(source).toString().rstrip("/")
    found, walk = [], fs.listFiles(source, True)
    while walk.hasNext():
        status = walk.next()
        inner = status.getPath().toString()[len(root):].strip("/")
        if not any(part.startswith(("_", ".")) for part in inner.split("/")):
            found.append((inner or source.getName(), status))
    found.sort(key=lambda f: f[0])
    state = [(inner, f.getLen(), f.getModificationTime()) for inner, f in found]
    token = hashlib.md5(repr((root, state)).encode()).hexdigest()
    key = (sc.applicationId, token)
    if key not in _SHIPPED:
        stage, files = scratch_folder(spark, "artifact"), []
        for i, (inner, status) in enumerate(found):
            name = f"{token}-{i}"
            copy = jvm.org.apache.hadoop.fs.Path(f"{stage}/{name}")
            shared = copy.getFileSystem(conf)
            jvm.org.apache.hadoop.fs.FileUtil.copy(fs, status.getPath(), shared, copy, False, conf)
            sc.addFile(shared.makeQualified(copy).toString())
            files.append((inner, name))
        _SHIPPED[key] = files
    single = not fs.getFileStatus(source).isDirectory()
    return f"{token}/{source.getName()}" if single else token, _SHIPPED[key]


def loaded(token: str, files: list[tuple[str, str]], load: Callable[[str], Callable]) -> Callable:
    """The shipped model, put together under its own file names and loaded on first use
    in this process."""
    if token not in _LOADED:
        prefix, _, single = token.partition("/")
        folder = tempfile.mkdtemp(prefix=f"{prefix}-", dir=SparkFiles.getRootDirectory())
        for inner, name in files:
            os.makedirs(os.path.dirname(f"{folder}/{inner}"), exist_ok=True)
            os.symlink(os.path.abspath(SparkFiles.get(name)), f"{folder}/{inner}")
        _LOADED[token] = load(f"{folder}/{single}" if single else folder)
    return _LOADED[token]


def jitter(windows: DataFrame, std: float, seed: int = 0) -> DataFrame:
    """``x + N(0, 1) * std`` on every input value. The normal deviate comes from two
    MD5-derived uniforms of (seed, label start, sensor, slot) (Box–Muller), so a rerun or
    another partitioning gives the same noise. ``std`` 0 leaves the windows alone."""
    if std <= 0:
        return windows

    def uniform(part: str, slot: Column) -> Column:
        text = F.concat_ws(":", F.lit(f"{seed}{part}"), F.unix_micros("label_start").cast("string"), F.col("edge_id"), slot.cast("string"))
        return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") + 1) / F.lit(4294967297.0)

    def noisy(v: Column, i: Column) -> Column:
        return v + F.lit(float(std)) * F.sqrt(-2 * F.ln(uniform("a", i))) * F.cos(2 * F.pi() * uniform("b", i))

    return windows.withColumn("x", F.transform("x", noisy))
