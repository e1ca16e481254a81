"""Structured Streaming replay of daily readings into serving state.

* T1  ordered source: ``sources.days`` takes date folders in day order, some days a
      micro-batch; ``replay_source`` is Spark's file source (by modification time).
* T2  wide tick → long rows (``unpivot``; missing values stay as NULL rows).
* T3  latest speed per sensor: streaming aggregate, update mode; and a watermarked
      tumbling average, append mode.
* T4  per-sensor EMA: ``applyInPandasWithState`` (state survives restarts in
      the checkpoint); the recursion is vectorised per micro-batch.
* T5/T6 rolling last-12 history per sensor → EMA forecast → per-horizon rows.
* T7  freshness marker: max instant processed.
* T8  capped tick log: ``foreachBatch`` compaction to the newest 10 000.
* T9  requests against moving state: ``live_lookup`` keeps requests and readings in one
      stateful stream, ``lookup_sink`` reads the newest tables for every micro-batch.

Sinks are ``foreachBatch`` writers into versioned state tables: each batch
writes ``<table>/batch_id=<id>`` from the newest complete version before it (so a
replayed batch gives the same) and readers take the newest complete version.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from velograph.functions.columns import sigma_guard
from velograph.operators.serve import STREAM_LOG_CAP, lookup, validate_requests
from velograph.operators.windows import EVAL_EMA_ALPHA, HORIZONS_MIN, REPLAY_EMA_ALPHA, point_index
from velograph.sources.days import day_stream

LONG_SCHEMA = "edge_id string, timestamp timestamp, speed double"


# --------------------------------------------------------------------------- T1 / T2


def stage_days(readings: DataFrame, path: str, days_per_folder: int = 1) -> list[str]:
    """Write the readings as one Parquet folder per day (or per ``days_per_folder`` days),
    oldest first, rows in time order: the file source, which orders by modification
    time, then replays them in order. The loop is over folders, not rows."""
    days = [r[0] for r in readings.select(F.date_format("timestamp", "yyyy-MM-dd").alias("d"))
            .distinct().orderBy("d").collect()]
    for i in range(0, len(days), days_per_folder):
        part = days[i:i + days_per_folder]
        (readings.where(F.date_format("timestamp", "yyyy-MM-dd").between(part[0], part[-1]))
         .repartitionByRange("timestamp").sortWithinPartitions("timestamp").write.mode("overwrite").parquet(f"{path}/date={part[0]}"))
    return days


def replay_source(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1) -> DataFrame:
    """Daily files as a stream, one file per micro-batch by default."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .option("recursiveFileLookup", True).parquet(path))


def wide_to_long(stream: DataFrame, sensors: list[str]) -> DataFrame:
    """One row per (tick, sensor); NULL readings are kept (the history needs them)."""
    return stream.unpivot(["timestamp"], sensors, "edge_id", "speed")


# --------------------------------------------------------------------------- T3 / T7


def latest_stream(long: DataFrame) -> DataFrame:
    """Latest non-missing speed per sensor (update mode); of several readings at the
    last instant the largest, as in ``serve.latest_state``."""
    r = long.where(F.col("speed").isNotNull() & ~F.isnan("speed"))
    best = r.groupBy("edge_id").agg(F.max(F.struct("timestamp", "speed")).alias("_b"))
    return best.select("edge_id", F.col("_b.speed").alias("speed"), F.col("_b.timestamp").alias("ts"))


def average_stream(long: DataFrame, minutes: int = 5, delay_minutes: int = 10) -> DataFrame:
    """Tumbling average per sensor with a watermark (append mode): a window's row comes
    once readings later than its end plus the delay were seen; later ones are dropped."""
    r = long.where(F.col("speed").isNotNull() & ~F.isnan("speed")).withWatermark("timestamp", f"{delay_minutes} minutes")
    per = r.groupBy("edge_id", F.window("timestamp", f"{minutes} minutes").alias("_w")).agg(F.avg("speed").alias("speed"), F.count("*").alias("n"))
    return per.select("edge_id", F.col("_w.start").alias("timestamp"), "speed", "n")


def freshness_stream(long: DataFrame) -> DataFrame:
    """The last instant processed (complete mode, one row)."""
    return long.agg(F.max("timestamp").alias("last_ts"))


# --------------------------------------------------------------------------- T4


def _ema_fold(e0: float | None, x: np.ndarray, alpha: float) -> float | None:
    """EMA over ``x`` (NaN skipped) starting from ``e0`` (None → seed with first value)."""
    x = x[~np.isnan(x)]
    if x.size == 0:
        return e0
    if e0 is None:
        e0, x = float(x[0]), x[1:]
        if x.size == 0:
            return e0
    b = 1.0 - alpha
    n = x.size
    w = alpha * np.power(b, np.arange(n - 1, -1, -1, dtype="float64"))
    return float(e0 * b ** n + np.dot(w, x))


def _in_order(pdfs) -> tuple[np.ndarray, np.ndarray]:
    """Instants (ns) and speeds (NaN: missing) of one sensor's rows in a micro-batch, in
    time order over all Arrow batches. The source's files per trigger bound their number."""
    parts = [(p["timestamp"].to_numpy(dtype="datetime64[ns]"), p["speed"].to_numpy(dtype="float64", na_value=np.nan)) for p in pdfs]
    times, speeds = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(times, kind="stable")
    return times[order], speeds[order]


def ema_stream(long: DataFrame, alpha: float = REPLAY_EMA_ALPHA) -> DataFrame:
    """T4: per-sensor EMA state ``(ema, ts)``; emits the new EMA of every touched sensor."""
    out_schema = "edge_id string, ema double, ts timestamp"
    state_schema = "ema double, ts timestamp"

    def update(key, pdfs, state):
        ema, last = (state.get if state.exists else (None, None))
        times, speeds = _in_order(pdfs)
        ema = _ema_fold(ema, speeds, alpha)
        newest = pd.Timestamp(times[-1])
        last = newest if last is None or newest > last else last
        if ema is None:
            return
        state.update((ema, last))
        yield pd.DataFrame({"edge_id": [key[0]], "ema": [ema], "ts": [last]})

    return long.select("edge_id", "timestamp", "speed").groupBy("edge_id").applyInPandasWithState(
        update, out_schema, state_schema, "update", GroupStateTimeout.NoTimeout)


# --------------------------------------------------------------------------- T5 / T6 / T9


def filled_history(h: np.ndarray) -> np.ndarray:
    """W9 on windows (rows of a matrix, or one vector): each missing slot takes the nearest
    earlier value, a leading gap stays missing, a window without any value is all zeros."""
    known = ~np.isnan(h)
    source = np.maximum.accumulate(np.where(known, np.arange(h.shape[-1]), -1), axis=-1)
    filled = np.where(source >= 0, np.take_along_axis(h, np.maximum(source, 0), -1), np.nan)
    return np.where(known.any(-1, keepdims=True), filled, 0.0)


def forecasts(histories: np.ndarray, t_out: int, alpha: float, predict: Callable[[np.ndarray], np.ndarray] | None,
              mean: float, std: float) -> np.ndarray:
    """Forecasts (rows, t_out) in speeds from filled histories (rows, t_in): the clipped EMA
    baseline, or ``predict`` on histories normalised by one sensor's mean and spread."""
    if predict is not None:
        return np.asarray(predict((histories - mean) / std), dtype="float64") * std + mean
    n = histories.shape[1]
    weights = alpha * np.power(1.0 - alpha, np.arange(n - 1, -1, -1, dtype="float64"))
    weights[0] = (1.0 - alpha) ** (n - 1)
    return np.repeat(np.clip(histories @ weights, 0.0, 150.0)[:, None], t_out, axis=1)


def with_params(long: DataFrame, stats: DataFrame | tuple[float, float]) -> DataFrame:
    """A stream with each row's normalisation ``mu`` and ``sigma``: a table ``(edge_id, mu,
    sigma)`` (missing: 0 and 1; a spread of 0 counts as 1) or one pair for all sensors."""
    if isinstance(stats, tuple):
        return long.withColumns({"mu": F.lit(float(stats[0])), "sigma": F.lit(float(stats[1] or 1.0))})
    return long.join(stats.select("edge_id", "mu", "sigma"), "edge_id", "left").withColumns(
        {"mu": F.coalesce("mu", F.lit(0.0)), "sigma": sigma_guard("sigma")})


def _params(pdfs: list[pd.DataFrame]) -> tuple[float, float]:
    return float(pdfs[0]["mu"].iloc[0]), float(pdfs[0]["sigma"].iloc[0])


def _known(values) -> list[float | None]:
    return [None if np.isnan(v) else float(v) for v in values]


def _held(values) -> np.ndarray:
    return np.array([np.nan if v is None else v for v in values], dtype="float64")


def forecast_stream(long: DataFrame, freq_minutes: int, t_in: int = 12, t_out: int = 12,
                    alpha: float = EVAL_EMA_ALPHA, horizons=HORIZONS_MIN,
                    predict: Callable[[np.ndarray], np.ndarray] | None = None,
                    stats: DataFrame | tuple[float, float] = (0.0, 1.0)) -> DataFrame:
    """T5 + T6: keep the last ``t_in`` ticks per sensor; once full, forecast from the
    filled history and emit ``(edge_id, horizon, value, ts)`` rows, once a micro-batch.

    Without ``predict`` the forecast is the clipped EMA baseline. ``predict`` maps
    normalised histories (rows, t_in) to (rows, t_out); ``stats`` normalise its input and
    turn its output back into speeds, each sensor by its own mean and spread where
    they are a table (``with_params``)."""
    pairs = point_index(freq_minutes, t_out, horizons)
    out_schema = "edge_id string, horizon int, value double, ts timestamp"
    state_schema = "hist array<double>, ts timestamp"

    def update(key, pdfs, state):
        held = _held(state.get[0]) if state.exists else np.zeros(0)
        pdfs = list(pdfs)
        times, speeds = _in_order(pdfs)
        hist = np.concatenate([held, speeds])[-t_in:]
        last = pd.Timestamp(times[-1])
        state.update((_known(hist), last))
        if hist.size == t_in:
            y = _known(forecasts(filled_history(hist)[None, :], t_out, alpha, predict, *_params(pdfs))[0])
            rows = [(key[0], h, y[i - 1], last) for h, i in pairs]
            yield pd.DataFrame(rows, columns=["edge_id", "horizon", "value", "ts"])

    rows = with_params(long, stats).select("edge_id", "timestamp", "speed", "mu", "sigma")
    return rows.groupBy("edge_id").applyInPandasWithState(update, out_schema, state_schema, "update", GroupStateTimeout.NoTimeout)


def requested(requests: DataFrame) -> DataFrame:
    """Valid requests as one row per different sensor asked for, to travel with readings."""
    valid = validate_requests(requests).where("valid")
    return valid.select(F.explode(F.array_distinct("edge_ids")).alias("edge_id"), "timestamp", F.lit(None).cast("double").alias("speed"),
                        F.col("request_id").cast("long").alias("request_id"), F.col("horizon").cast("int").alias("horizon"))


def live_lookup(events: DataFrame, freq_minutes: int, t_in: int = 12, t_out: int = 12, alpha: float = EVAL_EMA_ALPHA,
                predict: Callable[[np.ndarray], np.ndarray] | None = None,
                stats: DataFrame | tuple[float, float] = (0.0, 1.0)) -> DataFrame:
    """T9 against moving state: readings and requests as one stream, each sensor's state
    held by Spark beside the requests for it, so no stored version goes stale.

    ``events(edge_id, timestamp, speed, request_id, horizon)``: a row with a ``request_id``
    is a request (see ``requested``), any other a reading. A request sees the readings
    of earlier micro-batches and those of its own up to its instant: the forecast of its
    horizon from the last ``t_in`` ticks (``pred``), else the last known speed (``speed``),
    else nothing (``none``). Emits ``(request_id, edge_id, horizon, value, source, ts)``,
    ``ts`` being the last tick seen; a horizon between two forecast steps has no forecast.
    """
    step_of = {h: i for h, i in point_index(freq_minutes, t_out)}
    names = ["request_id", "edge_id", "horizon", "value", "source", "ts"]
    out_schema = "request_id long, edge_id string, horizon int, value double, source string, ts timestamp"
    state_schema = "hist array<double>, speed double, ts timestamp"

    def update(key, pdfs, state):
        pdfs = list(pdfs)
        mu_sigma = _params(pdfs)
        rows = pd.concat(pdfs) if len(pdfs) > 1 else pdfs[0]
        asked = rows["request_id"].notna().to_numpy()
        ticks, asks = rows[~asked].sort_values("timestamp", kind="stable"), rows[asked]
        held, speed, ts = (_held(state.get[0]), state.get[1], state.get[2]) if state.exists else (np.zeros(0), None, None)
        times = ticks["timestamp"].to_numpy(dtype="datetime64[ns]")
        hist = np.concatenate([held, ticks["speed"].to_numpy(dtype="float64", na_value=np.nan)])
        # the last known speed up to each tick, the one of the state before the first
        level = filled_history(np.concatenate([[np.nan if speed is None else speed], hist[len(held):], [0.0]]))[:-1]
        if len(asks):
            seen = np.searchsorted(times, asks["timestamp"].to_numpy(dtype="datetime64[ns]"), "right")
            upto = seen + len(held)
            value, source = level[seen], np.where(np.isnan(level[seen]), "none", "speed").astype(object)
            full = np.flatnonzero(upto >= t_in)
            if len(full):
                y = forecasts(filled_history(hist[upto[full][:, None] + np.arange(-t_in, 0)]), t_out, alpha, predict, *mu_sigma)
                step = asks["horizon"].map(step_of).to_numpy(dtype="float64")[full]
                found = np.where(np.isnan(step), np.nan, y[np.arange(len(full)), np.nan_to_num(step, nan=1.0).astype(int) - 1])
                use = full[~np.isnan(found)]
                value[use], source[use] = found[~np.isnan(found)], "pred"
            stamps = np.concatenate([[np.datetime64("NaT") if ts is None else np.datetime64(ts, "ns")], times])[seen]
            yield pd.DataFrame({"request_id": asks["request_id"].to_numpy(), "edge_id": key[0], "horizon": asks["horizon"].to_numpy(),
                                "value": _known(value), "source": source, "ts": stamps})[names]
        if len(times):
            ts = pd.Timestamp(times[-1])
        if ts is not None:
            state.update((_known(hist[-t_in:]), None if np.isnan(level[-1]) else float(level[-1]), ts))

    rows = with_params(events, stats).select("edge_id", "timestamp", "speed", "request_id", "horizon", "mu", "sigma")
    return rows.groupBy("edge_id").applyInPandasWithState(update, out_schema, state_schema, "append", GroupStateTimeout.NoTimeout)


# --------------------------------------------------------------------------- sinks


class StateTable:
    """A keyed table upserted by ``foreachBatch``; versions live in ``batch_id=<n>``.

    A version counts once its writer has committed (``_SUCCESS``). A batch builds on the
    newest version before it, so a replayed batch never reads what it overwrites; the
    two newest versions are kept."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: str = "ts"):
        self.spark, self.path, self.keys, self.order = spark, path.rstrip("/"), keys, order

    def versions(self) -> list[int]:
        """Numbers of the complete versions, ascending; a listing that fails is an error."""
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(target):
            return []
        found = []
        for status in fs.listStatus(target):
            name = status.getPath().getName()
            if name.startswith("batch_id=") and fs.exists(status.getPath().suffix("/_SUCCESS")):
                found.append(int(name.split("=")[1]))
        return sorted(found)

    def read(self, before: int | None = None) -> DataFrame | None:
        """The newest complete version (older than ``before``); None if there is none yet."""
        known = [v for v in self.versions() if before is None or v < before]
        return self.spark.read.parquet(f"{self.path}/batch_id={known[-1]}") if known else None

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        for old in [v for v in self.versions() if v < batch_id][:-1]:
            target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch_id={old}")
            target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        cur = self.read(before=batch_id)
        merged = batch if cur is None else cur.unionByName(batch)
        best = merged.groupBy(*self.keys).agg(F.max(F.struct(self.order, *[
            c for c in merged.columns if c not in self.keys and c != self.order])).alias("_b"))
        self.write(best.select(*self.keys, "_b.*"), batch_id)


def capped_log_sink(spark: SparkSession, path: str, cap: int = STREAM_LOG_CAP):
    """foreachBatch writer keeping the newest ``cap`` ticks."""
    table = StateTable(spark, path, keys=["timestamp"], order="timestamp")

    def write(batch: DataFrame, batch_id: int) -> None:
        cur = table.read(before=batch_id)
        ticks = batch.select("timestamp").distinct()
        merged = ticks if cur is None else cur.select("timestamp").unionByName(ticks).distinct()
        table.write(merged.orderBy(F.col("timestamp").desc()).limit(cap), batch_id)

    return write


def lookup_sink(pred: StateTable, latest: StateTable, write: Callable[[DataFrame, int], None]):
    """T9 over state tables that other jobs go on writing: a ``foreachBatch`` writer that
    reads the newest complete versions for every micro-batch of requests."""
    def answer(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        p, s = pred.read(), latest.read()
        if p is None:
            p = spark.createDataFrame([], "edge_id string, horizon int, value double, ts timestamp")
        if s is None:
            s = spark.createDataFrame([], "edge_id string, speed double, ts timestamp")
        write(lookup(batch, p, s), batch_id)

    return answer


def run_drained(query_df: DataFrame, checkpoint: str, mode: str, sink) -> None:
    """Run a streaming query into a foreachBatch sink until its sources have nothing new,
    in as many micro-batches as they give, and stop it."""
    q = query_df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def run_available(query_df: DataFrame, checkpoint: str, mode: str, sink) -> None:
    """Drain a streaming query with ``availableNow`` into a foreachBatch sink."""
    q = (query_df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
         .foreachBatch(sink).trigger(availableNow=True).start())
    q.awaitTermination()


def run_replay(spark: SparkSession, days_dir: str, state_root: str, freq_minutes: int,
               schema: str = LONG_SCHEMA, drain: bool = True, days_per_batch: int = 1) -> dict[str, StateTable]:
    """Replay date folders (``io.write_partitioned``) into the serving state tables.

    Starts one streaming query per state table over the same day-ordered source —
    latest speed (T3), EMA (T4), per-horizon forecasts (T5/T6), freshness (T7)
    and the capped tick log (T8) — each with its own checkpoint under
    ``state_root``. With ``drain`` the call takes all days there are, stops the queries
    and returns; otherwise they keep running (processing-time trigger = replay pacing).
    """
    root = state_root.rstrip("/")
    src = day_stream(spark, days_dir, schema, days_per_batch)
    tables = {
        "latest": StateTable(spark, f"{root}/latest", ["edge_id"]),
        "ema": StateTable(spark, f"{root}/ema", ["edge_id"]),
        "pred": StateTable(spark, f"{root}/pred", ["edge_id", "horizon"]),
        "fresh": StateTable(spark, f"{root}/fresh", ["kind"], order="last_ts"),
    }
    jobs = [
        (latest_stream(src), "latest", "update", tables["latest"].upsert),
        (ema_stream(src), "ema", "update", tables["ema"].upsert),
        (forecast_stream(src, freq_minutes), "pred", "update", tables["pred"].upsert),
        (freshness_stream(src).withColumn("kind", F.lit("last_ts")), "fresh", "complete", tables["fresh"].upsert),
        (src, "log", "append", capped_log_sink(spark, f"{root}/log")),
    ]
    queries = []
    for df, name, mode, sink in jobs:
        w = (df.writeStream.outputMode(mode).option("checkpointLocation", f"{root}/_checkpoints/{name}")
             .foreachBatch(sink))
        queries.append((w if drain else w.trigger(processingTime="25 seconds")).start())
    if drain:
        try:
            for q in queries:
                q.processAllAvailable()
        finally:
            for q in queries:
                q.stop()
    tables["log"] = StateTable(spark, f"{root}/log", ["timestamp"], order="timestamp")
    return tables
