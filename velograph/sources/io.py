"""Sources and sinks (S1–S21, J12, P13, P15): readers that land every input in
the canonical long table, and partitioned Parquet / CSV / JSON writers.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from velograph.functions.columns import nan_to_null, safe_double
from velograph.session import configure, setting

CANONICAL = "timestamp timestamp, edge_id string, speed double"
MATRIX_START = "2017-01-01 00:00:00"   # implied time axis of a raw speed matrix
PARTITION_COLUMNS = ("date", "hour")
SUFFIXES = (".parquet", ".pq", ".csv")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """One CSV or Parquet file chosen by suffix; anything else is an error."""
    configure(spark)
    p = path.lower()
    if p.endswith((".parquet", ".pq")):
        return spark.read.parquet(path)
    if p.endswith(".csv"):
        return spark.read.option("header", True).csv(path)
    raise ValueError(f"Unsupported file type: {path}")


def files_below(spark: SparkSession, path: str) -> list[str]:
    """Data files below ``path`` (any Hadoop file system); hidden ones are left out."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return []
    root, found, walk = fs.makeQualified(target).toString(), [], fs.listFiles(target, True)
    while walk.hasNext():
        name = walk.next().getPath().toString()
        if not any(part.startswith(("_", ".")) for part in name[len(root):].split("/")):
            found.append(name)
    return found


def read_dir(spark: SparkSession, path: str) -> DataFrame:
    """Every Parquet and CSV file below ``path`` (recursively), unioned by name.

    * Suffixes count in any case (``.parquet``, ``.pq``, ``.csv``); other files are ignored.
    * CSV files are grouped by their header line and each group is read under its own
      names, so columns may come in any order and differ from file to file. Spark checks
      every file against its group's header; a file without any line adds nothing.
    * Parquet files are read under the union of their schemas. Files whose types clash are
      grouped by schema, and numbers widen.
    * A column that is text in some files and something else in others is text.

    A file that cannot be read is an error. Names that differ in case are one column.
    """
    configure(spark)
    names = files_below(spark, path)
    if not any(n.lower().endswith(SUFFIXES) for n in names):
        raise FileNotFoundError(f"No CSV/Parquet files found under {path}")
    frames = _parquet_frames(spark, path, [n for n in names if n.lower().endswith(SUFFIXES[:2])])
    frames += _csv_frames(spark, [n for n in names if n.lower().endswith(SUFFIXES[2])])
    if not frames:
        raise FileNotFoundError(f"No columns in the CSV files under {path}")
    return _union_by_name(frames)


def _each(call, items: list) -> list:
    """``call`` of every item; the calls wait for the file system, a few at a time."""
    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(call, items))


def _grouped(keys: list, items: list) -> dict:
    groups: dict = {}
    for key, item in zip(keys, items, strict=True):
        groups.setdefault(key, []).append(item)
    return groups


def _parquet_frames(spark: SparkSession, path: str, files: list[str]) -> list[DataFrame]:
    if not files:
        return []
    any_case = "*.{[pP][aA][rR][qQ][uU][eE][tT],[pP][qQ]}"
    whole = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", any_case).option("mergeSchema", True)
    try:
        return [whole.parquet(path)]
    except (Py4JJavaError, PySparkException) as clash:
        if "CANNOT_MERGE_SCHEMAS" not in str(clash):
            raise
    files = [_literal(f) for f in files]
    groups = _grouped(_each(lambda f: spark.read.parquet(f).schema.json(), files), files)
    return [spark.read.parquet(*group) for group in groups.values()]


def _csv_frames(spark: SparkSession, files: list[str]) -> list[DataFrame]:
    headers = _each(lambda f: header_line(spark, f), files)
    groups = _grouped(headers, [_literal(f) for f in files])
    groups.pop(None, None)
    frames = []
    for group in groups.values():
        schema = spark.read.option("header", True).csv(group[0]).schema
        # with enforceSchema off, a header of other names or order is an error, never a misplaced column
        frames.append(spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(group))
    return frames


def _literal(path: str) -> str:
    """A path for readers that take glob patterns."""
    return re.sub(r"([\\\\*?\[\]{}])", r"\\\1", path)


def header_line(spark: SparkSession, path: str) -> str | None:
    """First line with anything in it of a text file on any Hadoop file system, else None."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(target)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        while (line := reader.readLine()) is not None:
            if line.strip("\ufeff \t"):
                return line
        return None
    finally:
        stream.close()


def _union_by_name(frames: list[DataFrame]) -> DataFrame:
    kinds: dict[str, set] = {}
    for frame in frames:
        for field in frame.schema.fields:
            kinds.setdefault(field.name.lower(), set()).add(field.dataType)
    text = {name for name, of in kinds.items() if len(of) > 1 and not all(isinstance(t, NumericType) for t in of)}
    frames = [f.select(*(F.col(f"`{c}`").cast("string").alias(c) if c.lower() in text else F.col(f"`{c}`") for c in f.columns)) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def normalize_readings(df: DataFrame) -> DataFrame:
    """S3–S6 + W2: canonical long readings from a TALL or WIDE table.

    ``ts`` is renamed to ``timestamp``; partition columns ``date``/``hour``
    are dropped; TALL is detected by column names (any case); WIDE sensor
    columns are parsed leniently (bad text → NULL) and unpivoted.
    """
    cols = df.columns
    if "timestamp" not in cols and "ts" in cols:
        df = df.withColumnRenamed("ts", "timestamp")
    if "timestamp" not in df.columns:
        raise ValueError(f"Expected a 'timestamp' column; got {df.columns}")
    df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    df = df.drop(*[c for c in PARTITION_COLUMNS if c in df.columns])
    lower = {c.lower(): c for c in df.columns}
    if {"timestamp", "edge_id", "speed"} <= set(lower):
        return df.select(F.col("timestamp"), F.col(lower["edge_id"]).cast("string").alias("edge_id"),
                         safe_double(F.col(lower["speed"])).alias("speed"))
    sensors = [c for c in df.columns if c != "timestamp"]
    if not sensors:
        raise ValueError("No sensor columns found besides 'timestamp'.")
    wide = df.select("timestamp", *[safe_double(F.col(f"`{c}`")).alias(c) for c in sensors])
    return wide.unpivot(["timestamp"], sensors, "edge_id", "speed")


def matrix_to_readings(matrix: DataFrame, freq_minutes: int = 5, start: str = MATRIX_START) -> DataFrame:
    """``(row_idx, values ARRAY<DOUBLE>)`` → long readings.

    The matrix is T×N when rows ≥ columns, else N×T (transposed by swapping
    the row index and the array position); instants are ``start + t·freq``,
    sensors are named ``s<i>``. Orientation is decided by two aggregates.
    """
    shape = matrix.agg(F.count("*").alias("rows"), F.max(F.size("values")).alias("cols"))
    transpose = shape.select((F.col("rows") < F.col("cols")).alias("t")).scalar()
    cells = matrix.select("row_idx", F.posexplode("values").alias("pos", "v"))
    t_idx = F.when(transpose, F.col("pos").cast("long")).otherwise(F.col("row_idx"))
    n_idx = F.when(transpose, F.col("row_idx")).otherwise(F.col("pos").cast("long"))
    return cells.select(
        F.timestamp_micros(F.unix_micros(F.lit(start).cast("timestamp")) +
                           t_idx * F.lit(int(freq_minutes) * 60_000_000)).alias("timestamp"),
        F.concat(F.lit("s"), n_idx.cast("string")).alias("edge_id"),
        nan_to_null("v").alias("speed"))


def to_wide(readings: DataFrame, sensors: list[str]) -> DataFrame:
    """W1 export form: one column for each of ``sensors`` (mean on duplicates). A wide
    table has its sensors in the schema, so the caller names them."""
    return readings.groupBy("timestamp").pivot("edge_id", sensors).agg(F.avg("speed"))


def with_partition_columns(df: DataFrame, hour: bool = False) -> DataFrame:
    """``date`` (yyyy-MM-dd text) and optionally ``hour`` partition columns."""
    out = df.withColumn("date", F.date_format("timestamp", "yyyy-MM-dd"))
    return out.withColumn("hour", F.hour("timestamp")) if hour else out


def write_partitioned(df: DataFrame, path: str, by_hour: bool = False, mode: str = "overwrite", file_bytes: int | None = None) -> None:
    """Parquet partitioned by date (and hour), snappy, 1 MB pages.

    Rows are first dealt out by the partition columns, so that each task writes few files
    per partition. AQE evens the tasks out: small partitions share one, and one of more
    than the advisory size (``file_bytes`` of shuffled data, 64 MB if not given) is split
    over several tasks and files, so a hot day is not one task.
    """
    parts = ["date", "hour"] if by_hour else ["date"]
    out = with_partition_columns(df, by_hour).hint("rebalance", *parts)
    with setting(df.sparkSession, "spark.sql.adaptive.advisoryPartitionSizeInBytes", None if file_bytes is None else str(int(file_bytes))):
        (out.write.mode(mode).partitionBy(*parts).option("compression", "snappy")
         .option("parquet.page.size", 1 << 20).option("parquet.enable.dictionary", True).parquet(path))


def read_partitioned(spark: SparkSession, path: str, view: str | None = None, ordered: bool = False) -> DataFrame:
    """Partition-discovered read (``date``/``hour`` prune filters), with
    ``ordered`` in time order (a range-partitioned sort); optional temp view."""
    df = spark.read.parquet(path)
    if ordered:
        df = df.orderBy("timestamp", "edge_id")
    if view:
        df.createOrReplaceTempView(view)
    return df


def write_sidecar(stats: DataFrame, path: str, freq_minutes: int) -> None:
    """Metadata JSON, one line per sensor (edge_id, mu, sigma, freq_minutes), so
    neither the writer nor a reader holds all sensors at once."""
    (stats.select("edge_id", "mu", "sigma", F.lit(int(freq_minutes)).alias("freq_minutes"))
     .write.mode("overwrite").json(path))


def read_sidecar(spark: SparkSession, path: str) -> DataFrame:
    """Sidecar back to a stats table ``(edge_id, mu, sigma, freq_minutes)``."""
    return spark.read.schema("edge_id string, mu double, sigma double, freq_minutes int").json(path)


def write_windows(windows: DataFrame, path: str, freq_minutes: int, horizon_minutes: int, t_in: int) -> str:
    """Window dataset as Parquet ``heldout_day_t{t_in}_o{horizon}`` with its parameters."""
    name = f"{path.rstrip('/')}/heldout_day_t{t_in}_o{horizon_minutes}"
    (windows.withColumn("freq_minutes", F.lit(freq_minutes))
     .withColumn("horizon_minutes", F.lit(horizon_minutes)).withColumn("t_in", F.lit(t_in))
     .write.mode("overwrite").parquet(name))
    return name


def write_sensors(sensors: DataFrame, index: DataFrame, path: str) -> dict[str, str]:
    """Sensor metadata as CSV and the id → index map as JSON lines (folders of part files)."""
    out = {"metadata": f"{path.rstrip('/')}/sensors", "index": f"{path.rstrip('/')}/sensor_index"}
    sensors.write.mode("overwrite").option("header", True).csv(out["metadata"])
    index.select("sensor_id", "idx").write.mode("overwrite").json(out["index"])
    return out


def read_edge_list(spark: SparkSession, path: str) -> DataFrame:
    """CSV ``src,dst[,w]`` (header) with empty ``w`` → 1.0."""
    from velograph.operators.graph import parse_edge_list
    return parse_edge_list(spark.read.option("header", True).csv(path))


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Report tables as CSV (header) or JSON or Parquet (a folder of part files)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)
