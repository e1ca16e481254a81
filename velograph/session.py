"""Session helpers: one place for the SQL confs the operators rely on."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Confs every operator assumes. Instants are naive wall-clock values, so the
# session zone is pinned to UTC; AQE re-plans joins/partition counts at run time.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a hot key is split even where an aggregate on it follows (one more shuffle then)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL confs the library needs to an existing session."""
    for key, value in SQL_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "velograph") -> SparkSession:
    """Local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in SQL_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, which all executors see.

    The setting is only read where it is present. A local-mode session without
    it (tests, the bench) gets a scratch folder of its own; any other master
    without it is an error, since executors would write to their own disks.
    """
    configured = (spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
                  or spark.conf.get("spark.checkpoint.dir", None))
    if configured:
        return configured
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
    path = tempfile.mkdtemp(prefix="velograph-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def off_its_keys(per_key):
    """A table with one row a key, for a join on that key. An aggregate leaves it
    partitioned by the key, which a join would reuse, and AQE splits a hot key of the
    other side only where both sides are shuffled for the join. Dealt out anew, it is;
    the rows moved are one a key. (AQE still broadcasts a small one.)"""
    return per_key.hint("rebalance")


@contextmanager
def setting(spark, name: str, value: str | None):
    """A session conf for the length of a block; None leaves it alone."""
    before = spark.conf.get(name, None)
    if value is not None:
        spark.conf.set(name, value)
    try:
        yield
    finally:
        if value is not None:
            spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def scratch_folder(spark, name: str) -> str:
    """A new folder under the shared checkpoint folder, removed when the driver's Python ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def materialize(df, name: str):
    """Write ``df`` once as Parquet in a ``scratch_folder`` and read it back. Use where a
    plan must read the *same* rows twice (e.g. values tagged with partition ids): cuts
    lineage, survives executor loss, and computes the data a single time."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _remove(spark, path: str) -> None:
    sc = spark.sparkContext
    if sc._jsc is not None and not sc._jsc.sc().isStopped():
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
