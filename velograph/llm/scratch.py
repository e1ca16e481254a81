"""Tables written between the steps of one operator call, in the shared folder.

A written table cuts lineage (a lost executor costs a re-read, not a
recomputation) and lets several steps read rows that were computed once.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

from velograph.session import checkpoint_dir


BATCH_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    """Rows here are whole texts or pages: Arrow batches of the default 10,000 rows would
    be held several times over in the JVM and in Python."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > BATCH_ROWS or int(spark.conf.get(name)) <= 0:
        spark.conf.set(name, str(BATCH_ROWS))


class Scratch:
    """Folder of one operator call under ``spark.checkpoint.dir``."""

    def __init__(self, spark: SparkSession, name: str):
        small_batches(spark)
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        atexit.register(self._remove, self.root)

    def write(self, df: DataFrame, name: str, **options) -> DataFrame:
        """Write ``df`` once as Parquet and read it back."""
        df.write.options(**options).parquet(f"{self.root}/{name}")
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def drop(self, name: str) -> None:
        """Delete a table that no later step (or lazy result) reads."""
        self._remove(f"{self.root}/{name}")

    def _remove(self, path: str) -> None:
        sc = self.spark.sparkContext
        if sc._jsc is None or sc._jsc.sc().isStopped():
            return
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
