"""Partitioned Parquet (``date=yyyy-MM-dd`` folders, as ``io.write_partitioned`` writes
them) as a stream in day order.

Spark's file source takes files by modification time, so copied, compacted or
re-written days would replay out of order. Here the offset is the last day taken: a
micro-batch is the next ``days_per_batch`` days, whatever their files' times or number,
and a restarted query goes on behind the day of its checkpoint. A day is taken once,
so its files must be complete when its folder appears (Spark's committer moves them
there at the end of a job).

Files are read by Arrow in the tasks, one a partition, columns by name; a column that
a file lacks is null. The path may be local or on a file system that Arrow opens
(hdfs, s3, gs); others are for ``replay.replay_source``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

DAY_PREFIX = "date="
START = {"day": ""}


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


class DayFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


class DayReader(DataSourceStreamReader):
    def __init__(self, path: str, days_per_batch: int, schema: StructType):
        self.path, self.days_per_batch, self.schema = path, days_per_batch, schema
        self.at = START

    def _days(self, after: str) -> list[str]:
        system, root = opened(self.path)
        found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        names = (f.base_name[len(DAY_PREFIX):] for f in found if f.type == fs.FileType.Directory and f.base_name.startswith(DAY_PREFIX))
        return sorted(d for d in names if d > after)

    def initialOffset(self) -> dict:
        self.at = START
        return START

    def latestOffset(self) -> dict:
        days = self._days(self.at["day"])[:self.days_per_batch]
        return {"day": days[-1]} if days else self.at

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.at = max(self.at, end, key=lambda offset: offset["day"])  # after a restart Spark asks for (end, end)
        system, root = opened(self.path)
        out = []
        for day in self._days(start["day"]):
            if day <= end["day"]:
                files = system.get_file_info(fs.FileSelector(f"{root.rstrip('/')}/{DAY_PREFIX}{day}", recursive=True))
                out += [DayFile(f.path) for f in sorted(files, key=lambda f: f.path)
                        if f.type == fs.FileType.File and f.base_name.lower().endswith((".parquet", ".pq")) and not f.base_name.startswith(("_", "."))]
        return out

    def read(self, partition: DayFile) -> Iterator[pa.RecordBatch]:
        wanted = to_arrow_schema(self.schema)
        with opened(self.path)[0].open_input_file(partition.path) as source:
            file = pq.ParquetFile(source)
            names = set(file.schema_arrow.names)
            for batch in file.iter_batches(columns=[n for n in wanted.names if n in names]):
                yield pa.RecordBatch.from_arrays(
                    [pc.cast(batch.column(f.name), f.type, safe=False) if f.name in names else pa.nulls(batch.num_rows, f.type) for f in wanted], schema=wanted)


class DaySource(DataSource):
    """``spark.readStream.format("velograph_days")`` with ``path`` and ``days_per_batch``."""

    @classmethod
    def name(cls) -> str:
        return "velograph_days"

    def streamReader(self, schema: StructType) -> DayReader:
        return DayReader(self.options["path"], int(self.options.get("days_per_batch", "1")), schema)


def day_stream(spark: SparkSession, path: str, schema: str, days_per_batch: int = 1) -> DataFrame:
    """Readings below ``path`` as a stream, ``days_per_batch`` days a micro-batch in day order."""
    # Spark starts Python for a source's planning outside the workers of UDFs: ship the classes themselves
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(DaySource)
    return spark.readStream.format(DaySource.name()).schema(schema).option("days_per_batch", days_per_batch).load(path)
