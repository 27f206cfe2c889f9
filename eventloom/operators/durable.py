"""Tables of a loop's rounds in the shared folder: a round's plan starts at files, so neither it nor what lost executors must redo grows.

checkpoint() isn't used: it keeps the size that the plan was estimated at, and joins multiply that with each round. A
table that is read back has the size of its files.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where none is set, a temporary one in local mode, an error on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = getattr(spark, "_eventloom_dir", None)
    if own is None:
        own = spark._eventloom_dir = "file://" + tempfile.mkdtemp(prefix="eventloom-")
    return own


class Rounds:
    """Tables that a loop writes. What it returns may still read the last ones, so these are deleted when Python ends."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/eventloom/rounds-{uuid.uuid4().hex[:12]}"
        self.tables: list[tuple[DataFrame, str]] = []
        self.n = 0
        atexit.register(self._delete, self.base)

    def _path(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _delete(self, path: str) -> None:
        if self.spark.sparkContext._jsc is None:  # the session has ended
            return
        p, fs = self._path(path)
        fs.delete(p, True)

    def put(self, rows: DataFrame) -> DataFrame:
        """The rows, written and read back."""
        self.n += 1
        path = f"{self.base}/{self.n}"
        rows.write.parquet(path)
        out = self.spark.read.schema(rows.schema).parquet(path)
        self.tables.append((out, path))
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that nothing reads any more."""
        for t, path in self.tables:
            if any(t is x for x in tables):
                self._delete(path)
        self.tables = [(t, p) for t, p in self.tables if not any(t is x for x in tables)]

    def bytes(self, table: DataFrame) -> int:
        """Bytes of a table's files."""
        p, fs = self._path(next(path for t, path in self.tables if t is table))
        return fs.getContentSummary(p).getLength()
