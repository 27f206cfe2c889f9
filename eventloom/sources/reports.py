"""Dated reports with a latest copy: spark write.format("dated_report"), committed as a whole.

Tasks write their rows as JSON lines to files of their own under <path>/data/<run>; nobody reads these before the commit. The
commit, which Spark calls once all tasks have ended well, writes the dated report <path>/<stamp>.json, a manifest with rows,
bytes and SHA-256 of each file, and at last moves an equal copy to <path>/latest.json. A reader follows a manifest, so
it sees the old report or the new one, never parts. If a task fails, Spark calls abort: the run's files go, and
what was there stays. A run for a stamp that exists replaces its manifest.

Options: path (an address of a file system that all executors share, or a local path), stamp (letters, digits, . _ -).
"""

from __future__ import annotations

import datetime
import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from .recorded import opened

VERSION = "1.0"


@dataclass
class Part(WriterCommitMessage):
    partition: int
    name: str
    rows: int
    bytes: int
    sha256: str


def _plain(v):
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return v.asDict(True) if hasattr(v, "asDict") else str(v)


class _Writer(DataSourceWriter):
    def __init__(self, path: str, stamp: str, schema: dict):
        self.path, self.stamp, self.schema, self.run = path.rstrip("/"), stamp, schema, uuid.uuid4().hex

    def _write(self, name: str, body: bytes) -> None:
        files, root = opened(self.path)
        files.create_dir(f"{root}/{name}".rpartition("/")[0], recursive=True)
        with files.open_output_stream(f"{root}/{name}") as f:
            f.write(body)

    def write(self, rows: Iterator) -> Part:
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        name = f"data/{self.run}/part-{part:05d}-{uuid.uuid4().hex[:8]}.json"  # an attempt has a file of its own
        files, root = opened(self.path)
        files.create_dir(f"{root}/data/{self.run}", recursive=True)
        digest, n, size = hashlib.sha256(), 0, 0
        with files.open_output_stream(f"{root}/{name}") as f:
            for r in rows:
                line = json.dumps(r.asDict(True), ensure_ascii=False, sort_keys=True, default=_plain).encode() + b"\n"
                f.write(line)
                digest.update(line)
                n, size = n + 1, size + len(line)
        return Part(part, name, n, size, digest.hexdigest())

    def commit(self, messages: list) -> None:
        parts = sorted((m for m in messages if m is not None), key=lambda m: m.partition)
        report = {"version": VERSION, "stamp": self.stamp, "schema": self.schema, "rows": sum(p.rows for p in parts), "files": [{"name": p.name, "rows": p.rows, "bytes": p.bytes, "sha256": p.sha256} for p in parts]}
        body = (json.dumps(report, ensure_ascii=False, indent=2, sort_keys=True) + "\n").encode()
        files, root = opened(self.path)
        for target in (f"{self.stamp}.json", "latest.json"):  # the latest at last
            hidden = f".{target}.{self.run}"
            self._write(hidden, body)
            files.move(f"{root}/{hidden}", f"{root}/{target}")

    def abort(self, messages: list) -> None:
        files, root = opened(self.path)
        at = f"{root}/data/{self.run}"
        if files.get_file_info(at).type == fs.FileType.Directory:
            files.delete_dir(at)


class DatedReport(DataSource):
    @classmethod
    def name(cls) -> str:
        return "dated_report"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        stamp = self.options.get("stamp", "")
        if not re.fullmatch(r"[A-Za-z0-9._-]+", stamp) or stamp == "latest":
            raise ValueError("stamp: letters, digits, '.', '_' and '-', and not latest")
        return _Writer(self.options["path"], stamp, schema.jsonValue())


def register(spark: SparkSession) -> None:
    spark.dataSource.register(DatedReport)


def write_report(rows: DataFrame, path: str, stamp: str) -> None:
    register(rows.sparkSession)
    rows.write.format("dated_report").mode("append").option("path", path).option("stamp", stamp).save()


def manifest(path: str, stamp: str = "latest") -> dict:
    files, root = opened(path)
    with files.open_input_stream(f"{root}/{stamp}.json") as f:
        return json.loads(f.read())


def read_report(spark: SparkSession, path: str, stamp: str = "latest") -> DataFrame:
    """A report's rows; files that the manifest doesn't name aren't read. Values that JSON has no type for come back by the schema."""
    m = manifest(path, stamp)
    kept = [f"{path.rstrip('/')}/{f['name']}" for f in m["files"] if f["rows"]]
    schema = StructType.fromJson(m["schema"])
    return spark.read.schema(schema).option("mode", "FAILFAST").json(kept) if kept else spark.createDataFrame([], schema)
