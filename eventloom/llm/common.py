"""Helpers shared by the corpus operators: inputs, durable tables, per-task Arrow maps and memo tables."""

from __future__ import annotations

import atexit
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts handled at a time inside a task; bounds what a task holds as Python objects.
SLICE_ROWS = 256
#: Most bytes that may be broadcast; larger sides take another way.
BROADCAST_BYTES = 64 << 20
#: Most bytes of Parquet files of a table that may be broadcast: some times that in memory.
LIGHT_BYTES = 12 << 20
#: Bits of a filter of keys: 8 MB, whatever the number of keys; with many more keys than bits it lets everything pass.
FILTER_BITS = 1 << 26
#: Rows in a file of a narrow intermediate table whose greatest length is known.
FILE_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """doc_id (long) and text only, whatever other columns the table has; a null text stays null."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset, a temporary one in local mode, an error on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = getattr(spark, "_eventloom_dir", None)
    if own is None:
        own = spark._eventloom_dir = "file://" + tempfile.mkdtemp(prefix="eventloom-")
    return own


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session has ended, or the table is gone already
        return


class Durable:
    """Intermediate tables in the shared folder. They cut lineage and outlive any executor."""

    def __init__(self, spark: SparkSession, tag: str):
        self.spark, self.base, self.n = spark, f"{shared_dir(spark)}/eventloom/{tag}-{uuid.uuid4().hex[:12]}", 0
        self.tables: list[tuple[DataFrame, str]] = []
        atexit.register(_delete, spark, self.base)

    def put(self, df: DataFrame, replaces: str | None = None, rows: int | None = None) -> DataFrame:
        """Writes df and reads it back; a table that it replaces is deleted after.

        rows: most rows that df can have, if known; a small table then goes to few files, FILE_ROWS rows or less in each.
        """
        self.n += 1
        path = f"{self.base}/{self.n}"
        if rows is not None:
            df = df.repartition(max(1, -(-rows // FILE_ROWS)))
        df.write.parquet(path)
        if replaces:
            _delete(self.spark, replaces)
        self.path = path
        out = self.spark.read.schema(df.schema).parquet(path)
        self.tables.append((out, path))
        return out

    def bytes(self, table: DataFrame) -> int:
        """Bytes of the files of a table that put() gave."""
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(next(path for t, path in self.tables if t is table))
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()

    def light(self, table: DataFrame) -> DataFrame:
        """The table, to be broadcast if its files are of LIGHT_BYTES at most; larger ones are joined by shuffle."""
        return F.broadcast(table) if self.bytes(table) <= LIGHT_BYTES else table

    def keep(self, *needed: DataFrame) -> None:
        """Deletes all tables but those that are still needed."""
        for df, path in self.tables:
            if not any(df is x for x in needed):
                _delete(self.spark, path)
        self.tables = [t for t in self.tables if any(t[0] is x for x in needed)]


def key_filter(store: Durable, keys: DataFrame, key: str) -> DataFrame:
    """bucket, bitmap: a bit for each key by its hash, in bitmaps of 32,768 bits; FILTER_BITS in all."""
    bit = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    return store.put(keys.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bitmap")).coalesce(4))


def with_filter(rows: DataFrame, bits: DataFrame, key: str) -> DataFrame:
    """rows with may_have: false only if no such key is in the filter. Rows that can't be joined needn't be shuffled."""
    bit = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    place = F.bitmap_bit_position(bit).cast("int")
    df = rows.withColumn("_bucket", F.bitmap_bucket_number(bit)).join(F.broadcast(bits.withColumnRenamed("bucket", "_bucket")), "_bucket", "left")
    byte = F.conv(F.hex(F.substring("bitmap", (place / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    has = F.floor(byte / F.pow(F.lit(2), place % 8)).cast("int") % 2 == 1
    return df.withColumn("may_have", F.coalesce(has, F.lit(False))).drop("_bucket", "bitmap")


def map_rows(df: DataFrame, schema: str, start: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]], rows: int = SLICE_ROWS, most_bytes: int | None = None) -> DataFrame:
    """mapInArrow in slices of so many rows. start() runs once a task and gives the function from a slice to batches.

    most_bytes: a slice also ends where its texts (the second column) have this size.
    """

    def cuts(batch: pa.RecordBatch) -> list[int]:
        if most_bytes is None or batch.nbytes <= most_bytes:
            return [*range(0, batch.num_rows, rows), batch.num_rows]
        out, size = [0], 0
        for i, n in enumerate(pc.binary_length(batch.column(1)).to_pylist()):
            if i > out[-1] and (i - out[-1] >= rows or size + (n or 0) > most_bytes):
                out.append(i)
                size = 0
            size += n or 0
        return [*out, batch.num_rows]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for batch in batches:
            at = cuts(batch)
            for a, b in zip(at[:-1], at[1:], strict=True):
                if a < b:
                    yield from step(batch.slice(a, b - a))

    return df.mapInArrow(releasing(run), schema)


def release() -> None:
    """Gives memory that this process has freed back to the machine: a worker lives on between tasks, other processes need it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """run, a function for mapInArrow, that gives its memory back at the end of a task."""

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return released


class Memo(dict):
    """A bounded memo of a function of one string: two generations of at most cap entries; long keys aren't kept."""

    def __init__(self, fn: Callable, cap: int = 120_000, longest: int = 48):
        super().__init__()
        self.fn, self.cap, self.longest, self.old = fn, cap, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.fn(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.cap:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


_RESIDENT: dict = {}


def resident(key, build: Callable):
    """The one object that a worker process keeps for later tasks: a vocabulary, a model and its memo.

    Another key takes its place, so a worker that serves one operator after the other holds one memo at a time.
    """
    if key not in _RESIDENT:
        _RESIDENT.clear()
        gc.collect()
        release()
        _RESIDENT[key] = build()
    return _RESIDENT[key]


#: ASCII bytes that are no letters or digits become blanks, A-Z become a-z; other bytes stay. What is left between
#: blanks are the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of the lower-cased text.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def word_bytes(text: str | None) -> list[bytes]:
    """UTF-8 words of a text whose A-Z are lower-cased; null has none."""
    return (text or "").encode().translate(WORD_BYTES).split()
