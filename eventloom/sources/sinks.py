"""Writers: calendar text, the published bundle (JSON, CSV, facets, manifest), append-only lines."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import times
from ..operators import metrics

#: Columns of the published table.
CSV_COLUMNS = ("id", "title", "starts_at", "ends_at", "organizer", "location", "category", "status", "url", "source", "confidence")


def ics_escape(c: Column) -> Column:
    out = F.coalesce(c, F.lit(""))
    for a, b in (("\\", "\\\\"), (";", "\\;"), (",", "\\,"), ("\n", "\\n")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


@F.arrow_udf(StringType())
def ics_folded(c: pa.Array) -> pa.Array:
    """Lines of at most 75 UTF-8 bytes; what follows starts with a blank; no character is cut."""
    out = []
    for line in c.to_pylist():
        if line is None:
            out.append(None)
            continue
        parts, now, size = [], "", 0
        for ch in line:
            n = len(ch.encode())
            if size + n > 75:
                parts.append(now)
                now, size = " ", 1
            now += ch
            size += n
        out.append("\r\n".join([*parts, now]))
    return pa.array(out, pa.string())


def vevent(events: DataFrame) -> Column:
    """One VEVENT: uid, title, starts_at, and description, location, url, status, ends_at if there are such columns."""
    stamp = lambda c: F.date_format(c, "yyyyMMdd'T'HHmmss'Z'")
    lines = [F.lit("BEGIN:VEVENT"), F.concat(F.lit("UID:"), ics_escape(F.col("uid"))), F.concat(F.lit("DTSTART:"), stamp("starts_at"))]
    if "ends_at" in events.columns:
        lines.append(F.concat(F.lit("DTEND:"), stamp("ends_at")))
    for name, column in (("SUMMARY", "title"), ("DESCRIPTION", "description"), ("LOCATION", "location"), ("URL", "url"), ("STATUS", "status")):
        if column in events.columns:
            lines.append(ics_folded(F.concat(F.lit(f"{name}:"), ics_escape(F.col(column)))))
    return F.concat_ws("\r\n", *lines, F.lit("END:VEVENT"))


def event_calendar(events: DataFrame, base_url: str, host: str, product: str, generated_at: Column) -> Column:
    """A calendar of one event: its id with the host as uid, start, end, title, description, and its page under base_url as address.

    events: id, title, starts_at, and description and ends_at if there are such columns; blank descriptions and null ends are left out.
    """
    stamp = lambda c: F.date_format(c, "yyyyMMdd'T'HHmmss'Z'")
    said = lambda name, c: ics_folded(F.concat(F.lit(f"{name}:"), ics_escape(c)))
    has = events.columns
    end = F.concat(F.lit("DTEND:"), stamp("ends_at")) if "ends_at" in has else F.lit(None).cast("string")
    text = F.nullif(F.trim("description"), F.lit("")) if "description" in has else F.lit(None).cast("string")
    lines = [
        F.lit("BEGIN:VCALENDAR"), F.lit("VERSION:2.0"), F.lit(f"PRODID:{product}"), F.lit("CALSCALE:GREGORIAN"), F.lit("BEGIN:VEVENT"), F.concat(F.lit("UID:"), "id", F.lit(f"@{host}")), F.concat(F.lit("DTSTAMP:"), stamp(generated_at)),
        F.concat(F.lit("DTSTART:"), stamp("starts_at")), end, said("SUMMARY", F.col("title")), F.when(text.isNotNull(), said("DESCRIPTION", text)), ics_folded(F.concat(F.lit(f"URL:{base_url}/events/"), "id", F.lit("/"))), F.lit("END:VEVENT"), F.lit("END:VCALENDAR"),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n"))


def write_calendar(events: DataFrame, path: str) -> None:
    """A calendar file a partition, events in order of start and uid; files follow the order too."""
    body = events.select("starts_at", "uid", vevent(events).alias("value")).orderBy("starts_at", "uid").select("value")

    def wrap(batches):
        lines = lambda x: pa.RecordBatch.from_arrays([pa.array(x, pa.string())], ["value"])
        yield lines(["BEGIN:VCALENDAR\r\nVERSION:2.0\r\nPRODID:-//eventloom//EN"])
        for b in batches:
            yield lines(b.column(0).to_pylist())
        yield lines(["END:VCALENDAR"])

    body.mapInArrow(wrap, "value string").write.mode("overwrite").option("lineSep", "\r\n").text(path)


def write_bundle(events: DataFrame, path: str, facet_fields: list[str]) -> DataFrame:
    """events/ (JSON), table/ (CSV by start and id), facets/ (Parquet), and the manifest: rows and a digest of the events, bytes and SHA-256 of each file."""
    present = [c for c in CSV_COLUMNS if c in events.columns]
    events.write.mode("overwrite").json(f"{path}/events")
    events.select(*present).orderBy("starts_at", "id").write.mode("overwrite").option("header", True).csv(f"{path}/table")
    facets = metrics.facets(events, facet_fields)
    facets.write.mode("overwrite").parquet(f"{path}/facets")
    digest = events.select(F.xxhash64(*present).cast("decimal(38,0)").alias("h")).agg(F.count("*").alias("rows"), F.sum("h").cast("string").alias("digest"))
    whole = digest.select(F.lit("events").alias("part"), F.lit(None).cast("string").alias("file"), "rows", "digest", F.lit(None).cast("long").alias("bytes"), F.lit(None).cast("string").alias("sha256"))
    manifest = whole.unionByName(file_digests(events.sparkSession, path, ("events", "table", "facets")), allowMissingColumns=True)
    manifest.write.mode("overwrite").json(f"{path}/manifest")
    return manifest


def file_digests(spark: SparkSession, path: str, parts: tuple[str, ...]) -> DataFrame:
    """part, file, bytes, sha256 of each file of a written table, read as whole files by tasks."""
    out = None
    for part in parts:
        f = spark.read.format("binaryFile").load(f"{path}/{part}/part-*")
        f = f.select(F.lit(part).alias("part"), F.regexp_extract("path", "([^/]+)$", 1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
        out = f if out is None else out.unionByName(f)
    return out


def append_once(rows: DataFrame, path: str, key: str) -> None:
    """Appends rows as JSON lines whose key the file hasn't yet; the same run twice changes nothing."""
    spark = rows.sparkSession
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs_path):
        rows = rows.join(spark.read.schema(rows.schema).json(path).select(key), key, "left_anti")
    rows.write.mode("append").json(path)


def sitemap(pages: DataFrame, path: str, size: int = 50_000) -> None:
    """Files of at most about `size` addresses, each a whole urlset, dealt and sorted by address."""
    escaped = F.replace(F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    rows = pages.select("url").distinct().orderBy("url").select(F.concat(F.lit("<url><loc>"), escaped, F.lit("</loc></url>")).alias("value"))
    files = max(1, -(-rows.count() // size))
    head, tail = '<?xml version="1.0" encoding="UTF-8"?>\n<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">', "</urlset>"

    def wrap(batches):
        yield pa.RecordBatch.from_arrays([pa.array([head], pa.string())], ["value"])
        yield from batches
        yield pa.RecordBatch.from_arrays([pa.array([tail], pa.string())], ["value"])

    rows.repartitionByRange(files, "value").sortWithinPartitions("value").mapInArrow(wrap, "value string").write.mode("overwrite").text(path)


def iso_columns(events: DataFrame, columns: list[str]) -> DataFrame:
    return events.withColumns({c: times.iso_z(F.col(c)) for c in columns})
