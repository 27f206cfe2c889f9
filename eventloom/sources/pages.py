"""Pages as rows: path and HTML of events, categories and series, made by column expressions and written as files by their paths."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..functions import times
from .recorded import opened


def escaped(c: Column) -> Column:
    out = F.coalesce(c.cast("string"), F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def _html(title: Column, body: Column) -> Column:
    return F.concat(F.lit('<!doctype html><html><head><meta charset="utf-8"><title>'), escaped(title), F.lit("</title></head><body><h1>"), escaped(title), F.lit("</h1>"), body, F.lit("</body></html>"))


def _link(href: Column, label: Column) -> Column:
    return F.concat(F.lit('<li><a href="'), escaped(href), F.lit('">'), escaped(label), F.lit("</a></li>"))


def local_text(at: Column) -> Column:
    return F.concat(F.date_format(times.local(at), "yyyy-MM-dd HH:mm"), F.lit(" JST"))


def event_pages(events: DataFrame) -> DataFrame:
    """path, html for each event that may be indexed (safe id, title, start, an action link); with the circular next event of its category.

    events: id, title, description, starts_at, category, action_links (array).
    """
    ok = F.col("id").rlike("^[A-Za-z0-9_-]+$") & (F.coalesce("title", F.lit("")) != "") & F.col("starts_at").isNotNull() & (F.size("action_links") > 0)
    by = Window.partitionBy("category").orderBy("starts_at", "id")
    e = events.where(ok).withColumns({"_next": F.coalesce(F.lead("id").over(by), F.first("id").over(by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))})
    links = F.array_join(F.transform("action_links", lambda u: _link(u, u)), "")
    body = F.concat(F.lit("<p>"), local_text(F.col("starts_at")), F.lit("</p><p>"), escaped(F.col("description")), F.lit("</p><ul>"), links, F.lit("</ul><ul>"), _link(F.concat(F.lit("/events/"), "_next", F.lit("/")), F.lit("next")), F.lit("</ul>"))
    return e.select(F.concat(F.lit("events/"), "id", F.lit("/index.html")).alias("path"), _html(F.col("title"), body).alias("html"))


def hub_pages(events: DataFrame, group: str, least: int = 1, size: int = 200) -> DataFrame:
    """path, html for each group (a category or series) with `least` events: all of them by start, `size` a page, each page with a link to the next."""
    by = Window.partitionBy(group).orderBy("starts_at", "id")
    n = Window.partitionBy(group)
    e = events.where(F.col(group).isNotNull()).withColumns({"_k": F.row_number().over(by) - 1, "_n": F.count("*").over(n)}).where(F.col("_n") >= least)
    e = e.withColumn("_page", F.floor(F.col("_k") / size).cast("int"))
    item = F.struct(F.col("_k"), _link(F.concat(F.lit("/events/"), "id", F.lit("/")), F.col("title")).alias("li"))
    out = e.groupBy(group, "_page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["li"]), "").alias("_list"), F.first("_n").alias("_n"))
    folder = lambda page: F.concat(F.lit(f"{group}/"), group, F.when(page == 0, F.lit("/")).otherwise(F.concat(F.lit("/"), (page + 1).cast("string"), F.lit("/"))))
    page = F.col("_page")
    more = F.when((page + 1) * size < F.col("_n"), _link(F.concat(F.lit("/"), folder(page + 1)), F.lit("next"))).otherwise("")
    return out.select(F.concat(folder(page), F.lit("index.html")).alias("path"), _html(F.col(group), F.concat(F.lit("<ul>"), "_list", more, F.lit("</ul>"))).alias("html"))


def preview(events: DataFrame, most: int = 24) -> DataFrame:
    return events.orderBy("starts_at", "id").limit(most)


def write_pages(pages: DataFrame, path: str) -> None:
    """Each page as the file of its path under `path`, as a server serves it; tasks write their pages, each as a whole.

    Paths that lead out of the folder, are empty or are hidden files are an error.
    """
    pages.sparkSession.dataSource.register(PageFiles)
    pages.select("path", "html").write.format("page_files").mode("append").option("path", path).save()


class _PageWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, rows: Iterator) -> WriterCommitMessage:
        files, root = opened(self.path)
        for r in rows:
            steps = (r.path or "").split("/")
            if any(s in ("", ".", "..") or s.startswith(".") for s in steps):
                raise ValueError(f"not a page's path: {r.path!r}")
            folder = "/".join([root, *steps[:-1]])
            files.create_dir(folder, recursive=True)
            hidden = f"{folder}/.{steps[-1]}.{uuid.uuid4().hex}"
            with files.open_output_stream(hidden) as f:
                f.write((r.html or "").encode())
            files.move(hidden, f"{folder}/{steps[-1]}")
        return WriterCommitMessage()


class PageFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "page_files"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _PageWriter(self.options["path"])
