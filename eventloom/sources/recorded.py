"""Paged responses from recorded files, as a batch and a streaming source: spark.read.format("recorded_pages").

A collector (out of scope here) leaves each response as <path>/<request>/<page>.json with {"request": {...}, "response":
{...}}; pages of a request are numbered in the order of their names. A request is a partition: its pages are read one
after the other, as each says what the next has to be. Options:

* path: the folder; items: the response's list of items (default results);
* chain: cursor (the response's `cursor`, default nextCursor, is what the next request asks for), offset (the next request's
  `offset` is this one's plus `n`; the response's hasNext says whether there is one), or rows (the next request's startRow is
  this one's plus the number of items; a page with fewer than rowLimit is the last);
* max_pages: pages that a request may have (default 100).

Rows: request, page and place in it from 0, item as JSON text. Items that aren't objects are passed over. A page that
isn't what the one before asks for, a page after the last one, a request whose last page asks for more, a list that is none,
and more than max_pages are errors. A request without a page has no rows.

As a stream, each micro-batch has the pages that are new since the last; an unfinished chain is no error then, as its next
page may still come.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "request string, page int, place int, item string"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address or an absolute local path, and the path in it."""
    return fs.FileSystem.from_uri(path)


class Pages(InputPartition):
    def __init__(self, request: str, files: list[str], first: int, whole: bool):
        self.request, self.files, self.first, self.whole = request, files, first, whole


class Chain:
    """What a page asks for: checks that pages follow each other."""

    def __init__(self, options: dict):
        self.items, self.kind, self.cursor = options.get("items", "results"), options.get("chain", "cursor"), options.get("cursor", "nextCursor")
        self.most = int(options.get("max_pages", "100"))
        if self.kind not in ("cursor", "offset", "rows"):
            raise ValueError(f"unknown chain: {self.kind}")

    def page(self, value, name: str) -> tuple[dict, list, dict]:
        """request, items, response of a file's content."""
        if not isinstance(value, dict) or not isinstance(value.get("response"), dict):
            raise ValueError(f"{name}: the response isn't an object")
        items = value["response"].get(self.items) or []
        if not isinstance(items, list):
            raise ValueError(f"{name}: {self.items} isn't a list")
        return value.get("request") or {}, items, value["response"]

    def wanted(self, request: dict, items: list, response: dict):
        """What the next request has to ask for; None after the last page."""
        if self.kind == "cursor":
            c = response.get(self.cursor)
            return c if items and isinstance(c, str) and c.strip() else None
        if self.kind == "offset":
            n = int(request.get("n") or 0)
            return int(request.get("offset") or 0) + n if response.get("hasNext") and len(items) >= n else None
        return int(request.get("startRow") or 0) + len(items) if len(items) >= int(request.get("rowLimit") or 1) else None

    def asked(self, request: dict):
        key = {"cursor": self.cursor, "offset": "offset", "rows": "startRow"}[self.kind]
        return request.get(key) if self.kind == "cursor" else int(request.get(key) or 0)


def _requests(path: str) -> dict[str, list[str]]:
    """The files of each request, in order."""
    files, root = opened(path)
    found: dict[str, list[str]] = {}
    for f in files.get_file_info(fs.FileSelector(root, recursive=True)):
        parts = f.path[len(root) :].strip("/").split("/")
        if f.type == fs.FileType.File and len(parts) == 2 and parts[1].endswith(".json") and not parts[1].startswith((".", "_")):
            found.setdefault(parts[0], []).append(f.path)
    return {k: sorted(v) for k, v in sorted(found.items())}


class _Read:
    def __init__(self, options: dict):
        self.path, self.chain = options["path"], Chain(options)

    def read(self, partition: Pages) -> Iterator[tuple]:
        files, _ = opened(self.path)
        wanted, before = None, None
        for k, name in enumerate(partition.files):
            with files.open_input_stream(name) as f:
                request, items, response = self.chain.page(json.loads(f.read()), name)
            if before is not None and (wanted is None or self.chain.asked(request) != wanted):
                raise ValueError(f"{name}: asks for {self.chain.asked(request)!r}, the page before for {wanted!r}")
            if k >= partition.first:
                yield from ((partition.request, k, at, json.dumps(x, ensure_ascii=False, sort_keys=True)) for at, x in enumerate(items) if isinstance(x, dict))
            before, wanted = request, self.chain.wanted(request, items, response)
        if partition.whole and wanted is not None:
            raise ValueError(f"{partition.request}: the last page asks for {wanted!r}, which wasn't recorded")

    def _pages(self, request: str, files: list[str], first: int = 0, whole: bool = True) -> Pages:
        if len(files) > self.chain.most:
            raise ValueError(f"{request}: {len(files)} pages, more than max_pages {self.chain.most}")
        return Pages(request, files, first, whole)


class _Batch(_Read, DataSourceReader):
    def partitions(self):
        return [self._pages(*r) for r in _requests(self.path).items()] or [Pages("", [], 0, False)]


class _Stream(_Read, DataSourceStreamReader):
    """Offsets: the number of pages of each request."""

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {k: len(v) for k, v in _requests(self.path).items()}

    def partitions(self, start: dict, end: dict):
        found = _requests(self.path)
        return [self._pages(k, found[k][:n], start.get(k, 0), False) for k, n in end.items() if n > start.get(k, 0)] or [Pages("", [], 0, False)]


class RecordedPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "recorded_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Batch(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RecordedPages)
