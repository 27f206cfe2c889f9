"""Reading HTML: one tokenizer gives the tags of a page as an array of structs, and columns take what they need from it.

The tokenizer is html.parser's state machine, run over whole pages in an Arrow function: attributes with any quotes or none,
comments, raw script text and entities are read as browsers mostly do, however broken the page is. Time is linear in a
page's characters.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

#: Tags that are kept.
TAGS = ("a", "base", "meta", "script", "title")
KIND = pa.list_(pa.struct([("tag", pa.string()), ("attributes", pa.map_(pa.string(), pa.string())), ("body", pa.string())]))
#: Pages of a batch that are Python objects at one time: with all of a batch's ten thousand, memory grows until batches are full.
STEP = 64


class _Tags(HTMLParser):
    """Start tags in order, with the text up to the end tag for scripts and titles; those that are never closed have none."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[dict] = []
        self.open: tuple[dict, list[str]] | None = None

    def handle_starttag(self, tag, attrs):
        if tag in TAGS:
            row = {"tag": tag, "attributes": list(dict(attrs).items()), "body": None}
            self.found.append(row)
            if tag in ("script", "title"):
                self.open = row, []

    def handle_data(self, data):
        if self.open:
            self.open[1].append(data)

    def handle_endtag(self, tag):
        if self.open and self.open[0]["tag"] == tag:
            self.open[0]["body"] = "".join(self.open[1])
            self.open = None




def page_tags(page: str | None) -> list[dict]:
    """tag, attributes (the last of equal names; null without a value), body of TAGS. Null and empty pages have none."""
    parser = _Tags()
    parser.feed(page or "")
    return parser.found


@F.arrow_udf(ArrayType(StructType([StructField("tag", StringType()), StructField("attributes", MapType(StringType(), StringType())), StructField("body", StringType())])))
def tags(pages: pa.Array) -> pa.Array:
    parts = [pa.array([page_tags(p) for p in pages.slice(k, STEP).to_pylist()], KIND) for k in range(0, len(pages), STEP)]
    return pa.concat_arrays(parts) if parts else pa.array([], KIND)


def as_written(page: Column) -> Column:
    """A page whose titles and attributes come out of the tokenizer as they are written, references and all (scripts don't)."""
    return F.replace(page, F.lit("&"), F.lit("&amp;"))


def of_tag(found: Column, tag: str) -> Column:
    return F.filter(found, lambda t: t["tag"] == tag)


def meta_of(found: Column, name: str) -> Column:
    """Content of the first meta element with that name or property, whatever its case; empty ones are passed over."""
    names = lambda t: F.array(*(F.lower(F.element_at(t["attributes"], F.lit(k))) for k in ("name", "property")))
    wanted = F.filter(of_tag(found, "meta"), lambda t: F.exists(names(t), lambda n: n == name.lower()) & (F.element_at(t["attributes"], F.lit("content")) != ""))
    return F.get(F.transform(wanted, lambda t: F.element_at(t["attributes"], F.lit("content"))), F.lit(0))


def links_of(found: Column) -> Column:
    """href of each anchor that isn't a download and has one."""
    kept = F.filter(of_tag(found, "a"), lambda t: ~F.map_contains_key(t["attributes"], "download") & (F.element_at(t["attributes"], F.lit("href")) != ""))
    return F.transform(kept, lambda t: F.element_at(t["attributes"], F.lit("href")))


def base_of(found: Column) -> Column:
    """href of the first base element that has one, or null."""
    kept = F.filter(of_tag(found, "base"), lambda t: F.element_at(t["attributes"], F.lit("href")) != "")
    return F.get(F.transform(kept, lambda t: F.element_at(t["attributes"], F.lit("href"))), F.lit(0))


def scripts_of(found: Column, wanted) -> Column:
    """Bodies of the closed scripts whose attributes are wanted, a function from a map column to a condition."""
    kept = F.filter(of_tag(found, "script"), lambda t: t["body"].isNotNull() & F.coalesce(wanted(t["attributes"]), F.lit(False)))
    return F.transform(kept, lambda t: F.trim(t["body"]))
