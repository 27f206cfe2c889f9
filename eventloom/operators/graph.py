"""Links between pages: edges, degrees, breadth-first depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markup, references
from ..functions.text import any_of
from .durable import Rounds


def link_edges(pages: DataFrame, url: Column, page: str, base: Column) -> DataFrame:
    """src, dst: the page and each link on it that isn't a download, one row a link.

    base: the page's address (scheme and host at least), against which links are resolved unless the page has a base
    element. Queries, fragments and parameters go, so a link to a place in the page leads to the page itself.
    """
    found = pages.select(url.alias("src"), base.alias("_base"), markup.tags(F.coalesce(F.col(page), F.lit(""))).alias("_t"))
    edges = found.select("src", F.coalesce(references.resolved(markup.base_of(F.col("_t")), F.col("_base")), F.col("_base")).alias("_base"), F.explode(markup.links_of(F.col("_t"))).alias("_h"))
    return edges.select("src", references.page_address(references.resolved(F.col("_h"), F.col("_base"))).alias("dst"))


def in_degree(edges: DataFrame, nodes: DataFrame, node: str) -> DataFrame:
    """node, in_degree: distinct sources, 0 for orphans."""
    n = edges.distinct().groupBy(F.col("dst").alias(node)).agg(F.count("*").alias("_n"))
    return nodes.select(node).distinct().join(n, node, "left").select(node, F.coalesce("_n", F.lit(0)).cast("long").alias("in_degree"))


def broken(edges: DataFrame, nodes: DataFrame, node: str, within: str | None = None, prefixes: tuple[str, ...] = ()) -> DataFrame:
    """Edges that lead to no node. within: only those to addresses that start so, followed by one of the prefixes if there are any."""
    if within is not None:
        to = F.col("dst")
        edges = edges.where(any_of(F.startswith(to, F.lit(within + p)) for p in prefixes or ("",)))
    return edges.join(nodes.select(F.col(node).alias("dst")).distinct(), "dst", "left_anti")


def crawl_report(edges: DataFrame, nodes: DataFrame, node: str, home: str, prefixes: tuple[str, ...] = ()) -> DataFrame:
    """kind, value, n of a crawl graph: pages, edges between pages, depths by value, and what is wrong.

    Wrong are broken links (distinct, under the home's prefixes), orphans (pages but the home without a link from a page)
    and pages that can't be reached from the home; value is null but for depths. Kinds without a row have none.
    """
    tables = Rounds(edges.sparkSession)
    pages = tables.put(nodes.select(F.col(node).alias("node")).distinct())
    known = edges.join(pages.select(F.col("node").alias("src")), "src", "left_semi")
    inside = tables.put(known.join(pages.select(F.col("node").alias("dst")), "dst", "left_semi").select("src", "dst").distinct())
    depth = bfs(inside, pages.sparkSession.range(1).select(F.lit(home).alias("node")))
    counted = lambda rows, kind: rows.agg(F.lit(kind).alias("kind"), F.lit(None).cast("long").alias("value"), F.count("*").alias("n"))
    rows = [
        counted(pages, "pages"), counted(inside, "edges"), counted(broken(known, pages, "node", home, prefixes).select("src", "dst").distinct(), "broken"),
        counted(pages.where(F.col("node") != home).join(inside.select(F.col("dst").alias("node")), "node", "left_anti"), "orphans"),
        counted(pages.join(depth, "node", "left_anti"), "unreachable"),
        depth.groupBy(F.col("depth").cast("long").alias("value")).agg(F.count("*").alias("n")).select(F.lit("depth").alias("kind"), "value", "n"),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.where("n > 0")


def bfs(edges: DataFrame, start: DataFrame) -> DataFrame:
    """node, depth of all that is reachable: a frontier loop until no new node is met; each round joins only the frontier.

    Each round is written, so long chains don't make the plan grow.
    """
    tables = Rounds(edges.sparkSession)
    e = tables.put(edges.select("src", "dst").distinct())
    seen = frontier = tables.put(start.select(F.col(start.columns[0]).alias("node"), F.lit(0).alias("depth")).distinct())
    d = 0
    while not frontier.isEmpty():
        d += 1
        nxt = frontier.join(e, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct()
        frontier = tables.put(nxt.join(seen.select("node"), "node", "left_anti").withColumn("depth", F.lit(d)))
        seen = seen.unionByName(frontier)
        if d % 16 == 0:  # few parts to read in each round
            seen = tables.put(seen.coalesce(int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return seen
