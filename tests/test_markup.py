"""Pages, links and references: the tokenizer, RFC 3986, the crawl graph."""

import random
import time
from html.parser import HTMLParser
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from eventloom.functions import markup, references
from eventloom.functions import text as T
from eventloom.operators import graph
from eventloom.sources import readers

#: RFC 3986, 5.4: references against http://a/b/c/d;p?q and what they become.
EXAMPLES = {
    "g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g", "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y",
    "#s": "http://a/b/c/d;p?q#s", "g#s": "http://a/b/c/g#s", "g?y#s": "http://a/b/c/g?y#s", ";x": "http://a/b/c/;x", "g;x": "http://a/b/c/g;x", "g;x?y#s": "http://a/b/c/g;x?y#s", "": "http://a/b/c/d;p?q",
    ".": "http://a/b/c/", "./": "http://a/b/c/", "..": "http://a/b/", "../": "http://a/b/", "../g": "http://a/b/g", "../..": "http://a/", "../../": "http://a/", "../../g": "http://a/g",
    "../../../g": "http://a/g", "../../../../g": "http://a/g", "/./g": "http://a/g", "/../g": "http://a/g", "g.": "http://a/b/c/g.", ".g": "http://a/b/c/.g", "g..": "http://a/b/c/g..", "..g": "http://a/b/c/..g",
    "./../g": "http://a/b/g", "./g/.": "http://a/b/c/g/", "g/./h": "http://a/b/c/g/h", "g/../h": "http://a/b/c/h", "g;x=1/./y": "http://a/b/c/g;x=1/y", "g;x=1/../y": "http://a/b/c/y",
    "g?y/./x": "http://a/b/c/g?y/./x", "g?y/../x": "http://a/b/c/g?y/../x", "g#s/./x": "http://a/b/c/g#s/./x", "g#s/../x": "http://a/b/c/g#s/../x", "http:g": "http:g",
}


def test_references_of_the_rfc(spark):
    df = spark.createDataFrame(list(EXAMPLES.items()), "r string, want string")
    got = df.select("r", "want", references.resolved(F.col("r"), F.lit("http://a/b/c/d;p?q")).alias("got")).collect()
    assert [(r.r, r.got) for r in got] == [(r.r, r.want) for r in got]


def test_references_are_the_librarys(spark):
    """Without a scheme the library follows the RFC too, but that it leaves dots after an authority and drops empty segments."""
    rng = random.Random(1)
    part = ["a", "..", ".", "b;p", "", "é", "c.html", "%20"]
    rows = []
    for _ in range(400):
        base = rng.choice(["https://h", "https://h/", "https://h/x/y", "https://h/x/y/?q=/z"])
        ref = rng.choice(["", "/", "//o/"]) + "/".join(rng.choice(part) for _ in range(rng.randint(1, 5))) + rng.choice(["", "?k=1", "#f", "?k#f"])
        if "//" not in ref[1:] and (not ref.startswith("//") or (ref.startswith("//o") and "." not in ref.split("?")[0].replace("c.html", ""))):
            rows.append((ref, base))
    got = spark.createDataFrame(rows, "r string, b string").select("r", "b", references.resolved(F.col("r"), F.col("b")).alias("got")).collect()
    assert [(r.r, r.b, r.got) for r in got] == [(r.r, r.b, urljoin(r.b, r.r)) for r in got]
    none = spark.createDataFrame([(None, "https://h"), ("a", None)], "r string, b string").select(references.resolved(F.col("r"), F.col("b")).alias("x")).collect()
    assert [r.x for r in none] == [None, None]


class Plain(HTMLParser):
    def __init__(self):
        super().__init__()
        self.seen = []

    def handle_starttag(self, tag, attrs):
        self.seen.append((tag, attrs))


PIECES = ["<a href=x>", "<a href='y z' download>", '<A HREF="q&amp;r">', "<a", " href=/k", ">", "</a>", "<!-- <a href=no> -->", "<!--", "-->", "<script>", "</script>", "var a = '<a href=in>';", "<meta name=d content=c>", "<base href=/b/>", "text & more", "<", "</", "<!doctype html>", "<?x?>", '"', "=", "<title>T &lt;", "</title>", "<a href>", "<a href=\"unclosed>"]


def test_tags_are_the_librarys_on_broken_pages():
    rng = random.Random(2)
    for _ in range(500):
        page = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25)))
        plain = Plain()
        plain.feed(page)
        assert [(t["tag"], t["attributes"]) for t in markup.page_tags(page)] == [(t, list(dict(a).items())) for t, a in plain.seen if t in markup.TAGS]


@pytest.mark.parametrize("piece", ["<a href=x>", "<a ", "<!-- ", "<script>", "&amp;", "< ", "<a href='", "</script ", "<p title=\"x\" "])
def test_long_pages_take_linear_time(piece):
    def took(n):
        t = time.process_time()
        markup.page_tags(piece * (n // len(piece)))
        return time.process_time() - t

    took(1000)
    assert took(5_000_000) < 20


def test_what_columns_take(spark):
    page = "<base href='/in/'><meta PROPERTY=og:image content=i.png><a href=x;p?q#f>1</a><a href=//o/y>2</a><a href='../z'>3</a><a download href=n>4</a><a>5</a><!-- <a href=c> --><script type='application/ld+json; charset=x'>{\"@type\":\"Event\",\"name\":\"a < b\"}</script><script id=__initial_state__>{\"id\":\"77\",\"text\":\"t\"}</script><script type=application/json>{broken</script>"
    df = spark.createDataFrame([(page, "https://h/p/q"), (None, "https://h/n"), ("", "https://h/e")], "h string, u string")
    assert {r.dst for r in graph.link_edges(df, F.col("u"), "h", F.col("u")).collect()} == {"https://h/in/x", "https://o/y", "https://h/z"}
    assert [r.m for r in df.select(T.meta_content(F.col("h"), "og:image").alias("m")).collect()] == ["i.png", None, None]
    assert [r.title for r in readers.jsonld_events(df, "h", "u").collect()] == ["a < b"]
    assert [(r.status_id, r.text) for r in readers.embedded_posts(df, "h").collect()] == [("77", "t")]


def test_crawl_report(spark):
    home = "https://h/"
    nodes = spark.createDataFrame([(home,), (home + "events/a/",), (home + "events/b/",), (home + "c/",)], "url string")
    edges = [(home, home + "events/a/"), (home, home + "events/a/"), (home + "events/a/", home), (home + "c/", home + "events/b/"), (home + "c/", home + "events/gone/"), (home, home + "other/gone/"), ("https://x/", home + "c/")]
    got = {(r.kind, r.value): r.n for r in graph.crawl_report(spark.createDataFrame(edges, "src string, dst string"), nodes, "url", home, ("events/",)).collect()}
    assert got == {("pages", None): 4, ("edges", None): 3, ("broken", None): 1, ("orphans", None): 1, ("unreachable", None): 2, ("depth", 0): 1, ("depth", 1): 1}


def test_tokenizer_holds_few_pages_of_a_batch():
    """A batch's pages aren't all Python objects at one time."""
    import tracemalloc

    import pyarrow as pa

    pages = pa.array([f"<title>{i}</title>" + "x" * 20_000 for i in range(2000)])
    tracemalloc.start()
    found = markup.tags.func(pages)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [f[0]["body"] for f in found.to_pylist()] == [str(i) for i in range(2000)] and peak < 10_000_000
    assert markup.tags.func(pages.slice(0, 0)).type == found.type
