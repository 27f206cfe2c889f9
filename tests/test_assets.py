"""Assets, lists and gates on small cases: nulls, blanks, repeated rows, empty tables."""

import pytest
from pyspark.sql import functions as F

from eventloom.operators import assets, publish, rank, resolve

LINKS = f"array<{assets.LINK}>"


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("url", "profile", "want"),
    [
        ("https://PBS.twimg.com/media/a.jpg", False, "https://pbs.twimg.com/media/a.jpg?format=webp&name=small"),
        ("https://pbs.twimg.com/p/a_bigger.jpg?name=x&v=1#f", True, "https://pbs.twimg.com/p/a.jpg?name=200x200&v=1&format=webp"),
        ("https://cdn.example/A.WEBP", False, "https://cdn.example/A.WEBP"),
        ("https://cdn.example/a.png", False, None),
        ("http://pbs.twimg.com/a.jpg", False, None),
        ("", False, None),
        (None, False, None),
    ],
)
def test_webp(spark, url, profile, want):
    assert one(spark, assets.webp(F.lit(url).cast("string"), profile)) == want


@pytest.mark.parametrize("payload", [None, "", "[]", "no json", '{"mediaDetails": 3, "user": null, "photos": [null, {"url": null}]}'])
def test_payload_without_assets(spark, payload):
    got = one(spark, assets.from_payload(F.lit(payload).cast("string"), F.lit("h")))
    assert (got["image_url"], got["image_kind"], got["official_website_url"], got["official_x_url"]) == (None, None, None, "https://x.com/h")


def test_links_are_six_at_most_and_each_once(spark):
    own = [(f"https://l.example/{i}", "L", "k", "e") for i in range(5)] + [("http://plain.example", "L", "k", "e")]
    rows = [("a", "https://x.com/u/status/7", None, own, None), ("b", None, None, None, None), ("c", "https://x.com/u", "@u", None, None)]
    e = spark.createDataFrame(rows, f"id string, url string, organizer string, official_links {LINKS}, image_url string")
    cache = spark.createDataFrame([("7", "{}"), ("7", "{}"), (None, "{}")], "status_id string, p string").select("status_id", assets.from_payload(F.col("p"), F.lit("u")).alias("assets"))
    got = {r["id"]: r for r in assets.with_assets(e, cache).collect()}
    assert len(got) == 3
    assert [x["url"] for x in got["a"]["official_links"]] == [f"https://l.example/{i}" for i in range(5)] + ["https://x.com/u/status/7"]
    assert got["a"]["asset_evidence"] == assets.EVIDENCE
    assert (got["b"]["official_links"], got["b"]["asset_status"], got["b"]["asset_evidence"]) == ([], "unresolved", None)
    assert [x["kind"] for x in got["c"]["official_links"]] == ["announcement"]
    assert assets.with_assets(e.limit(0), cache).count() == 0


def test_sanitized_without_events_or_probes(spark):
    e = spark.createDataFrame([("a", "https://i.example/1", "k"), ("b", None, None), ("c", "http://i.example/1", "k")], "id string, image_url string, image_kind string")
    none = spark.createDataFrame([], "url string, ok boolean, reason string")
    got = {r["id"]: (r["image_url"], r["image_kind"]) for r in assets.sanitized(e, "id", none).collect()}
    assert got == {"a": (None, None), "b": (None, None), "c": ("http://i.example/1", "k")}
    assert {r["what"]: r["n"] for r in assets.image_audit(e, "id", none).collect()} == {"checked": 1, "failed": 1, "failed:not_checked": 1, "events_degraded": 1, "stripped_fields": 1}
    assert {r["what"]: r["n"] for r in assets.image_audit(e.limit(0), "id", none).collect()} == {"events_degraded": 0, "stripped_fields": 0}


def test_series_links(spark):
    rows = [("", " https://a.example/1 ", None), ("x", "https://a.example/1", "k"), ("y", "http://a.example", "k")] + [("z", f"https://b.example/{i}", "k") for i in range(9)]
    df = spark.createDataFrame([(rows,), (None,)], "links array<struct<label:string,url:string,kind:string>>").select(publish.series_links(F.col("links")).alias("v"))
    full, empty = (r["v"] for r in df.collect())
    assert full[0] == ("https://a.example/1", "公式情報", "official") and len(full) == 8 and empty == []


def test_health_gate(spark):
    h = spark.createDataFrame([("a", "ok"), ("b", "ok"), ("b", None)], "name string, status string")
    publish.require_healthy(h, ["a"])
    for names in (["b"], ["a", "missing"]):
        with pytest.raises(ValueError, match="not healthy"):
            publish.require_healthy(h, names)


def test_published_health(spark):
    h = spark.createDataFrame([("a", 9), ("b", 4)], "name string, event_count long")
    p = spark.createDataFrame([("a", 5), ("a", 2)], "name string, n long")
    got = {r["name"]: (r["event_count"], r["normalized_event_count"]) for r in publish.published_health(publish.published_health(h, p), p).collect()}
    assert got == {"a": (7, 9), "b": (0, 4)}


def test_unseen_first_with_null_user(spark):
    rows = [(None, i, False) for i in range(3)] + [(None, 9, True), ("u", 1, True), ("u", 2, None)]
    df = spark.createDataFrame(rows, "user string, item long, seen boolean")
    got = sorted((r["user"] or "", r["item"]) for r in rank.unseen_first(df, "user", "seen", 3).collect())
    assert got == [("", 0), ("", 1), ("", 2), ("u", 1), ("u", 2)]


def test_ambiguous_pairs(spark):
    import difflib

    rows = [("a", "t", "o", "", "red lantern night"), ("b", "t", "o", "", "red lamp light"), ("c", "t", "o", "", "red lantern nights"), ("d", "t", "p", "", "red lamp light"), ("e", "t", "o", "", None)]
    e = spark.createDataFrame(rows, "id string, starts_at string, organizer string, description string, title string").withColumn("url", F.lit(None).cast("string"))
    key = {r[0]: (r[4] or "").replace(" ", "") for r in rows}
    like = {(x, y): difflib.SequenceMatcher(None, key[x], key[y], autojunk=False).ratio() for x, y in (("a", "b"), ("a", "c"), ("b", "c"))}
    want = {p: round(s, 4) for p, s in like.items() if 0.45 <= s < 0.75}
    assert want and ("a", "c") not in want
    assert {(r["a"], r["b"]): r["similarity"] for r in resolve.ambiguous_pairs(e).collect()} == want
    assert resolve.ambiguous_pairs(e.withColumn("url", F.lit("https://one.example/x"))).isEmpty()
