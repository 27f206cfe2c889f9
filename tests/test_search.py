"""Search analytics, query plans, features."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from eventloom.operators import rank, rules, search


def test_growth(spark):
    schema = "keys array<string>, clicks double, impressions double, position double, o int"
    cur = spark.createDataFrame([(["a", "/x"], 2.0, 100.0, 5.0, 1), (["b", "/x"], 10.0, 100.0, 6.0, 2), (["me@mail.example", "/x"], 1.0, 1.0, 1.0, 3), (["a"], 1.0, 1.0, 1.0, 4)], schema)
    prev = spark.createDataFrame([(["a", "/x"], 1.0, 50.0, 5.5, 1)], schema)
    c, left_out = search.pair_rows(cur, "o")
    assert left_out.first().redacted == 1
    got = {r["query"]: r for r in search.growth(c, search.pair_rows(prev, "o")[0], ["A"]).collect()}
    assert got["a"].missed == pytest.approx(4.0) and got["a"].band == "4-10" and got["a"].clicks_delta == 1.0 and got["a"].brand
    assert got["b"].missed is None and got["b"].clicks_change is None


def test_windows(spark):
    assert search.windows(date(2026, 8, 14), 28) == (date(2026, 6, 20), date(2026, 7, 17), date(2026, 7, 18), date(2026, 8, 14))
    with pytest.raises(ValueError):
        search.windows(date(2026, 8, 14), 0)
    df = spark.createDataFrame([("2026-07-18",), ("x",), ("2026-08-15",)], "d string")
    assert [r.d for r in df.where(search.in_window(F.col("d"), date(2026, 7, 18), date(2026, 8, 14))).collect()] == ["2026-07-18"]


def test_plans(spark):
    g = spark.createDataFrame([(0, "core", ["Song", "song", ""]), (1, "recruitment", ["staff"])], "ord int, group string, terms array<string>")
    got = {r.key: r["query"] for r in search.plan(g, 2).collect()}
    assert set(got) == {"core-000-song", "recruitment-000-staff"} and got["recruitment-000-staff"] == f"(staff) {search.RECRUITING} {search.PLATFORM}"
    with pytest.raises(ValueError):
        search.plan(g)
    v = search.ablation_plan({"a": "x", "b": "y"}, [{"key": "full", "blocks": ["a", "b"]}, {"key": "one", "blocks": ["a"]}], "full")
    assert [x["query"] for x in v] == ["x y", "x"]
    with pytest.raises(ValueError):
        search.ablation_plan({"a": "x"}, [{"key": "k", "blocks": ["z"]}], "k")


def test_targets_and_entities(spark):
    rows = spark.createDataFrame([("1", ["b"], 5), ("2", ["b", "a"], 1), ("3", [], 9), ("4", ["b"], 7)], "status_id string, query_keys array<string>, retweet_count int")
    order = spark.createDataFrame([("a", 0), ("b", 1)], "key string, index int")
    assert [r.status_id for r in search.exact_target(rows, order, 3).collect()] == ["2", "4", "1"]
    e = spark.createDataFrame([("1", "t", "c", "https://x.com/A/", "o", "2026"), ("2", "u", "c", "https://x.com/a", "p", "2027"), ("3", "v", None, None, " Org ", "2026"), ("4", "w", None, None, None, "2026")], "id string, title string, category string, official_x_url string, organizer string, starts_at string")
    got = {r.entity: r for r in search.observed_entities(e).collect()}
    assert got["https://x.com/a"].n == 2 and got["https://x.com/a"].sample_ids == ["1", "2"] and got["https://x.com/a"].categories == {"c": 2} and "org" in got and len(got) == 2
    m = spark.createDataFrame([("e", "2026", {"s": 2, "z": 0}), ("f", "2027", {"s": 1})], "entity string, latest string, matched map<string,bigint>")
    assert [(r.series, r.n, r.latest) for r in search.observation_counts(m).collect()] == [("s", 3, "2027")]
    with pytest.raises(ValueError):
        search.observation_counts(spark.createDataFrame([("e", "2026", {"s": 2, "z": 1})], "entity string, latest string, matched map<string,bigint>"))


def test_variants(spark):
    found = spark.createDataFrame([("full", "1"), ("full", "2"), ("one", "2")], "variant string, status_id string")
    got = {r.variant: (r.candidates, r.accepted, r.new_to_ledger, r.acceptance_rate) for r in search.variant_metrics(found, spark.createDataFrame([("1",)], "status_id string"), spark.createDataFrame([("2",)], "status_id string")).collect()}
    assert got == {"full": (2, 1, 1, 0.5), "one": (1, 0, 0, 0.0)}


def test_features_and_scores(spark):
    f = rank.event_features({"group": F.lit("Music"), "organizer": F.lit(None).cast("string"), "source": F.lit(" ")}, F.array(F.lit("A"), F.lit("a"), F.lit("b")))
    r = spark.range(1).select(f.alias("f"), rank.novelty(F.lit("abc")).alias("n"), rank.start_utility(F.lit(12.0)).alias("u"), rank.recommendation_score(F.lit(None).cast("double"), F.lit(1.0), F.lit(1.0), F.lit(0)).alias("s")).first()
    assert [(x.key, x.weight) for x in r.f] == [("group:music", 2.6), ("tag:a", 1.35), ("tag:b", 1.35)]
    assert r.n == 0x1A47E90B % 1000 / 1000 and r.u == 0.5 and r.s == pytest.approx(1.0)


def test_simple_rules(spark):
    rows = [(1, "VRChat イベント"), (2, "イベント"), (3, "VRChat プレゼント"), (4, "VRChat 商品 発売"), (5, "VRChat 募集 締切"), (6, "VRChat だけ"), (7, "VRChat 商品 募集 テスター")]
    c, why = rules.simple(F.col("t"), rules.RuleSet())
    got = {r.i: r.c or r.w for r in spark.createDataFrame(rows, "i int, t string").select("i", c.alias("c"), why.alias("w")).collect()}
    assert got == {1: "event", 2: "not_vrchat", 3: "giveaway_only", 4: "product_only", 5: "recruitment_deadline", 6: "missing_event_marker", 7: "recruitment_deadline"}
