"""Weighted keyword scores, category decisions and organizer priors.

The vocabulary is a small dimension given as Python values; it becomes literals of one projection, so scoring is narrow:
no join, no shuffle, whatever the number of events.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _sum(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols, F.lit(0))


def term_score(fields: list[tuple[Column, int]], terms: list[str], base: int) -> Column:
    """For each distinct term that occurs: base and the greatest weight of the fields that have it; summed."""
    low = [(F.lower(F.coalesce(c, F.lit(""))), w) for c, w in fields]
    out = []
    for t in dict.fromkeys(x.strip().lower() for x in terms if x.strip()):
        weight = F.greatest(*(F.when(F.contains(c, F.lit(t)), w).otherwise(0) for c, w in low)) if len(low) > 1 else F.when(F.contains(low[0][0], F.lit(t)), low[0][1]).otherwise(0)
        out.append(F.when(weight > 0, base + weight).otherwise(0))
    return _sum(out)


def scores(fields: list[tuple[Column, int]], categories: list[dict], curated: Column | None = None, legacy: Column | None = None) -> Column:
    """array<struct<score, priority, id>> of the categories with a score, best first: score, priority, id."""
    rows = []
    for c in categories:
        s = term_score(fields, c.get("strong_keywords", []), 4) + term_score(fields, c.get("keywords", []), 1)
        if curated is not None:
            s = s + F.when(curated == c["id"], 100).otherwise(0)
        if legacy is not None:
            s = s + F.when(legacy == c["id"], 6).otherwise(0)
        rows.append(F.struct((-s).alias("minus"), F.lit(-int(c.get("priority", 0))).alias("rank"), F.lit(c["id"]).alias("id")))
    return F.filter(F.array_sort(F.array(*rows)), lambda r: r["minus"] < 0)


def category_decision(events: DataFrame, fields: list[tuple[Column, int]], categories: list[dict], default: str = "other", minimum: int = 3, curated: Column | None = None, legacy: Column | None = None) -> DataFrame:
    """The events with category, score, confidence, ambiguous_with (array) and decided_by."""
    df = events.withColumn("_ranked", scores(fields, [c for c in categories if c["id"] != default], curated, legacy))
    top = F.get("_ranked", F.lit(0))
    score = F.coalesce(-top["minus"], F.lit(0))
    enough = score >= minimum
    ties = F.transform(F.filter("_ranked", lambda r: (r["minus"] == top["minus"]) & (r["id"] != top["id"])), lambda r: r["id"])
    confidence = (
        F.when(~enough, F.when(score > 0, 0.35).otherwise(0.25))
        .when(score >= 100, 0.99)
        .otherwise(F.least(F.lit(0.96), 0.48 + score * 0.035, F.when(F.size(ties) > 0, 0.58).otherwise(1.0)))
    )
    return df.withColumns(
        {
            "category": F.when(enough, top["id"]).otherwise(default),
            "score": score,
            "confidence": F.round(confidence, 3),
            "ambiguous_with": F.when(enough, ties).otherwise(F.array().cast("array<string>")),
            "decided_by": F.when(~enough, "fallback").when(score >= 100, "curated_ontology").otherwise("keyword_rules"),
        }
    ).drop("_ranked")


def _term_evidence(fields: list[tuple[str, Column, int]], terms: list[str]) -> list[Column]:
    """For each distinct term: keyword:field:term of the weightiest field that has it, or null."""
    low = [(name, F.lower(F.coalesce(c, F.lit("")))) for name, c, _ in sorted(fields, key=lambda f: -f[2])]
    out, seen = [], set()
    for term in terms:
        t = term.strip().lower()
        if t and t not in seen:
            seen.add(t)
            out.append(F.coalesce(*(F.when(F.contains(c, F.lit(t)), F.lit(f"keyword:{name}:{t}")) for name, c in low)))
    return out


def decision_evidence(category: Column, fields: list[tuple[str, Column, int]], categories: list[dict], legacy: dict[str, str] | None = None, raw: Column | None = None, most: int = 12) -> Column:
    """What speaks for a row's category: its legacy name, then strong and plain keywords with the field; at most `most`, as shown to readers."""
    out = F.array().cast("array<string>")
    for c in categories:
        known = [F.when(raw == name, F.lit(f"legacy_category:{name}")) for name, to in (legacy or {}).items() if to == c["id"]] if raw is not None else []
        found = F.array_compact(F.array(*known, *_term_evidence(fields, c.get("strong_keywords", [])), *_term_evidence(fields, c.get("keywords", []))))
        out = F.when(category == c["id"], F.slice(found, 1, most)).otherwise(out)
    return out


def subcategory(category: Column, fields: list[tuple[Column, int]], categories: list[dict]) -> Column:
    """The category's subcategory of the greatest score, the first of equals; null where none scores."""
    out = F.lit(None).cast("string")
    for c in categories:
        best = F.lit(None).cast("struct<score:int,minus:int,id:string>")
        for i, (sub, terms) in enumerate(c.get("subcategories", {}).items()):
            score = term_score(fields, terms, 1).cast("int")
            best = F.greatest(best, F.when(score > 0, F.struct(score.alias("score"), F.lit(-i).alias("minus"), F.lit(sub).alias("id"))))
        out = F.when(category == c["id"], best["id"]).otherwise(out)
    return out


def attach_decision(events: DataFrame, previous: Column, neutral: str = "event") -> DataFrame:
    """The events with legacy_category (the category before, if another and not the neutral one) and review_required (a tie)."""
    was = F.nullif(F.trim(previous), F.lit(""))
    return events.withColumns({"legacy_category": F.when((was != F.col("category")) & (was != neutral), was), "review_required": F.size("ambiguous_with") > 0})


def organizer_prior(rows: DataFrame, organizer: str, category: str, order: str, minimum: int = 2, dominance: float = 0.75) -> DataFrame:
    """organizer, category, seed_events, classified, dominance of organizers with a dominant category; ties: seen first."""
    per = rows.where(F.col(organizer).isNotNull()).groupBy(organizer, category).agg(F.count("*").alias("seed_events"), F.min(order).alias("_first"))
    by = Window.partitionBy(organizer)
    ranked = per.withColumns({"classified": F.sum("seed_events").over(by), "_n": F.row_number().over(by.orderBy(F.desc("seed_events"), "_first"))})
    out = ranked.where("_n = 1").withColumn("dominance", F.col("seed_events") / F.col("classified"))
    return out.where((F.col("seed_events") >= minimum) & (F.col("dominance") >= dominance)).select(organizer, category, "seed_events", "classified", "dominance")


def apply_prior(events: DataFrame, prior: DataFrame, organizer: str, max_direct: int) -> DataFrame:
    """Events of a weak score take their organizer's dominant category."""
    p = prior.select(F.col(organizer).alias("_o"), F.col("category").alias("_c"))
    df = events.join(p, events[organizer] == p["_o"], "left")
    weak = F.col("_c").isNotNull() & (F.col("score") <= max_direct)
    return df.withColumns({"category": F.when(weak, F.col("_c")).otherwise(F.col("category")), "decided_by": F.when(weak, "organizer_prior").otherwise(F.col("decided_by"))}).drop("_o", "_c")


def term_vocabulary(rows: DataFrame, text: str, row_id: str, terms: list[str], examples: int = 5) -> DataFrame:
    """term, matches, example ids (the smallest): all terms, those without a match too."""
    hit = rows.select(F.col(row_id).alias("id"), F.explode(F.filter(F.array(*(F.lit(t) for t in terms)), lambda t: F.contains(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lower(t)))).alias("term"))
    by = Window.partitionBy("term").orderBy("id")
    first = hit.withColumn("_n", F.row_number().over(by)).where(F.col("_n") <= examples).groupBy("term").agg(F.array_sort(F.collect_list("id")).alias("examples"))
    counts = hit.groupBy("term").agg(F.count("*").alias("matches"))
    every = rows.sparkSession.createDataFrame([(t,) for t in terms], "term string")
    return every.join(counts, "term", "left").join(first, "term", "left").select("term", F.coalesce("matches", F.lit(0)).cast("long").alias("matches"), F.coalesce("examples", F.array().cast("array<bigint>")).alias("examples"))
