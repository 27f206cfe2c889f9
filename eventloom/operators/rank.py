"""Top-k, pages, rotations, neighbours, profiles and diversified ranking."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .durable import Rounds


def top_k(rows: DataFrame, group: list[str], k: int, *order: Column) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= k)


def page(rows: DataFrame, limit: int, offset: int, *order: Column) -> DataFrame:
    """A page of a total order; limit 1 to 100, offset from 0."""
    if not (1 <= limit <= 100 and offset >= 0):
        raise ValueError("limit must be 1 to 100 and offset at least 0")
    return rows.orderBy(*order).offset(offset).limit(limit)


def rotating_shard(index: Column, day: int, count: int, total: int) -> Column:
    """Whether a row belongs to the day's circular slice of `count` rows."""
    return F.pmod(index - F.lit(day * count % total), F.lit(total)) < count


def circular_next(rows: DataFrame, group: str, order: str, value: str) -> DataFrame:
    by = Window.partitionBy(group).orderBy(order)
    return rows.withColumn("next", F.coalesce(F.lead(value).over(by), F.first(value).over(by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))


def decayed_profile(views: DataFrame, user: str, feature: str | Column, weight: Column, age_days: Column, half_life: float = 28.0, oldest: float = 180.0) -> DataFrame:
    """user, feature, weight: sums of weights halved each half_life days; older views are left out."""
    return views.where(age_days <= oldest).groupBy(user, feature).agg(F.sum(weight * F.pow(F.lit(2.0), -age_days / half_life)).alias("weight"))


def cosine(profiles: DataFrame, items: DataFrame, user: str, item: str) -> DataFrame:
    """user, item, affinity of those that share a feature. Both sides: id, feature, weight."""
    un = profiles.groupBy(user).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("_un"))
    it = items.groupBy(item).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("_in"))
    i = items.select(item, "feature", F.col("weight").alias("_w"))
    dot = profiles.join(i, "feature").groupBy(user, item).agg(F.sum(F.col("weight") * F.col("_w")).alias("_dot"))
    return dot.join(un, user).join(it, item).select(user, item, F.coalesce(F.try_divide("_dot", F.col("_un") * F.col("_in")), F.lit(0.0)).alias("affinity"))


def weighted_jaccard(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: sum of minima over sum of maxima of two feature, weight tables."""
    a, b = left.select("feature", F.col("weight").alias("a")), right.select("feature", F.col("weight").alias("b"))
    j = a.join(b, "feature", "full_outer").select(F.coalesce("a", F.lit(0.0)).alias("a"), F.coalesce("b", F.lit(0.0)).alias("b"))
    return j.agg(F.coalesce(F.try_divide(F.sum(F.least("a", "b")), F.sum(F.greatest("a", "b"))), F.lit(0.0)).alias("jaccard"))


def _likeness(a: Column, b: Column) -> Column:
    """Sum of minima over sum of maxima of two maps of string to double."""
    own = lambda m, x: F.coalesce(F.element_at(m, x), F.lit(0.0))
    total = lambda of: F.aggregate(F.array_union(F.map_keys(a), F.map_keys(b)), F.lit(0.0), lambda s, x: s + of(own(a, x), own(b, x)))
    return F.coalesce(F.try_divide(total(F.least), total(F.greatest)), F.lit(0.0))


def mmr(candidates: DataFrame, user: str, k: int = 6, trade: float = 0.82) -> DataFrame:
    """user, item, rank: greedy re-ranking by trade * score - (1 - trade) * likeness to what is chosen.

    candidates: user, item (a number, once a user), score, features (map of string to double). All of a user's items
    take part: each of k rounds is an aggregate that chooses one item a user, and a join that gives the others their
    greatest likeness so far. Each round is written, so the plan doesn't grow.
    """
    rest = candidates.select(F.col(user).alias("user"), "item", "score", "features", F.lit(0.0).alias("near"))
    value = F.struct(trade * F.col("score") - (1 - trade) * F.col("near"), -F.col("item"))
    out, tables, before = None, Rounds(candidates.sparkSession), None
    for r in range(1, k + 1):
        best = tables.put(rest.groupBy("user").agg(F.max_by(F.struct("item", "features"), value).alias("best")))
        chosen = best.select("user", F.col("best.item").alias("item"), F.lit(r).alias("rank"))
        out = chosen if out is None else out.unionByName(chosen)
        if r < k:
            last = best.select(F.col("user").alias("_user"), F.col("best.item").alias("_item"), F.col("best.features").alias("_features"))
            rest = rest.join(last, F.col("user").eqNullSafe(F.col("_user"))).where("item <> _item")
            rest = tables.put(rest.select("user", "item", "score", "features", F.greatest("near", _likeness(F.col("features"), F.col("_features"))).alias("near")))
            if before is not None:
                tables.drop(before)
            before = rest
    return out


def unseen_first(candidates: DataFrame, user: str, seen: str, k: int = 6) -> DataFrame:
    """A user's unseen candidates where there are k or more, else all; what `mmr` then ranks. A null in `seen` is unseen."""
    new = ~F.coalesce(F.col(seen), F.lit(False))
    plenty = candidates.groupBy(F.col(user).alias("_user")).agg(F.count_if(new).alias("_new")).where(F.col("_new") >= k)
    df = candidates.join(plenty, F.col(user).eqNullSafe(F.col("_user")), "left")
    return df.where(F.col("_new").isNull() | new).drop("_user", "_new")


@F.arrow_udf(DoubleType())
def novelty(c: pa.Array) -> pa.Array:
    """FNV-1a (32 bit) over the first UTF-16 unit of each character, modulo 1000, in thousandths."""
    out = []
    for v in c.to_pylist():
        h = 2166136261
        for ch in v or "":
            unit = ord(ch) if ord(ch) < 0x10000 else 0xD800 + (ord(ch) - 0x10000 >> 10)
            h = (h ^ unit) * 16777619 & 0xFFFFFFFF
        out.append(h % 1000 / 1000)
    return pa.array(out, pa.float64())


def recommendation_score(affinity: Column, soon: Column, new: Column, seen: Column) -> Column:
    """With a history (affinity not null) mostly affinity, else how soon."""
    return F.when(affinity.isNotNull(), 0.83 * affinity + 0.13 * soon + 0.04 * new - 0.18 * seen).otherwise(0.82 * soon + 0.18 * new)


#: Fixed: weights of what describes an event.
FEATURE_WEIGHTS = {"group": 2.6, "organizer": 2.15, "detail": 1.45, "tag": 1.35, "format": 1.05, "audience": 0.9, "time": 0.8, "mode": 0.7, "location": 0.65, "weekday": 0.55, "source": 0.25}


def event_features(columns: dict[str, Column], tags: Column | None = None, most: int = 28) -> Column:
    """array<struct<key, weight>> of kind:value keys, at most 14 tags and 28 features; blank values are left out.

    columns: one for each kind of FEATURE_WEIGHTS but tag.
    """
    rows = [F.struct(F.concat(F.lit(f"{k}:"), F.lower(F.trim(c))).alias("key"), F.lit(FEATURE_WEIGHTS[k]).alias("weight")) for k, c in columns.items()]
    own = F.filter(F.array(*rows), lambda r: r["key"].isNotNull() & ~r["key"].rlike(":$"))
    if tags is not None:
        few = F.slice(F.array_distinct(F.transform(F.coalesce(tags, F.array().cast("array<string>")), lambda t: F.lower(F.trim(t)))), 1, 14)
        own = F.concat(own, F.transform(F.filter(few, lambda t: t != ""), lambda t: F.struct(F.concat(F.lit("tag:"), t).alias("key"), F.lit(FEATURE_WEIGHTS["tag"]).alias("weight"))))
    return F.slice(own, 1, most)


def interaction(views: Column) -> Column:
    """What opening an event so often counts."""
    return 1 + F.log2(views + 1)


def start_utility(days: Column) -> Column:
    return F.when(days.between(0, 120), 1 / (1 + days / 12)).otherwise(0.0)
