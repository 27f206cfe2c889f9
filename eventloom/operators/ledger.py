"""The candidate ledger: keyed state, merged, kept for a time, judged again under new rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import times
from . import rules


def reevaluate(history: DataFrame, now: Column, rule_set: rules.RuleSet, known_ids: DataFrame | None = None) -> DataFrame:
    """The whole ledger judged again: dates in a text count from when it was posted, the last gates from now.

    history: status_id, text, retweet_count, first_seen (timestamp). Adds source_created_at, category, starts_at,
    last_decision, last_reason. One projection; only known ids are joined.
    """
    created = times.snowflake_time(F.col("status_id"))
    df = history.withColumn("source_created_at", F.when(created <= now + F.expr("interval 1 day"), created))
    df = df.withColumn("_anchor", F.coalesce("source_created_at", "first_seen", now))
    out = rules.accept_or_reject(df, F.col("_anchor"), rule_set, known_ids)
    late = F.when(F.col("accepted") & (F.col("starts_at") < now - F.expr("interval 12 hours")), "past_event_now").when(F.col("accepted") & (F.col("starts_at") > now + F.expr("interval 180 days")), "too_far_future_now")
    out = out.withColumn("last_reason", F.coalesce(late, "reason"))
    return out.withColumn("last_decision", F.when(F.col("last_reason").isNull(), "accepted").otherwise("rejected")).drop("_anchor", "reason", "accepted")


def archive(history: DataFrame, now: Column, rule_set: rules.RuleSet) -> DataFrame:
    """The archive policy: a text with few retweets counts as having the floor, past events are accepted and marked."""
    floor = F.greatest(F.coalesce(F.col("retweet_count").try_cast("long"), F.lit(0)), F.lit(rule_set.min_retweets))
    out = reevaluate(history.withColumn("retweet_count", floor), now, rule_set)
    past = F.col("last_reason").isin("past_event_now", "past_event")
    out = out.withColumns({"last_decision": F.when(past, "accepted").otherwise(F.col("last_decision")), "last_reason": F.when(~past, F.col("last_reason"))})
    return out.withColumns({"temporal_status": rules.archive_status(F.col("starts_at"), now), "is_archived": F.coalesce(F.col("starts_at") < now, F.lit(False))})


def merge(old: DataFrame, new: DataFrame, key: str = "status_id") -> DataFrame:
    """Full outer merge: first_seen from the old row, last_seen and text from the new, counts summed, greatest retweets, keys united.

    Both sides: key, text, first_seen, last_seen, retweets, observations, query_keys.
    """
    o, n = (d.select(F.col(key), *(F.col(c).alias(f"{p}_{c}") for c in ("text", "first_seen", "last_seen", "retweets", "observations", "query_keys"))) for p, d in (("o", old), ("n", new)))
    empty = F.array().cast("array<string>")
    return o.join(n, key, "full_outer").select(
        key,
        F.coalesce("n_text", "o_text").alias("text"),
        F.least("o_first_seen", "n_first_seen").alias("first_seen"),
        F.greatest("o_last_seen", "n_last_seen").alias("last_seen"),
        F.greatest("o_retweets", "n_retweets").alias("retweets"),
        (F.coalesce("o_observations", F.lit(0)) + F.coalesce("n_observations", F.lit(0))).alias("observations"),
        F.array_sort(F.array_union(F.coalesce("o_query_keys", empty), F.coalesce("n_query_keys", empty))).alias("query_keys"),
    )


def retained(rows: DataFrame, now: Column, days: int) -> DataFrame:
    return rows.where(F.col("last_seen") >= now - F.expr(f"interval {days} days"))


def capped(rows: DataFrame, count: int, key: str = "status_id") -> DataFrame:
    """The rows seen last; a top-k, not a sort of everything."""
    return rows.orderBy(F.desc("last_seen"), F.desc(key)).limit(count)


def changed(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """key, before, after of rows in both whose value isn't the same (nulls alike)."""
    o, n = old.select(key, F.col(value).alias("before")), new.select(key, F.col(value).alias("after"))
    return o.join(n, key).where(~F.col("before").eqNullSafe(F.col("after")))


def resolution_audit(previous: DataFrame, current: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """How dates were resolved: (counts in one row, events by method, events of both sides whose start changed).

    Both sides: source_id (once a side), starts_at; current also date_resolution_method, _anchor and _evidence.
    """
    method = F.coalesce(F.nullif(F.col("date_resolution_method"), F.lit("")), F.lit("missing"))
    methods = current.groupBy(method.alias("method")).agg(F.count("*").alias("n"))
    known = lambda df: df.where(F.coalesce(F.col("source_id").cast("string"), F.lit("")) != "")
    moved = changed(known(previous), known(current), "source_id", "starts_at")
    moved = moved.join(known(current).select("source_id", "date_resolution_method", "date_resolution_anchor"), "source_id")
    seen = current.agg(F.count("*").alias("current"), F.count_if(F.coalesce(F.col("date_resolution_evidence"), F.lit("")) != "").alias("with_evidence"))
    counts = previous.agg(F.count("*").alias("previous")).crossJoin(seen).crossJoin(moved.agg(F.count("*").alias("changed")))  # one row each
    return counts, methods, moved


def transitions(old: DataFrame, new: DataFrame, key: str, decision: str) -> DataFrame:
    """transition ('old->new', '' where missing), n over the new rows."""
    o = old.select(key, F.col(decision).alias("_old"))
    n = new.select(key, F.col(decision).alias("_new"))
    named = F.concat(F.coalesce("_old", F.lit("")), F.lit("->"), F.coalesce("_new", F.lit("")))
    return n.join(o, key, "left").groupBy(named.alias("transition")).agg(F.count("*").alias("n"))


def review_queue(rows: DataFrame, resolved: DataFrame, previous: DataFrame, key: str, now: Column) -> DataFrame:
    """Rows without a resolution; first_queued_at survives from the previous queue."""
    p = previous.select(key, F.col("first_queued_at").alias("_first"))
    return rows.join(resolved.select(key).distinct(), key, "left_anti").join(p, key, "left").withColumn("first_queued_at", F.coalesce("_first", now)).drop("_first")


def widely_shared_rejections(rows: DataFrame, least: int = 3, excerpt: int = 360) -> DataFrame:
    """Rejected rows with so many retweets: status_id, reason, retweet_count, text_excerpt."""
    count = F.coalesce(F.nullif(F.col("max_retweet_count"), F.lit(0)), F.col("retweet_count"), F.lit(0)).cast("long")
    return rows.where((F.col("last_decision") == "rejected") & (count >= least)).select("status_id", F.col("last_reason").alias("reason"), count.alias("retweet_count"), F.left(F.coalesce("text", F.lit("")), F.lit(excerpt)).alias("text_excerpt"))
