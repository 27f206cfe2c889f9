"""Counts, rates and deltas. All are hash aggregates with partial sums; order is only imposed on small results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Z95 = 1.959963984540054


def wilson_lower(successes: Column, total: Column, z: float = Z95) -> Column:
    n, p = total.cast("double"), successes / total
    margin = z * F.sqrt((p * (1 - p) + z * z / (4 * n)) / n)
    return F.when(total <= 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), (p + z * z / (2 * n) - margin) / (1 + z * z / n)))


def expert_model(hits: DataFrame, expert: str, row_id: str, accepted: str) -> DataFrame:
    """expert, support, accepted, precision, wilson: hits has one row for each expert that a candidate matched."""
    per = hits.groupBy(expert).agg(F.count("*").alias("support"), F.sum(F.col(accepted).cast("int")).alias("accepted"))
    return per.withColumns({"precision": F.col("accepted") / F.col("support"), "wilson": wilson_lower(F.col("accepted"), F.col("support"))})


def with_tiers(model: DataFrame, support: int = 20, accepted: int = 2, least: float = 0.05) -> DataFrame:
    """The expert model with eligible and tier (precision, balanced, recall; exploration where not eligible), by its Wilson bound."""
    eligible = (F.col("support") >= support) & (F.col("accepted") >= accepted) & (F.col("wilson") >= least)
    tier = F.when(~eligible, "exploration").when(F.col("wilson") >= 0.15, "precision").when(F.col("wilson") >= 0.08, "balanced").otherwise("recall")
    return model.withColumns({"eligible": eligible, "tier": tier})


def top_reasons(hits: DataFrame, expert: str, reason: Column, k: int = 5) -> DataFrame:
    """expert, reasons: its k most frequent reasons as reason:count, `accepted` where there is none; ties by name."""
    per = hits.groupBy(expert, F.coalesce(F.nullif(reason, F.lit("")), F.lit("accepted")).alias("_r")).agg(F.count("*").alias("_n"))
    first = per.withColumn("_k", F.row_number().over(Window.partitionBy(expert).orderBy(F.desc("_n"), "_r"))).where(F.col("_k") <= k)
    row = F.struct("_k", F.concat_ws(":", "_r", F.col("_n").cast("string")).alias("text"))
    return first.groupBy(expert).agg(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["text"]).alias("reasons"))


def leave_one_out(hits: DataFrame, expert: str, row_id: str, accepted: str) -> DataFrame:
    """expert, unique_accepted: accepted rows that no other expert matched."""
    by = Window.partitionBy(row_id)
    only = hits.where(F.col(accepted)).withColumn("_n", F.count("*").over(by))
    return hits.select(expert).distinct().join(only.where("_n = 1").groupBy(expert).agg(F.count("*").alias("unique_accepted")), expert, "left").select(expert, F.coalesce("unique_accepted", F.lit(0)).cast("long").alias("unique_accepted"))


def set_overlap(members: DataFrame, name: str, item: str) -> DataFrame:
    """left, right, overlap, jaccard of each two named sets that share an item, left before right."""
    m = members.select(name, item).distinct()
    size = m.groupBy(name).agg(F.count("*").alias("size"))
    a, b = m.select(F.col(name).alias("left"), F.col(item).alias("_i")), m.select(F.col(name).alias("right"), F.col(item).alias("_i"))
    both = a.join(b, "_i").where(F.col("left") < F.col("right")).groupBy("left", "right").agg(F.count("*").alias("overlap"))
    ls, rs = size.select(F.col(name).alias("left"), F.col("size").alias("_ls")), size.select(F.col(name).alias("right"), F.col("size").alias("_rs"))
    return both.join(ls, "left").join(rs, "right").select("left", "right", "overlap", (F.col("overlap") / (F.col("_ls") + F.col("_rs") - F.col("overlap"))).alias("jaccard"))


def facets(rows: DataFrame, fields: list[str]) -> DataFrame:
    """field, value, n: one scan for all fields; nulls are left out."""
    long = rows.select(*(F.col(f).cast("string").alias(f) for f in fields)).unpivot([], fields, "field", "value")
    return long.where(F.col("value").isNotNull()).groupBy("field", "value").agg(F.count("*").alias("n"))


def dominant(rows: DataFrame, group: str, value: str) -> DataFrame:
    """group, value, n, share of the most frequent value; ties go to the smaller value."""
    per = rows.where(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(group, value).agg(F.count("*").alias("n"))
    by = Window.partitionBy(group)
    return per.withColumns({"share": F.round(F.col("n") / F.sum("n").over(by), 3), "_k": F.row_number().over(by.orderBy(F.desc("n"), value))}).where("_k = 1").drop("_k")


def compare_periods(current: DataFrame, previous: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Full outer join on keys; for each measure current, previous (0 if missing), delta and relative change (null if previous is 0)."""
    c = current.select(*keys, *(F.col(m).alias(f"c_{m}") for m in measures))
    p = previous.select(*keys, *(F.col(m).alias(f"p_{m}") for m in measures))
    out = [F.col(k) for k in keys]
    for m in measures:
        a, b = F.coalesce(F.col(f"c_{m}"), F.lit(0)), F.coalesce(F.col(f"p_{m}"), F.lit(0))
        out += [a.alias(m), b.alias(f"{m}_before"), (a - b).alias(f"{m}_delta"), F.try_divide((a - b).cast("double"), b.cast("double")).alias(f"{m}_change")]
    return c.join(p, keys, "full_outer").select(*out)


def rate_gap(rows: DataFrame, band: Column, hits: str, shown: str, least: float) -> DataFrame:
    """Rows below their band's rate with enough shown: band, benchmark, missed hits. Bands are few: partial sums, then a small join."""
    df = rows.withColumn("band", band)
    bench = df.groupBy("band").agg(F.try_divide(F.sum(hits).cast("double"), F.sum(shown).cast("double")).alias("benchmark"))
    df = df.join(bench, "band").withColumn("rate", F.try_divide(F.col(hits).cast("double"), F.col(shown).cast("double")))
    return df.where((F.col("rate") < F.col("benchmark")) & (F.col(shown) >= least)).withColumn("missed", (F.col("benchmark") - F.col("rate")) * F.col(shown))


def deltas(snapshots: DataFrame, order: str, measures: list[str], keep: int) -> DataFrame:
    """Each snapshot's measures less the one before; the last `keep`. Snapshots are few (one a run), so one window serves."""
    by = Window.orderBy(order)
    df = snapshots.withColumns({f"{m}_delta": F.col(m) - F.lag(m).over(by) for m in measures})
    return df.orderBy(F.desc(order)).limit(keep)


#: What a run's snapshot counts besides the sources.
SNAPSHOT = ("calendar_event_count", "normalized_event_count", "yahoo_candidate_count", "yahoo_accepted_count", "yahoo_rejected_count", "yahoo_unique_candidates_this_run", "yahoo_queries_succeeded", "yahoo_queries_failed")


def registration_snapshots(runs: DataFrame, sources: DataFrame, keep: int) -> tuple[DataFrame, DataFrame]:
    """(the last `keep` runs with the deltas of their counts, each source's count in those runs with its delta).

    runs: generated_at and SNAPSHOT; what a run hasn't counts 0, but normalized_event_count is then the calendar's count.
    sources: generated_at, name, count. A source that one of two runs lacks counts 0 there; the first run has no delta.
    """
    filled = runs.withColumns({c: F.coalesce(F.col(c), F.col("calendar_event_count") if c == "normalized_event_count" else F.lit(0)).cast("long") for c in SNAPSHOT})
    kept = deltas(filled, "generated_at", list(SNAPSHOT), keep)
    step = filled.select("generated_at", F.lag("generated_at").over(Window.orderBy("generated_at")).alias("_before"))  # one row a run
    pair = step.where("_before is not null")
    s = sources.groupBy("generated_at", "name").agg(F.sum("count").alias("count"))
    now = s.join(pair, "generated_at").select("generated_at", "name", F.col("count").alias("now"), F.lit(0).cast("long").alias("before"))
    then = pair.join(s.withColumnRenamed("generated_at", "_before"), "_before").select("generated_at", "name", F.lit(0).cast("long").alias("now"), F.col("count").alias("before"))
    both = now.unionByName(then).groupBy("generated_at", "name").agg(F.sum("now").alias("count"), (F.sum("now") - F.sum("before")).alias("delta"))
    first = s.join(step.where("_before is null"), "generated_at").select("generated_at", "name", "count", F.lit(None).cast("long").alias("delta"))
    return kept, both.unionByName(first).join(kept.select("generated_at"), "generated_at", "left_semi")


def health(rows: DataFrame, status: str) -> DataFrame:
    """One row: sources, failed, status (ok, degraded or error)."""
    failed = F.count_if(F.col(status) == "error")
    return rows.agg(F.count("*").alias("sources"), failed.alias("failed")).withColumn("status", F.when(F.col("failed") == 0, "ok").when(F.col("failed") < F.col("sources"), "degraded").otherwise("error"))


def ensemble_coverage(hits: DataFrame, row_id: str, accepted: str, total: int | Column) -> DataFrame:
    return hits.where(F.col(accepted)).agg(F.count_distinct(row_id).alias("covered")).withColumn("coverage", F.try_divide(F.col("covered").cast("double"), F.lit(total).cast("double")))
