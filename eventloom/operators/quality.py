"""Gates and audits: error rows by code, and checks that must run as actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def feed_audit(rows: DataFrame, row: str, identity: Column, title: Column, starts_at: Column, url: Column) -> DataFrame:
    """row, code: missing_identity, missing_title, invalid_datetime, invalid_url, duplicate_identity. One scan but for duplicates."""
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    codes = F.array_compact(
        F.array(
            F.when(blank(identity), "missing_identity"),
            F.when(blank(title), "missing_title"),
            F.when(~blank(starts_at) & F.try_to_timestamp(starts_at).isNull(), "invalid_datetime"),
            F.when(~blank(url) & ~url.rlike(r"^https?://[^/\s]+"), "invalid_url"),
        )
    )
    single = rows.select(F.col(row), F.explode(codes).alias("code"))
    known = rows.select(F.col(row), identity.alias("_id")).where(~blank(F.col("_id")))
    twice = known.groupBy("_id").agg(F.min(row).alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    return single.unionByName(known.join(twice, "_id").where(F.col(row) > F.col("_first")).select(row, F.lit("duplicate_identity").alias("code")))


def indexable(row_id: Column, title: Column, starts_at: Column, links: Column, review: Column, finished: Column) -> Column:
    ok = row_id.rlike(r"^[A-Za-z0-9_-]+$") & (F.coalesce(title, F.lit("")) != "") & starts_at.isNotNull() & (F.size(links) > 0) & ~review & ~finished
    return F.coalesce(ok, F.lit(False))


def require_unique(rows: DataFrame, key: str) -> None:
    """Raises ValueError if a key is null, blank or repeated. An action, so it can't be optimized away."""
    k = F.coalesce(F.col(key).cast("string"), F.lit(""))
    if not rows.where(k == "").isEmpty() or not rows.groupBy(key).count().where("count > 1").isEmpty():
        raise ValueError(f"{key} must be filled and unique")


def null_out_failed(rows: DataFrame, url: str, probes: DataFrame, of: tuple[str, ...] = ()) -> DataFrame:
    """Addresses whose probe failed become null; unprobed ones stay. probes: url, ok.

    of: columns of both that tell whose address was probed; a probe then counts for those rows only, not for all that have the address.
    """
    p = probes.groupBy(*(F.col(c).alias(f"_of_{c}") for c in of), F.col("url").alias("_u")).agg(F.bool_and("ok").alias("_ok"))
    same = rows[url] == p["_u"]
    for c in of:
        same = same & (rows[c] == p[f"_of_{c}"])
    df = rows.join(p, same, "left")
    return df.withColumn(url, F.when(F.coalesce(F.col("_ok"), F.lit(True)), F.col(url))).drop("_u", "_ok", *(f"_of_{c}" for c in of))
