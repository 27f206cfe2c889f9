"""Recurring schedules to dated events: date sequences, no driver loops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _days(templates: DataFrame, start: Column, end: Column) -> DataFrame:
    return templates.withColumn("day", F.explode(F.sequence(start, end)))


def weekly(templates: DataFrame, start: Column, end: Column) -> DataFrame:
    """templates: weekdays (array, Monday 0), interval_weeks, anchor_date (null: the window's start). Adds day."""
    anchor = F.coalesce(F.col("anchor_date"), start)
    d = _days(templates, start, end)
    return d.where(F.array_contains("weekdays", F.weekday("day")) & (F.pmod(F.floor(F.datediff("day", anchor) / 7), F.col("interval_weeks")) == 0))


def monthly_nth(templates: DataFrame, start: Column, end: Column) -> DataFrame:
    """templates: weekday (Monday 0), nth (-5 to 5, not 0). A fifth that a month lacks is left out."""
    d = _days(templates, F.trunc(start, "month"), F.last_day(end)).where(F.weekday("day") == F.col("weekday"))
    from_start = F.ceil(F.dayofmonth("day") / 7)
    from_end = -F.ceil((F.dayofmonth(F.last_day("day")) - F.dayofmonth("day") + 1) / 7)
    return d.where(F.when(F.col("nth") > 0, from_start).otherwise(from_end) == F.col("nth")).where(F.col("day").between(start, end))


def monthly_days(templates: DataFrame, start: Column, end: Column) -> DataFrame:
    """templates: days (array of days of the month); absent days are left out."""
    return _days(templates, start, end).where(F.array_contains("days", F.dayofmonth("day")))


def at_local_time(day: Column, start_time: Column, end_time: Column, zone: str = "Asia/Tokyo") -> tuple[Column, Column]:
    """UTC start and end of HH:mm local times; an end that isn't later lies on the next day."""

    def at(d: Column, hm: Column) -> Column:
        return F.to_utc_timestamp(F.to_timestamp(F.concat_ws(" ", d.cast("string"), hm), "yyyy-MM-dd HH:mm"), zone)

    return at(day, start_time), at(F.when(end_time <= start_time, F.date_add(day, 1)).otherwise(day), end_time)


FREQUENCIES = ("weekly", "monthly_nth_weekday", "monthly_days")


def materialize(templates: DataFrame, one_off: DataFrame, lower: Column, upper: Column, zone: str = "Asia/Tokyo") -> DataFrame:
    """source_id, title, starts_at, ends_at of all dates of the templates in the days from lower to upper, and the one-off events in between.

    templates: series_id, title, frequency, start_time, end_time (null without), and what the frequencies need (weekdays,
    interval_weeks, anchor_date; weekday, nth; days). one_off: source_id, title, starts_at, ends_at. Another frequency, a
    template that lacks what it needs, and a source_id that comes up twice are errors.
    """
    first, last = (F.to_date(F.from_utc_timestamp(c, zone)) for c in (lower, upper))
    wrong = templates.withColumn(
        "_w",
        F.when(~F.col("frequency").isin(*FREQUENCIES) | F.col("frequency").isNull(), "unsupported frequency")
        .when((F.col("frequency") == "weekly") & (F.coalesce(F.size("weekdays"), F.lit(0)) < 1), "no weekdays")
        .when((F.col("frequency") == "weekly") & (F.coalesce("interval_weeks", F.lit(1)) < 1), "interval_weeks")
        .when((F.col("frequency") == "monthly_nth_weekday") & (F.col("nth").isNull() | (F.col("nth") == 0) | (F.abs("nth") > 5)), "nth")
        .when((F.col("frequency") == "monthly_days") & (F.coalesce(F.size("days") < 1, F.lit(True)) | F.exists("days", lambda x: ~x.between(1, 31))), "days"),
    ).where("_w is not null").select("series_id", "_w").limit(5).collect()
    if wrong:
        raise ValueError("; ".join(f"{r.series_id}: {r['_w']}" for r in wrong))
    rows = templates.withColumn("interval_weeks", F.coalesce("interval_weeks", F.lit(1)))
    of = lambda f: rows.where(F.col("frequency") == f)
    dated = weekly(of("weekly"), first, last).unionByName(monthly_nth(of("monthly_nth_weekday"), first, last)).unionByName(monthly_days(of("monthly_days"), first, last))
    start, end = at_local_time(F.col("day"), F.col("start_time"), F.col("end_time"), zone)
    dated = dated.select(F.concat("series_id", F.lit(":"), F.col("day").cast("string")).alias("source_id"), "title", start.alias("starts_at"), F.when(F.col("end_time").isNotNull(), end).alias("ends_at"))
    out = dated.unionByName(one_off.where(F.col("starts_at").between(lower, upper)).select("source_id", "title", "starts_at", "ends_at"))
    twice = out.groupBy("source_id").count().where("count > 1").orderBy("source_id").limit(5).collect()
    if twice:
        raise ValueError("duplicate source_id: " + ", ".join(r.source_id for r in twice))
    return out


def first_per_month(rows: DataFrame, key: str) -> DataFrame:
    by = Window.partitionBy(key, F.trunc("day", "month")).orderBy("day")
    return rows.withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n")
