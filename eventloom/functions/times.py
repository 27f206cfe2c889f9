"""Instants, local dates and dates written in text. Session time zone: UTC; local: Asia/Tokyo unless given."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import FULL_DIGITS, width_folded

TOKYO = "Asia/Tokyo"
#: Fixed: milliseconds of the first snowflake id.
SNOWFLAKE_EPOCH = 1288834974657
_CLOCK = r"([01]?[0-9]|2[0-3])(?:[:時]([0-9]{2})?)"
_DAY_MARK = r"日?(?:\s*[（(]?[月火水木金土日][）)]?)?"
WEEKDAYS = "月火水木金土日"


def parse_instant(c: Column, default_zone: str) -> Column:
    """ISO text as an instant; without an offset it is local time in default_zone; unreadable is null."""
    text = F.trim(c)
    zoned = text.rlike(r"(?:Z|[+-][0-9]{2}:?[0-9]{2})$")
    return F.when(zoned, F.try_to_timestamp(text)).otherwise(F.to_utc_timestamp(F.try_to_timestamp(text), default_zone))


def iso_z(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def local(c: Column, zone: str = TOKYO) -> Column:
    return F.from_utc_timestamp(c, zone)


def local_date(c: Column, zone: str = TOKYO) -> Column:
    return F.to_date(local(c, zone))


def snowflake_time(c: Column) -> Column:
    """The instant in a snowflake id (string or long); null if it isn't positive or lies before 2006."""
    ms = F.shiftright(c.try_cast("long"), 22) + F.lit(SNOWFLAKE_EPOCH)
    return F.when((c.try_cast("long") > 0) & (ms >= 1136073600000), F.timestamp_millis(ms))


def time_band(c: Column, zone: str = TOKYO) -> Column:
    h = F.hour(local(c, zone))
    return F.when(h.between(5, 10), "朝").when(h.between(11, 16), "昼").when(h.between(17, 22), "夜").otherwise("深夜")


def live_state(start: Column, end: Column, now: Column) -> Column:
    minutes = (F.unix_seconds(start) - F.unix_seconds(now)) / 60
    stop = F.coalesce(end, start + F.expr("interval 2 hours"))
    return (
        F.when(start.isNull(), "unknown").when((start <= now) & (now < stop), "live").when((minutes > 0) & (minutes <= 60), "soon")
        .when(local_date(start) == local_date(now), "tonight").otherwise("future")
    )


def _stamp(year: Column, month: Column, day: Column, hour: Column, minute: Column) -> Column:
    return F.to_utc_timestamp(F.try_make_timestamp(years=year, months=month, days=day, hours=hour, mins=minute, secs=F.lit(0)), TOKYO)


def _int(c: Column) -> Column:
    return F.translate(c, *FULL_DIGITS).try_cast("int")


def event_datetime(text: Column, anchor: Column) -> Column:
    """Date and clock in a text as an instant: year-month-day, month-day (next year if two days past), today/tomorrow.

    The first form that occurs decides: an impossible date there gives null.
    """
    t = F.coalesce(width_folded(text), F.lit(""))
    near = local(anchor)
    full = rf"(?s)(20[0-9]{{2}})[./年-]([0-9]{{1,2}})[./月-]([0-9]{{1,2}}){_DAY_MARK}.{{0,40}}?{_CLOCK}"
    short = rf"(?s)([0-9]{{1,2}})[./月-]([0-9]{{1,2}}){_DAY_MARK}.{{0,40}}?{_CLOCK}"
    day = rf"(?s)(本日|今日|明日).{{0,30}}?{_CLOCK}"

    def by_year(at) -> Column:
        return _stamp(_int(at(1)), _int(at(2)), _int(at(3)), _int(at(4)), F.coalesce(_int(at(5)), F.lit(0)))

    def by_month(at) -> Column:
        rest = (_int(at(1)), _int(at(2)), _int(at(3)), F.coalesce(_int(at(4)), F.lit(0)))
        this = _stamp(F.year(near), *rest)
        return F.when(this < anchor - F.expr("interval 2 days"), _stamp(F.year(near) + 1, *rest)).otherwise(this)

    def by_day(at) -> Column:
        on = F.date_add(F.to_date(near), F.when(at(1) == "明日", 1).otherwise(0))
        return _stamp(F.year(on), F.month(on), F.dayofmonth(on), _int(at(2)), F.coalesce(_int(at(3)), F.lit(0)))

    return _first(t, full, by_year, _first(t, short, by_month, _first(t, day, by_day, F.lit(None).cast("timestamp"))))


def _first(text: Column, pattern: str, made, other: Column) -> Column:
    """made(group) of the first match, which is looked for once; its groups are taken from the match alone."""
    return let(F.regexp_extract(text, pattern, 0), lambda w: F.when(w != "", made(lambda i: F.regexp_extract(w, pattern, i))).otherwise(other))


def let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def post_datetime(text: Column, created: Column) -> Column:
    """Date and clock in a post: year-month-day, else month-day of the year of posting, or the next where that is 45 days past.

    The first form that occurs decides; an impossible date gives null. Nothing bounds what stands between day and clock.
    """
    t = F.replace(F.coalesce(text, F.lit("")), F.lit("："), F.lit(":"))
    month = rf"([0-9]{{1,2}})[./月-]([0-9]{{1,2}}){_DAY_MARK}.*?{_CLOCK}"
    this = F.year(local(created))

    def by_year(at) -> Column:
        return _stamp(_int(at(1)), _int(at(2)), _int(at(3)), _int(at(4)), F.coalesce(_int(at(5)), F.lit(0)))

    def by_month(at) -> Column:
        made = lambda year: _stamp(year, _int(at(1)), _int(at(2)), _int(at(3)), F.coalesce(_int(at(4)), F.lit(0)))
        return let(made(this), lambda own: F.when(own < created - F.expr("interval 45 days"), made(this + 1)).otherwise(own))

    return _first(t, rf"(?s)(20[0-9]{{2}})[./年-]{month}", by_year, _first(t, rf"(?s){month}", by_month, F.lit(None).cast("timestamp")))


def relative_weekday(text: Column, anchor: Column, policy: str = "calendar_week") -> tuple[Column, Column]:
    """(instant, method) of a weekday with a clock in a text.

    policy calendar_week: 来週 lies in the next Monday week, 今週 never rolls on; legacy: 来週 is the next occurrence + 7.
    """
    t = F.coalesce(width_folded(text), F.lit(""))
    pattern = rf"(?s)(次(?:の)?|来週(?:の)?|今週(?:の)?)?\s*([{WEEKDAYS}])曜日?.{{0,100}}?{_CLOCK}"
    near = local(anchor)
    today = F.to_date(near)
    monday = F.date_sub(today, F.weekday(today))

    def made(w: Column) -> Column:
        prefix = F.regexp_extract(w, pattern, 1)
        target = F.instr(F.lit(WEEKDAYS), F.regexp_extract(w, pattern, 2)) - 1
        ahead = F.pmod(target - F.weekday(today), F.lit(7))
        nxt, this, later = F.startswith(prefix, F.lit("来週")), F.startswith(prefix, F.lit("今週")), F.startswith(prefix, F.lit("次"))
        on = F.date_add(today, F.when(later & (ahead == 0), 7).otherwise(ahead))
        if policy == "calendar_week":
            on = F.when(nxt, F.date_add(monday, 7 + target)).when(this, F.date_add(monday, target)).otherwise(on)
        else:
            on = F.when(nxt, F.date_add(on, 7)).otherwise(on)
        at = _stamp(F.year(on), F.month(on), F.dayofmonth(on), _int(F.regexp_extract(w, pattern, 3)), F.coalesce(_int(F.regexp_extract(w, pattern, 4)), F.lit(0)))
        past = at < anchor - F.expr("interval 2 hours")
        if policy == "calendar_week":
            at = F.when(this & (at < anchor), F.lit(None).cast("timestamp")).when((prefix == "") & past, at + F.expr("interval 7 days")).otherwise(at)
        else:
            at = F.when((prefix == "") & (ahead == 0) & past, at + F.expr("interval 7 days")).otherwise(at)
        method = F.when(nxt, "next_calendar_week_weekday").when(this, "current_calendar_week_weekday").when(later, "next_occurrence_explicit").otherwise("next_occurrence_unprefixed")
        return F.when(w != "", F.struct(at.alias("at"), F.when(at.isNotNull(), method).alias("method")))

    both = let(F.regexp_extract(t, pattern, 0), made)
    return both["at"], both["method"]


def month_conflict(text: Column) -> Column:
    """Whether the month that a next date is announced for isn't the month of its date."""
    pattern = r"(?is)次回.{0,50}?(1[0-2]|0?[1-9])月.{0,80}?(?:日時|日程)\s*[:：]?\s*(?:20[0-9]{2}[./年-])?(1[0-2]|0?[1-9])[./月-]"
    found = F.regexp_extract(F.coalesce(text, F.lit("")), pattern, 0)
    return let(found, lambda w: (w != "") & (_int(F.regexp_extract(w, pattern, 1)) != _int(F.regexp_extract(w, pattern, 2))))
