"""Rules of old events: occurrences in a window, without all those before it."""

import random
from datetime import datetime
from zoneinfo import ZoneInfo

from dateutil.rrule import rrulestr

from eventloom.sources import readers

UTC = ZoneInfo("UTC")


def test_rules_begun_later_give_the_same_occurrences():
    rng = random.Random(4)
    days = ["MO", "TU", "WE", "TH", "FR", "SA", "SU"]
    some = lambda values, n: ",".join(map(str, sorted(rng.sample(values, rng.randint(1, n)))))
    begun = 0
    for _ in range(120):
        freq = rng.choice(["DAILY", "WEEKLY", "MONTHLY", "YEARLY"])
        rule = [f"FREQ={freq}", f"INTERVAL={rng.randint(1, 5)}"]
        if rng.random() < 0.5:
            rule.append("BYDAY=" + some(days if freq in ("DAILY", "WEEKLY") else [f"{k}{d}" for k in ("", "1", "2", "-1", "5") for d in days], 3))
        if rng.random() < 0.3 and freq != "WEEKLY":
            rule.append("BYMONTHDAY=" + some([1, 8, 15, 29, 30, 31, -1, -2], 3))
        if rng.random() < 0.2:
            rule.append("BYMONTH=" + some([1, 2, 3, 4, 5, 9, 12], 5))
        if rng.random() < 0.2 and any(p.startswith("BYDAY") or p.startswith("BYMONTHDAY") for p in rule):
            rule.append(f"BYSETPOS={rng.choice([1, -1, 2])}")
        if rng.random() < 0.2:
            rule.append(f"WKST={rng.choice(days)}")
        if rng.random() < 0.3:
            rule.append(rng.choice(["COUNT=30", "COUNT=2000", "UNTIL=20240401T000000Z"]))
        zone = ZoneInfo(rng.choice(["UTC", "Asia/Tokyo", "Europe/Berlin", "America/New_York"]))
        start = datetime(rng.choice([2010, 2016, 2023]), rng.randint(1, 12), rng.randint(1, 28), rng.randint(0, 23), rng.choice([0, 30]), tzinfo=UTC).astimezone(zone)
        first, last = datetime(2024, 1, 1, tzinfo=UTC), datetime(2024, 12, 31, 23, 59, tzinfo=UTC)
        plain = rrulestr(";".join(rule), dtstart=start)
        near = readers._begun_later(plain, first)
        assert near.between(first, last, inc=True) == plain.between(first, last, inc=True), (rule, start)
        begun += near._dtstart.year >= 2018
    assert begun > 60


def test_rules_of_long_ago_in_spark(spark):
    start = datetime(1924, 1, 1, 12)
    e = spark.createDataFrame([(i, "FREQ=DAILY", start, start) for i in range(300)], "i int, rrule string, starts_at timestamp_ntz, ends_at timestamp_ntz")
    got = readers.expand_rrule(e, datetime(2024, 1, 1), datetime(2024, 1, 3), "UTC").groupBy("starts_at").count().collect()
    assert sorted((str(r.starts_at), r["count"]) for r in got) == [("2024-01-01 12:00:00", 300), ("2024-01-02 12:00:00", 300)]
