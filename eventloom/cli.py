"""run: collect, normalize, deduplicate, publish. validate: check a configuration (JSON: sources, window, output)."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import UTC, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import events as ev
from .operators import metrics, resolve
from .sources import readers, sinks


def problems(config: dict) -> list[str]:
    out, names = [], set()
    for i, s in enumerate(config.get("sources", [])):
        if not isinstance(s, dict):
            out.append(f"sources[{i}] must be a mapping")
            continue
        name = (s.get("name") or "").strip()
        if not name:
            out.append(f"sources[{i}] has no name")
        elif name in names:
            out.append(f"duplicate source name: {name}")
        names.add(name)
        if s.get("type") not in readers.REGISTRY:
            out.append(f"unsupported source type at sources[{i}]: {s.get('type')}")
    return out


def run(spark: SparkSession, config: dict, output: str, now: datetime, strict: bool = False) -> int:
    """0; 1 if every source failed; 2 if strict and one failed. A failing source doesn't stop the others."""
    moment = F.lit(now.replace(tzinfo=None)).cast("timestamp")
    parts, health = [], []
    for s in config.get("sources", []):
        if not s.get("enabled", True):
            continue
        try:
            # of rows with one id the later source counts, and in it the later row, as far as its files are read in order
            raw = readers.collect(spark, s).drop("source")
            rows = ev.build(raw, s["name"], moment).withColumns({"_source": F.lit(len(parts)), "_row": F.monotonically_increasing_id()}).where("error is null").drop("error")
            n = rows.count()
            parts.append(rows)
            health.append((s["name"], "ok", n, None))
        except Exception as e:  # the failure is the source's health row
            health.append((s["name"], "error", 0, str(e).splitlines()[0][:300]))
    h = spark.createDataFrame(health, "name string, status string, count long, error string")
    h.write.mode("overwrite").json(f"{output}/health")
    if parts:
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        rows = resolve.best_by(rows, ["id"], [F.col("fetched_at"), F.col("_source"), F.col("_row")]).drop("_source", "_row")
        w = config.get("window", {})
        rows = rows.where(F.col("starts_at").between(moment - F.expr(f"interval {int(w.get('past_days', 1))} days"), moment + F.expr(f"interval {int(w.get('future_days', 120))} days")))
        sinks.write_bundle(rows, output, ["category", "status", "source"])
        sinks.write_calendar(rows.withColumn("uid", F.col("id")), f"{output}/calendar")
    state = metrics.health(h, "status").first()
    return 1 if state.status == "error" and state.failed else 2 if strict and state.failed else 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    sub = parser.add_subparsers(dest="command", required=True)
    for name in ("run", "validate"):
        p = sub.add_parser(name)
        p.add_argument("--config", required=True)
        if name == "run":
            p.add_argument("--output", required=True)
            p.add_argument("--strict", action="store_true")
    args = parser.parse_args(argv)
    with open(args.config, encoding="utf-8") as f:
        config = json.load(f)
    found = problems(config)
    if found:
        print("\n".join(found), file=sys.stderr)
        return 1
    if args.command == "validate":
        print(f"configuration ok: {len(config.get('sources', []))} sources")
        return 0
    spark = SparkSession.builder.appName("eventloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    return run(spark, config, args.output, datetime.now(UTC), args.strict)


if __name__ == "__main__":
    sys.exit(main())
