"""Command line: verify-api, migrate, daily, backfill, checks, status."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import logging
import sys

from pyspark.sql import SparkSession

from tidewater import status
from tidewater.config import Config
from tidewater.sources.store import Store
from tidewater.streaming import jobs


def _session() -> SparkSession:
    return SparkSession.builder.appName("tidewater").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def verify_api(spark: SparkSession, cfg: Config, source=None, today: dt.date | None = None) -> int:
    """Five records of a two-day window must come, all dated inside it."""
    end = today or dt.datetime.now(dt.timezone.utc).date()
    start = end - dt.timedelta(days=2)
    rows = (source or jobs.api_source(cfg))(spark, start, end).limit(5).collect()
    outside = [r for r in rows if r.last_update_post_date is None or not start <= r.last_update_post_date <= end]
    print(json.dumps({"rows": len(rows), "outside_window": len(outside)}))
    return int(not rows or bool(outside))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidewater")
    parser.add_argument("-v", "--verbose", action="store_true")
    sub = parser.add_subparsers(dest="command", required=True)
    for name in ("verify-api", "migrate", "daily", "flow", "checks", "status"):
        sub.add_parser(name)
    b = sub.add_parser("backfill")
    b.add_argument("--start", type=dt.date.fromisoformat, required=True)
    b.add_argument("--end", type=dt.date.fromisoformat, required=True)
    b.add_argument("--chunk-days", type=int, default=7)
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if args.verbose else logging.INFO, stream=sys.stderr)
    cfg, spark = Config.from_env(), spark or _session()
    store = Store(spark, cfg.warehouse, cfg.buckets, cfg.bucket_files)
    if args.command == "verify-api":
        return verify_api(spark, cfg)
    if args.command == "migrate":
        print(json.dumps({"created": store.migrate()}))
    elif args.command == "daily":
        print(json.dumps(jobs.run_daily(store, cfg)))
    elif args.command == "flow":
        print(json.dumps(jobs.daily_flow(store, cfg)))
    elif args.command == "backfill":
        print(json.dumps(jobs.run_backfill(store, cfg, args.start, args.end, args.chunk_days)))
    elif args.command == "checks":
        found = jobs.run_suite(store)
        print(json.dumps({k: found[k] for k in ("run_id", "run", "passed", "failed_error", "failed_warn", "blocking_failures")}))
        return int(bool(found["blocking_failures"]))
    elif args.command == "status":
        print(status.write(store, cfg.status_page))
    return 0


if __name__ == "__main__":
    sys.exit(main())
