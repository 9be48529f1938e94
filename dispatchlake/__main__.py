"""Command line: ``python -m dispatchlake <job>``; settings come from the environment (see ``JobConfig``)."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from dispatchlake.functions.keys import topic_name
from dispatchlake.plans import daily
from dispatchlake.session import configure
from dispatchlake.sources.feeds import JobConfig, read_records
from dispatchlake.streaming import jobs


def main() -> None:
    parser = argparse.ArgumentParser(prog="dispatchlake")
    parser.add_argument("job", choices=["daily", "land", "state"])
    parser.add_argument("--every", help="processing-time trigger such as '1 minute'; default drains and stops")
    parser.add_argument("--version", default=datetime.now(timezone.utc).strftime("v%Y%m%d%H%M%S"))
    args = parser.parse_args()

    config = JobConfig.from_env()
    spark = configure(SparkSession.builder.appName(f"dispatchlake {args.job}").getOrCreate())
    trigger = {"processingTime": args.every} if args.every else None
    if args.job == "daily":
        lake = daily.Lake(config.lake, topic_name("orders", config.topic_pattern))
        done = daily.run(spark, lake, args.version)
        print("ingest days done:", ", ".join(map(str, done)) or "none")
    elif args.job == "land":
        jobs.land_bronze(
            read_records(spark, config), f"{config.lake}/bronze", f"{config.lake}/checkpoints/bronze", trigger
        ).awaitTermination()
    else:
        jobs.upsert_state(
            read_records(spark, config),
            f"{config.lake}/state",
            f"{config.lake}/checkpoints/state",
            trigger,
            config.topic_pattern,
        ).awaitTermination()
    spark.stop()


if __name__ == "__main__":
    main()
