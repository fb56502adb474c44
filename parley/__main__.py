"""Command line for the merge jobs (what each original MERGE statement did).

    python -m parley <job> [options]

(cluster settings such as master and ``spark.checkpoint.dir`` come from
spark-defaults.conf or ``PYSPARK_SUBMIT_ARGS``, as for any PySpark program).

Jobs:
  conversation-summary  --events P --hours P --target P [--parity-keys]
  daily-performance     --events P --hours P --target P --run-ts TS [--parity-keys]
  legacy                --events P --target P --run-date D --run-ts TS
                        [--variant original|simple|enhanced] [--config P] [--days N]

All take ``--rejects P``: rows with a NULL in a REQUIRED column are set aside
below that folder (by default such rows refuse the table).

Sources are Parquet paths or table names; ``--events`` has the
message_events schema and ``--hours`` the resolved UTC working-hours schema.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import config, jobs
from .sources import readers


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="parley", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    sub = p.add_subparsers(dest="job", required=True)
    cs = sub.add_parser("conversation-summary")
    dp = sub.add_parser("daily-performance")
    lg = sub.add_parser("legacy")
    for s in (cs, dp, lg):
        s.add_argument("--events", required=True)
        s.add_argument("--target", required=True)
        s.add_argument("--rejects")
    for s in (cs, dp):
        s.add_argument("--hours", required=True)
        s.add_argument("--parity-keys", action="store_true", help="plain-equality merge keys (NULL never matches)")
    dp.add_argument("--run-ts", required=True)
    lg.add_argument("--run-date", required=True)
    lg.add_argument("--run-ts", required=True)
    lg.add_argument("--variant", default="original", choices=["original", "simple", "enhanced"])
    lg.add_argument("--days", type=int, default=1)
    lg.add_argument("--config", help="relational working-hours configuration (enhanced variant)")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"parley-{args.job}").getOrCreate()
    events = readers.read_message_events(spark, args.events)
    if args.job == "conversation-summary":
        hours = readers.read_working_hours(spark, args.hours)
        jobs.conversation_summary_job(spark, events, hours, args.target, not args.parity_keys, args.rejects)
    elif args.job == "daily-performance":
        hours = readers.read_working_hours(spark, args.hours)
        jobs.daily_performance_job(spark, events, hours, args.target, args.run_ts, not args.parity_keys, args.rejects)
    else:
        hours = None
        if args.variant == "enhanced":
            if not args.config:
                raise SystemExit("--config is required for the enhanced variant")
            cfg = readers.read_working_hours_config(spark, args.config)
            requests = events.where("user_id IS NOT NULL").select("user_id", "org_id").distinct()
            hours = config.working_hours_for(cfg, requests)
        jobs.legacy_summary_job(
            spark, events, args.target, args.run_date, args.run_ts, variant=args.variant, hours=hours, days=args.days,
            rejects=args.rejects,
        )


if __name__ == "__main__":
    main()
