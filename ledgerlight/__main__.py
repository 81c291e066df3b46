"""Command line: build every model from source files or catalog tables.

    python -m ledgerlight build --sources s3://bucket/account_usage --target s3://bucket/cost \\
        --account ACME [--as-of 2024-02-01] [--full-refresh] [--dbt-cloud-account-id 123]

Sources are the twelve audit-log tables (see ``ledgerlight/schemas.py``), either as
folders ``{sources}/{table}`` (``--format`` parquet by default) or, with
``--database/--schema/--org-database/--org-schema``, as catalog tables.
"""
from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import functions as F


def main(argv: list[str] | None = None) -> dict:
    p = argparse.ArgumentParser(prog="ledgerlight")
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="build or incrementally update every model")
    b.add_argument("--sources", help="folder holding one sub-folder per source table")
    b.add_argument("--format", default="parquet")
    b.add_argument("--database")
    b.add_argument("--schema")
    b.add_argument("--org-database")
    b.add_argument("--org-schema")
    b.add_argument("--target", required=True, help="folder for the model tables")
    b.add_argument("--account", required=True, help="account name in the organization tables")
    b.add_argument("--as-of", help="run date (default: today)")
    b.add_argument("--full-refresh", action="store_true")
    b.add_argument("--dbt-cloud-account-id")
    b.add_argument("--dbt-cloud-url", help="start of the links to jobs and runs")
    b.add_argument("--lookback-days", action="append", default=[], metavar="MODEL=DAYS",
                   help="look-back of an incremental model, instead of its own")
    b.add_argument("--master", help="Spark master when not set by spark-submit")
    args = p.parse_args(argv)

    from ledgerlight.plans.enriched import DEFAULT_CLOUD_URL
    from ledgerlight.plans.model_build import ModelBuild
    from ledgerlight.session import build_session
    from ledgerlight.sources.catalog import SourceConfig, read_sources

    spark = build_session(args.master)
    cfg = SourceConfig(account_usage_database=args.database, account_usage_schema=args.schema,
                       organization_usage_database=args.org_database,
                       organization_usage_schema=args.org_schema, root=args.sources, fmt=args.format)
    as_of = F.lit(dt.date.fromisoformat(args.as_of)) if args.as_of else F.current_date()
    build = ModelBuild(spark, read_sources(spark, cfg), args.target, args.account, as_of,
                       cloud_account_id=args.dbt_cloud_account_id,
                       cloud_url=args.dbt_cloud_url or DEFAULT_CLOUD_URL,
                       lookback_days={m: float(d) for m, d in (x.split("=", 1) for x in args.lookback_days)})
    lows = build.run(full_refresh=args.full_refresh)
    report = {name: (low.isoformat() if low else None) for name, low in lows.items()}
    print(json.dumps({"built": args.target, "lookback_from": report}))
    return report


if __name__ == "__main__":
    main()
