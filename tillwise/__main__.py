"""Command line: ``python -m tillwise build|report|kpis ...`` (or through spark-submit)."""

from __future__ import annotations

import argparse
from datetime import date

from tillwise.config import AnalyticsConfig
from tillwise.plans import kpis, reports
from tillwise.plans.pipeline import build_tables, run_reports
from tillwise.session import build_session
from tillwise.sources.raw_csv import TIMESTAMP_FORMAT, read_raw_csv
from tillwise.sources.tables import RetailTables, drop_old_versions, read_audit, read_tables


def show_kpis(tables: RetailTables, config: AnalyticsConfig, min_cohort: int) -> None:
    churn = reports.churn_by_rfm_tier(tables.customers)
    share = reports.anonymous_share(tables.transactions.unionByName(tables.anonymous_tx))
    cohorts = reports.cohort_retention(tables.customers, tables.orders, config)
    for title, table in {
        "overview": kpis.overview_kpis(churn, share),
        "activity": kpis.activity_kpis(reports.activity_trend(tables.orders)),
        "tiers": kpis.tier_counts(tables.customers),
        "repeat within days": kpis.repeat_30d_retention(tables.customers),
        "cohort matrix": kpis.retention_matrix(cohorts, config, min_cohort),
    }.items():
        print(title)
        table.show(200, truncate=False)


def main(argv: list[str] | None = None) -> None:
    defaults = AnalyticsConfig()
    parser = argparse.ArgumentParser(prog="tillwise")
    commands = parser.add_subparsers(dest="command", required=True)

    build = commands.add_parser("build", help="raw CSV -> stored tables")
    build.add_argument("--raw", required=True)
    build.add_argument("--tables", required=True)
    build.add_argument("--encoding", default="ISO-8859-1")
    build.add_argument("--timestamp-format", default=TIMESTAMP_FORMAT)
    build.add_argument("--multi-line", action="store_true", help="quoted cells hold line breaks")
    build.add_argument("--staging", help="shared folder for intermediate tables")
    build.add_argument("--drop-old", action="store_true", help="remove earlier versions")

    report = commands.add_parser("report", help="stored tables -> report CSVs")
    report.add_argument("--tables", required=True)
    report.add_argument("--out", required=True)

    figures = commands.add_parser("kpis", help="headline figures of the stored tables")
    figures.add_argument("--tables", required=True)
    figures.add_argument("--min-cohort", type=int, default=kpis.DEFAULT_MIN_COHORT)

    for command in (build, report, figures):
        command.add_argument("--as-of", type=date.fromisoformat, default=defaults.as_of)
        command.add_argument("--churn-days", type=int, default=defaults.churn_days)
        command.add_argument("--repeat-days", type=int, default=defaults.repeat_days)

    args = parser.parse_args(argv)
    config = AnalyticsConfig(
        as_of=args.as_of, churn_days=args.churn_days, repeat_days=args.repeat_days
    )
    spark = build_session()
    if args.command == "build":
        raw = read_raw_csv(
            spark,
            args.raw,
            encoding=args.encoding,
            timestamp_format=args.timestamp_format,
            multi_line=args.multi_line,
        )
        build_tables(raw, args.tables, config, args.staging)
        if args.drop_old:
            drop_old_versions(spark, args.tables)
        for row in read_audit(spark, args.tables).collect():
            print(f"{row['metric']}: {row['value']:g}")
    elif args.command == "report":
        for name, rows in run_reports(read_tables(spark, args.tables), args.out, config).items():
            print(f"{name}: {rows} rows")
    else:
        show_kpis(read_tables(spark, args.tables), config, args.min_cohort)


if __name__ == "__main__":
    main()
