"""Jobs for spark-submit or ``python -m cardmill JOB --root FOLDER``. Run with --help for the jobs."""

from __future__ import annotations

import argparse
from datetime import date, datetime, time

from cardmill.operators import quality
from cardmill.plans import catalog, flows, incremental, ingest, labels, maintenance, repack, staging, warehouse
from cardmill.plans.layout import Lake
from cardmill.session import build_session
from cardmill.sources import JdbcSource, read_day, read_table

# Tables that are compacted, and the key of their copies.
COMPACTED = {"transactions": "transaction_id"}


def _ingest(spark, lake, options):
    source = JdbcSource(options.url, options.driver, options.user, options.password)
    return ingest.ingest_all(spark, lake, source, options.connections)


def _check(spark, lake, options):
    if options.layer == "raw":
        day = read_day(spark, lake.raw("transactions"), options.date)
        report = quality.raw_checks(day, read_table(spark, lake.raw("mcc_codes")))
    else:
        tables = ("transactions", "users", "cards")
        report = quality.staging_checks(*(read_table(spark, lake.staging(t)) for t in tables))
    report.show(truncate=False)
    quality.gate(report)


def _compact(spark, lake, options):
    return [
        done
        for table, key in COMPACTED.items()
        for done in maintenance.maintain_table(spark, lake.staging(table), lake.warm(table), key, options.date)
    ]


def _repack(spark, lake, options):
    return [repack.repack_day(spark, lake.staging(table), options.date, key) for table, key in COMPACTED.items()]


def _load(spark, lake, options):
    return {"users": incremental.load_users(spark, lake), "cards": incremental.load_cards(spark, lake)}


def _publish(spark, lake, options):
    catalog.register_tables(spark, lake)
    catalog.sync_partitions(spark, lake)
    return catalog.register_marts(spark, lake) + catalog.create_views(spark)


JOBS = {
    "ingest": _ingest,
    "backfill": lambda spark, lake, o: flows.run_backfill(spark, lake, datetime.combine(o.date, time())),
    "day": lambda spark, lake, o: flows.run_day(spark, lake, o.date, datetime.combine(o.date, time())),
    "clean": lambda spark, lake, o: staging.clean_transactions_day(spark, lake, o.date),
    "enrich": lambda spark, lake, o: staging.enrich_transactions_day(spark, lake, o.date),
    "features": lambda spark, lake, o: warehouse.build_features_day(spark, lake, o.date),
    "marts": lambda spark, lake, o: warehouse.build_marts(spark, lake, o.date),
    "load": _load,
    "late-labels": lambda spark, lake, o: labels.run_labels(spark, lake, read_table(spark, lake.raw("fraud_labels"))),
    "repack": _repack,
    "labels": lambda spark, lake, o: flows.check_labels(spark, lake, o.date.year),
    "check": _check,
    "compact": _compact,
    "vacuum": lambda spark, lake, o: maintenance.vacuum_quarantine(spark, lake.quarantine("transactions"), o.retention, o.date),
    "publish": _publish,
}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="cardmill")
    out.add_argument("job", choices=JOBS)
    out.add_argument("--root", required=True, help="folder of the lake")
    out.add_argument("--date", type=date.fromisoformat, default=date.today())
    out.add_argument("--layer", choices=("raw", "staging"), default="staging")
    out.add_argument("--retention", type=int, default=30, help="days that resolved quarantine rows are kept")
    out.add_argument("--connections", type=int, default=None, help="connections of each large table")
    for name in ("url", "driver", "user", "password"):
        out.add_argument(f"--{name}", help="of the source database")
    return out


def main(arguments: list[str] | None = None, spark=None) -> object:
    options = parser().parse_args(arguments)
    result = JOBS[options.job](spark or build_session(f"cardmill-{options.job}"), Lake(options.root), options)
    print(result)
    return result


if __name__ == "__main__":
    main()
