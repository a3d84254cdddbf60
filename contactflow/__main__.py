"""Command line of the daily jobs: python -m contactflow JOB --base FOLDER ..."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from .plans import jobs
from .session import configure


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="contactflow")
    p.add_argument("--base", required=True, help="folder of the stored tables")
    p.add_argument("--dry-run", action="store_true", help="count only, write nothing")
    p.add_argument("--limit", type=int, default=0, help="first N input lines only")
    p.add_argument("--multiline", action="store_true", help="fields of the file may hold quoted line breaks")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("customers", "phones", "emails", "update-addresses", "results"):
        sub.add_parser(name).add_argument("path")
    clean = sub.add_parser("clean-addresses")
    clean.add_argument("path")
    clean.add_argument("out")
    claim = sub.add_parser("claim")
    claim.add_argument("--size", type=int, default=0)
    sub.add_parser("export").add_argument("folder")
    sub.add_parser("seed")
    sub.add_parser("revert").add_argument("--ids", type=int, nargs="*", help="state rows; all claimed rows without it")
    sub.add_parser("refresh")
    return p


def run(spark: SparkSession, argv: list[str] | None = None, now: dt.datetime | None = None):
    args = parser().parse_args(argv)
    store, now = jobs.Store(configure(spark), args.base), now or dt.datetime.now().replace(microsecond=0)
    limit, dry, lines = args.limit or None, args.dry_run, args.multiline
    return {
        "customers": lambda: jobs.import_customers(store, args.path, now, limit, dry, lines),
        "phones": lambda: jobs.import_contacts(store, args.path, "telefone", limit=limit, dry_run=dry, multiline=lines),
        "emails": lambda: jobs.import_contacts(store, args.path, "email", limit=limit, dry_run=dry, multiline=lines),
        "clean-addresses": lambda: jobs.clean_addresses(store, args.path, args.out, limit, lines),
        "update-addresses": lambda: jobs.update_addresses(store, args.path, dry),
        "results": lambda: jobs.load_results(store, args.path, now, dry),
        "claim": lambda: jobs.claim_batch(store, args.size).count(),
        "export": lambda: jobs.export_customers(store, args.folder, now),
        "revert": lambda: jobs.revert_claims(store, args.ids),
        "seed": lambda: jobs.seed_state(store, now),
        "refresh": lambda: jobs.refresh_rollups(store, now),
    }[args.job]()


if __name__ == "__main__":
    print(run(SparkSession.builder.appName("contactflow").getOrCreate()))
