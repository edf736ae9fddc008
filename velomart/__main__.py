"""Command line: ``python -m velomart <command> --root <folder> ...`` (or spark-submit).

Commands:
  monthly   load one month (trips, then weather) and refresh the touched marts
  backfill  load every month of a range that the ledger does not have yet
  build     rebuild every mart from bronze

Folders default to ``<root>/landing/{trips,weather}``, ``<root>/bronze/{trips,weather}``,
``<root>/marts`` and ``<root>/state/loads``; each can be given on its own.
"""

from __future__ import annotations

import argparse
import json
import sys

from velomart.plans.build import build_marts
from velomart.plans.ingest import Layout
from velomart.plans.monthly import backfill, monthly_load
from velomart.session import build_session


def _month(text: str) -> tuple[int, int]:
    year, month = text.split("-")
    return int(year), int(month)


def _layout(args: argparse.Namespace) -> Layout:
    root = args.root.rstrip("/")
    return Layout(
        trips_landing=args.trips_landing or f"{root}/landing/trips",
        weather_landing=args.weather_landing or f"{root}/landing/weather",
        trips_bronze=args.trips_bronze or f"{root}/bronze/trips",
        weather_bronze=args.weather_bronze or f"{root}/bronze/weather",
        marts=args.marts or f"{root}/marts",
        ledger=args.ledger or f"{root}/state/loads",
        seed=args.seed,
        checks=args.checks,
        key_buckets=args.key_buckets,
    )


def parse(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="velomart", description=__doc__.splitlines()[0])
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--root", required=True, help="deployment folder on shared storage")
    for name in ("trips-landing", "weather-landing", "trips-bronze", "weather-bronze", "marts", "ledger", "seed", "checks"):
        common.add_argument(f"--{name}", default=None)
    common.add_argument("--key-buckets", type=int, default=None, help="buckets of stored ride ids")
    common.add_argument("--no-check", action="store_true", help="skip the data-quality gates")
    sub = parser.add_subparsers(dest="command", required=True)
    monthly = sub.add_parser("monthly", parents=[common], help="load one month")
    monthly.add_argument("--year", type=int, help="default: previous month (UTC)")
    monthly.add_argument("--month", type=int)
    monthly.add_argument("--force", action="store_true", help="reload even if loaded")
    monthly.add_argument("--station", default=None, help="keep one weather station")
    monthly.add_argument("--full-rebuild", action="store_true")
    fill = sub.add_parser("backfill", parents=[common], help="load pending months of a range")
    fill.add_argument("--first", type=_month, required=True, help="YYYY-MM")
    fill.add_argument("--last", type=_month, required=True, help="YYYY-MM")
    fill.add_argument("--station", default=None)
    sub.add_parser("build", parents=[common], help="rebuild every mart")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = parse(sys.argv[1:] if argv is None else argv)
    spark = build_session(app_name=f"velomart-{args.command}")
    layout = _layout(args)
    check = not args.no_check
    if args.command == "monthly":
        out = monthly_load(
            spark, layout, args.year, args.month, args.force, args.station, check, args.full_rebuild
        )
    elif args.command == "backfill":
        out = backfill(spark, layout, args.first, args.last, args.station, check)
        out["loaded"] = {f"{y:04d}-{m:02d}": v for (y, m), v in out["loaded"].items()}
    else:
        out = {"marts": build_marts(spark, layout, check)}
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
