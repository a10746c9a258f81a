"""Run the rate-shop job from the command line.

    python -m ratelens --manifest hotels.csv --captures captures/ \\
        --out results/ [--run-date 2024-05-01] [--rules rules.json] \\
        [--extra-prices] [--ordered] [--captures-format parquet|json]

Reads the manifest and the captured pages, writes offers, the legacy CSV
and its backup, the re-attempt CSV and, in manifest form, the requests to
try again, then prints the coverage summary.
"""

from __future__ import annotations

import argparse
import datetime as dt

from ratelens.plans.layouts import DEFAULT_LAYOUTS, load_layouts
from ratelens.plans.rateshop import run_rate_shop
from ratelens.session import get_session
from ratelens.sources.captures import read_captures
from ratelens.sources.manifest import read_manifest, reattempt_manifest
from ratelens.sources.sinks import write_csv, write_outputs


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ratelens", description=__doc__.splitlines()[0])
    ap.add_argument("--manifest", required=True, help="manifest CSV file or folder")
    ap.add_argument("--captures", required=True, help="captured pages (parquet or JSON lines)")
    ap.add_argument("--captures-format", default="parquet", choices=("parquet", "json"))
    ap.add_argument("--out", required=True, help="output folder")
    ap.add_argument("--run-date", default=dt.date.today().isoformat(),
                    help="date stamped on rows and paths (default: today)")
    ap.add_argument("--single-line-manifest", action="store_true",
                    help="fields never contain line breaks: let Spark split large files")
    ap.add_argument("--rules", help="selector rules as JSON (default: built-in page rules)")
    ap.add_argument("--extra-prices", action="store_true",
                    help="add fee, average and total price columns")
    ap.add_argument("--require-dates", action="store_true",
                    help="a page without the requested check-in date is broken")
    ap.add_argument("--ordered", action="store_true",
                    help="sort the legacy CSV by request and position")
    args = ap.parse_args(argv)

    spark = get_session()
    multi_line = not args.single_line_manifest
    requests = read_manifest(spark, args.manifest, multi_line=multi_line)
    captures = read_captures(spark, args.captures, args.captures_format)
    layouts = load_layouts(args.rules) if args.rules else DEFAULT_LAYOUTS
    out = run_rate_shop(requests, captures, layouts, args.run_date,
                        extra_prices=args.extra_prices, require_dates=args.require_dates)
    paths = write_outputs(out, args.out, args.run_date, ordered=args.ordered)
    retry = f"{args.out.rstrip('/')}/reattempt_manifest_{args.run_date}"
    write_csv(reattempt_manifest(spark, args.manifest, out.reattempt, multi_line=multi_line),
              retry)
    paths["reattempt_manifest"] = retry
    for row in out.summary.orderBy("status").collect():  # at most four rows
        print(f"{row.status:14s} requests={row.requests:>10} offers={row.offers:>10}")
    for name, path in paths.items():
        print(f"{name}: {path}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
