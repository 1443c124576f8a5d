"""Command line: run the pipeline or one registered query over a folder of parquet tables.

    python -m lapworks queries
    python -m lapworks query driver_leaderboard --sf-dir /root/testdata/sf0.01 [--explain]
    python -m lapworks pipeline --sf-dir /root/testdata/sf0.01 --location /shared/warehouse
    python -m lapworks pipeline --base-url https://host/v1 --season 2025 --circuit Baku --location /shared/warehouse
"""

from __future__ import annotations

import argparse
import os
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="lapworks")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("queries")
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    q.add_argument("--rows", type=int, default=20)
    q.add_argument("--explain", action="store_true")
    p = sub.add_parser("pipeline")
    p.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    p.add_argument("--location", default=None, help="schema root on shared storage")
    p.add_argument("--base-url", default=None, help="fetch from the list endpoints under this URL instead of --sf-dir")
    p.add_argument("--season", type=int, default=None)
    p.add_argument("--circuit", default=None)
    p.add_argument("--ledger", default=None, help="shared folder of finished requests; a rerun asks only for the others")
    p.add_argument("--threshold", action="append", default=[], metavar="CHECK=NUMBER",
                   help="threshold of a check, e.g. EL10=300 (repeatable)")
    p.add_argument("--min-lap", type=float, default=None, help="minimum lap duration, also of the checks that bound it")
    p.add_argument("--master", default=os.environ.get("LAPWORKS_MASTER", "local[*]"))
    args = ap.parse_args(argv)

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from lapworks.plans import suite
    if args.cmd == "queries":
        for name in suite.QUERIES:
            print(name, "(oracle)" if name in suite.ORACLE else "")
        return 0
    from lapworks.session import build_session
    spark = build_session(getattr(args, "master", "local[*]"))
    if args.cmd == "query":
        df = suite.QUERIES[args.name](spark, args.sf_dir)
        if args.explain:
            df.explain("formatted")
        df.show(args.rows, truncate=False)
        return 0
    from lapworks.plans import pipeline
    from lapworks.plans import testdata as td
    from dataclasses import replace

    from lapworks.config import DEFAULT
    chosen = {"season_year": args.season, "race_round": args.circuit, "base_url": args.base_url,
              "min_lap_duration_s": args.min_lap}
    settings = replace(DEFAULT, **{k: v for k, v in chosen.items() if v is not None})
    run = dict(settings=settings, location=args.location, ledger=args.ledger, inject_min_lap=args.min_lap is not None,
               thresholds={k: float(v) for k, _, v in (t.partition("=") for t in args.threshold)})
    if args.base_url:
        opts = pipeline.Options(**run)
        fetchers = pipeline.rest_fetchers(spark, opts)
    else:
        opts = pipeline.Options(**run, lap_type=td.LAP_TYPE, duration_type=td.DURATION_TYPE,
                                session_id_type="bigint", avg_scale=td.AVG_SCALE)
        fetchers = {"sessions": lambda: td.bronze_sessions(spark, args.sf_dir),
                    "laps": lambda: td.bronze_laps(spark, args.sf_dir),
                    "drivers": lambda: td.bronze_drivers(spark, args.sf_dir)}
    status = pipeline.run_all(spark, fetchers, opts)
    status.show(truncate=120)
    return 0 if status.filter("status != 'ok'").isEmpty() else 1


if __name__ == "__main__":
    sys.exit(main())
