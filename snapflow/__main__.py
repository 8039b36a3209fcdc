"""Command line: one pipeline tick, insights, run status, retention.

    python -m snapflow tick     --root R --landed FILE [--as-of D] [--incremental]
    python -m snapflow insights --root R [--as-of D] [--out DIR]
    python -m snapflow status   --root R
    python -m snapflow cleanup  --root R [--now ISO] [--apply]

Meant for spark-submit (the master comes from the submit command); results
are printed with ``show`` or written as JSON, never collected whole.  All times
are UTC.  ``--store-endpoint`` (any command) sets up an S3-compatible store.
"""

from __future__ import annotations

import argparse
import datetime as dt

from snapflow.config import PipelineConfig
from snapflow.functions.exprs import utc_now
from snapflow.sources.lake import object_store_conf


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="snapflow")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("tick", "insights", "status", "cleanup"):
        s = sub.add_parser(name)
        s.add_argument("--root", required=True, help="lakehouse root (file:/, hdfs://, s3a://)")
        s.add_argument("--store-endpoint", default=None, help="endpoint of an S3-compatible store for s3a:// paths")
        s.add_argument("--store-ssl", action="store_true", help="reach the store over TLS")
        s.add_argument("--store-host-style", action="store_true", help="bucket in the host name instead of the path")
        if name in ("tick", "insights"):
            s.add_argument("--as-of", type=dt.date.fromisoformat, default=None, help="day to report (default today)")
        if name == "tick":
            s.add_argument("--landed", default=None, help="landed JSON snapshot to ingest first")
            s.add_argument("--layout", choices=("array", "lines"), default="array", help="layout of the landed file")
            s.add_argument("--incremental", action="store_true", help="merge new bronze files instead of a rebuild")
        if name == "insights":
            s.add_argument("--out", default=None, help="write each result as JSON under this folder")
        if name == "cleanup":
            s.add_argument("--now", type=dt.datetime.fromisoformat, default=None)
            s.add_argument("--apply", action="store_true", help="delete (default: dry run)")
    return p


def store_settings(args: argparse.Namespace) -> dict[str, str]:
    """Session settings for the object store named on the command line."""
    if not args.store_endpoint:
        return {}
    return object_store_conf(args.store_endpoint, path_style=not args.store_host_style, ssl=args.store_ssl)


def main(argv: list[str] | None = None, spark=None) -> int:
    args = _parser().parse_args(argv)
    if spark is None:
        from snapflow.session import build_session

        spark = build_session(extra=store_settings(args))
    cfg = PipelineConfig(root=args.root)
    if args.cmd == "tick":
        from snapflow.plans.pipeline import run_pipeline

        now = utc_now()
        run_pipeline(
            spark, cfg, args.as_of or now.date(), args.landed, now, incremental=args.incremental, layout=args.layout
        )
    elif args.cmd == "insights":
        from snapflow.plans.pipeline import export_insights, serve_insights

        as_of = args.as_of or utc_now().date()
        if args.out:
            for path in export_insights(spark, cfg, as_of, args.out):
                print(path)
        else:
            for name, df in serve_insights(spark, cfg, as_of).items():
                print(f"== {name}")
                df.show(truncate=False)
    elif args.cmd == "status":
        from snapflow.plans.runlog import read_run_log, run_status, split_run_log

        runs, steps = split_run_log(read_run_log(spark, cfg))
        run_status(runs, steps, cfg.job).show(truncate=False)
    elif args.cmd == "cleanup":
        from snapflow.plans.retention import clean_staging, run_cleanup
        from snapflow.plans.runlog import compact_run_log

        now = args.now or utc_now()
        run_cleanup(spark, cfg, now, dry_run=not args.apply).show()
        print(f"staging folders expired: {clean_staging(spark, cfg, now, dry_run=not args.apply)}")
        if args.apply:
            print(f"run-log days compacted: {compact_run_log(spark, cfg, now.date())}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
