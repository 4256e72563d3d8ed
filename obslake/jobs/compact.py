"""Batch job: every hour of the aggregate table down to one version, every closed day of its copy to one directory."""

from __future__ import annotations

from datetime import date, datetime, timezone

from obslake.jobs.config import parser, paths
from obslake.session import build_session
from obslake.sinks.aggregates import compact_aggregates, merge_aggregates_parquet
from obslake.sinks.keyed import KEEP_SECONDS


def main(argv: list[str] | None = None) -> None:
    p = parser(__doc__)
    p.add_argument("table", nargs="?")
    p.add_argument("--copy", help="Parquet copy; that of the lake if neither is named")
    p.add_argument("--before", type=date.fromisoformat, help="first day of the copy left alone (default: today, UTC)")
    p.add_argument("--keep-seconds", type=float, default=KEEP_SECONDS, help="age at which replaced versions go")
    args = p.parse_args(argv)
    spark, where = build_session("obslake-compact"), paths(args.lake)
    table = args.table or where["table"]
    copy = args.copy or (None if args.table else where["aggregated"])
    print(f"{compact_aggregates(spark, table, keep_seconds=args.keep_seconds)} compacted")
    if copy:
        before = args.before or datetime.now(timezone.utc).date()
        print(f"{merge_aggregates_parquet(spark, copy, before, args.keep_seconds)} merged")


if __name__ == "__main__":
    main()
