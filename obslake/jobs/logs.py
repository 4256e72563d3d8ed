"""Batch job: archived log text to structured Parquet."""

from __future__ import annotations

from pyspark.sql import SparkSession

from obslake.jobs.config import parser, paths
from obslake.operators.logs import extract_log_fields
from obslake.session import build_session
from obslake.sinks.files import write_logs_parquet
from obslake.sources.files import read_log_text


def run(spark: SparkSession, source: str, target: str, rebalance: bool = False) -> None:
    write_logs_parquet(extract_log_fields(read_log_text(spark, source)), target, rebalance)


def main(argv: list[str] | None = None) -> None:
    p = parser(__doc__)
    p.add_argument("source", nargs="?", help="folder of log text (default: the archive of the lake)")
    p.add_argument("target", nargs="?", help="folder of the Parquet table")
    p.add_argument("--rebalance", action="store_true", help="shuffle into even files per level and date")
    args = p.parse_args(argv)
    lake = paths(args.lake)
    spark = build_session("obslake-logs")
    run(spark, args.source or lake["logs_raw"], args.target or lake["logs"], args.rebalance)


if __name__ == "__main__":
    main()
