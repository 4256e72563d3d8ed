"""Batch job: the stored window aggregates of a time range, rolled up to coarser windows in a table of their own."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from obslake.jobs.config import jdbc_properties, parser, paths
from obslake.operators.serving import check_time_range, utc
from obslake.operators.windows import merge_aggregates
from obslake.session import build_session
from obslake.sinks.aggregates import BY_DATE, upsert_aggregates
from obslake.sources.tables import read_aggregates

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def whole_windows(frm: datetime, to: datetime, width: timedelta) -> tuple[datetime, datetime]:
    """The range widened to whole windows, so that none is made of a part of its rows."""
    check_time_range(frm, to)
    first, last = (utc(t) - _EPOCH for t in (frm, to))
    return _EPOCH + first // width * width, _EPOCH + -(-last // width) * width


def rolled_up(table: DataFrame, frm: datetime, to: datetime, width: timedelta = timedelta(hours=1)) -> DataFrame:
    """Windows of ``width`` that begin from ``frm`` and end by ``to``, made of the finer ones in ``table``."""
    begin, end = (F.timestamp_micros(F.lit((t - _EPOCH) // timedelta(microseconds=1))) for t in whole_windows(frm, to, width))
    inside = table.where((F.col("window_start") >= begin) & (F.col("window_start") < end))
    return merge_aggregates(inside, f"{width // timedelta(seconds=1)} seconds")


def run(
    spark: SparkSession,
    source: str,
    target: str,
    frm: datetime,
    to: datetime,
    width: timedelta = timedelta(hours=1),
    stage: str | None = None,
) -> None:
    """Roll up a range and write it over what ``target`` holds of it; other windows stay.

    Only directories of the range are read.  A run that is repeated, or one after late rows, brings the
    same windows up to date.  A window whose rows are all gone from ``source`` keeps its old row.
    """
    if width % timedelta(seconds=1) or width < timedelta(seconds=1):
        raise ValueError("windows are whole seconds wide")
    rows = read_aggregates(spark, source, properties=jdbc_properties(), between=whole_windows(frm, to, width))
    upsert_aggregates(rolled_up(rows, frm, to, width), target, stage=stage, partitions=BY_DATE)


def main(argv: list[str] | None = None) -> None:
    p = parser(__doc__)
    p.add_argument("source", nargs="?", help="Parquet folder or JDBC URL of the aggregate table")
    p.add_argument("target", nargs="?")
    p.add_argument("--from", dest="frm", type=datetime.fromisoformat, required=True)
    p.add_argument("--to", type=datetime.fromisoformat, required=True)
    p.add_argument("--minutes", type=int, default=60, help="width of a window")
    args = p.parse_args(argv)
    where = paths(args.lake)
    run(
        build_session("obslake-rollup"), args.source or where["table"], args.target or where["rolled_up"],
        args.frm, args.to, timedelta(minutes=args.minutes),
    )


if __name__ == "__main__":
    main()
