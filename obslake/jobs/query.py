"""Serve the stored aggregates: ranges, series and file listings as JSON lines."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from obslake.jobs.config import jdbc_properties, parser, paths
from obslake.operators.serving import query_aggregates, query_series
from obslake.session import build_session
from obslake.sources.files import list_data_files
from obslake.sources.tables import read_aggregates


def answer(spark: SparkSession, args) -> DataFrame:
    where = paths(args.lake)
    if args.what == "files":
        return list_data_files(spark, where["aggregated"], args.prefix).select("name")
    table = read_aggregates(spark, args.source or where["table"], properties=jdbc_properties(), between=(args.frm, args.to))
    find = query_aggregates if args.what == "aggregates" else query_series
    return find(table, args.metric, args.service, args.frm, args.to)


def json_lines(df: DataFrame) -> Iterator[str]:
    """The answer as text, one partition at a time."""
    return (row["j"] for row in df.selectExpr("to_json(struct(*)) AS j").toLocalIterator())


def main(argv: list[str] | None = None) -> None:
    p = parser(__doc__)
    p.add_argument("what", choices=["aggregates", "series", "files"])
    p.add_argument("--source", help="Parquet folder or JDBC URL of the aggregate table")
    p.add_argument("--metric")
    p.add_argument("--service")
    p.add_argument("--from", dest="frm", type=datetime.fromisoformat)
    p.add_argument("--to", type=datetime.fromisoformat)
    p.add_argument("--prefix", default="")
    args = p.parse_args(argv)
    for line in json_lines(answer(build_session("obslake-query"), args)):
        print(line)


if __name__ == "__main__":
    main()
