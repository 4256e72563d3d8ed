"""Batch job: landed JSON lines to structured Parquet, a second copy and a JDBC table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obslake.jobs.config import jdbc_properties, parser, paths
from obslake.operators.external import external_transform
from obslake.session import build_session, cut_lineage
from obslake.sinks.files import write_external_parquet
from obslake.sinks.jdbc import MODES, write_jdbc
from obslake.sources.files import read_external_ndjson, read_external_sources


def run(
    spark: SparkSession,
    source: str,
    target: str,
    copy_to: str | None = None,
    jdbc_url: str | None = None,
    jdbc_table: str | None = None,
    jdbc_mode: str = "append",
    properties: dict[str, str] | None = None,
    per_source: bool = True,
) -> None:
    """Every landed line once; with ``per_source`` each source keeps its own shape, and one job writes them all."""
    read = read_external_sources(spark, source) if per_source else [read_external_ndjson(spark, source)]
    parts: list[DataFrame] = [external_transform(rows) for rows in read]
    to_database = jdbc_url is not None and jdbc_table is not None
    if copy_to or to_database:
        # All sinks get the same load time.
        parts = [cut_lineage(rows) for rows in parts]
    if parts:
        write_external_parquet(parts, target, copy_to)
    if to_database:
        for rows in parts:
            write_jdbc(rows, jdbc_url, jdbc_table, jdbc_mode, properties)


def main(argv: list[str] | None = None) -> None:
    p = parser(__doc__)
    p.add_argument("source", nargs="?")
    p.add_argument("target", nargs="?")
    p.add_argument("--copy-to", help="second Parquet target")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-table")
    p.add_argument("--jdbc-mode", default="append", choices=MODES)
    p.add_argument("--one-schema", action="store_true", help="infer one schema over all sources")
    args = p.parse_args(argv)
    lake = paths(args.lake)
    # Case-sensitive names: payload fields may differ in case alone.
    spark = build_session("obslake-external", {"spark.sql.caseSensitive": "true"})
    run(
        spark, args.source or lake["external_raw"], args.target or lake["external"], args.copy_to,
        args.jdbc_url, args.jdbc_table, args.jdbc_mode, jdbc_properties(), not args.one_schema,
    )


if __name__ == "__main__":
    main()
