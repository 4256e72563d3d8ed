"""JDBC copy of structured external rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from obslake.operators.external import scalarize_for_jdbc

MODES = ("append", "overwrite", "ignore")


def jdbc_mode(mode: str) -> str:
    """A supported save mode; anything else is an error."""
    if mode not in MODES:
        raise ValueError(f"unsupported JDBC mode {mode!r}; use one of {', '.join(MODES)}")
    return mode


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", properties: dict[str, str] | None = None) -> None:
    """Nested columns become JSON text, then the rows go to ``table``."""
    scalarize_for_jdbc(df).write.mode(jdbc_mode(mode)).jdbc(url, table, properties=properties or {})
