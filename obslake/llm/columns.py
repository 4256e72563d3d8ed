"""Column names and rows shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores in front as keep it apart from ``columns``."""
    taken = {c.lower() for c in columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def without(df: DataFrame, *names: str) -> list[str]:
    """The columns of ``df`` other than ``names``, compared without case."""
    dropped = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in dropped]


def group_key(c: Column) -> Column:
    """A key that is never null: null and every text are different keys."""
    return F.coalesce(F.concat(F.lit("="), c), F.lit(""))


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with its rows dealt over at least as many partitions as the session shuffles to."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)
