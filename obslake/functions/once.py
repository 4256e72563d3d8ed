"""Keeping an expensive expression from being copied by the optimizer."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def evaluated_once(expr: Column) -> Column:
    """A generator that yields the one value of ``expr``.

    The optimizer pushes a filter on a computed column below the projection by
    copying the expression into the filter, once per use: text would be parsed
    several times per row.  A filter does not move below a generator.
    """
    return F.explode(F.array(expr))
