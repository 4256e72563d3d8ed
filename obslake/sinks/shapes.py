"""Tables whose columns change from run to run: each physical column keeps one type for ever.

The columns that were written, and their types, are kept as small JSON files in ``_shapes``
beside the data (a name that readers of the table skip).  A column that comes with another type
is written under a name of its own; reading puts the parts of a column together again.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from obslake.functions.names import quoted
from obslake.sinks.paths import child_names, read_text, write_text

_FOLDER = "_shapes"
# From narrow to wide.
_NUMBERS = ["tinyint", "smallint", "int", "bigint", "float", "double"]
_INTEGERS = _NUMBERS[:4]
# Integers up to here are exact as doubles.
_EXACT = 1 << 53
Shapes = dict[str, dict[str, str]]


def kept_shapes(spark: SparkSession, path: str) -> Shapes:
    """For each column the physical columns that hold it, and their types as JSON."""
    shapes: Shapes = {}
    for name in child_names(spark, f"{path}/{_FOLDER}"):
        for column, parts in json.loads(read_text(spark, f"{path}/{_FOLDER}/{name}")).items():
            shapes.setdefault(column, {}).update(parts)
    return shapes


def _physical(column: str, kind: T.DataType, shapes: Shapes) -> str:
    known = shapes.get(column, {})
    for name, text in known.items():
        if T._parse_datatype_json_string(text).simpleString() == kind.simpleString():
            return name
    if not known:
        return column
    simple = kind.simpleString()
    # Normalized column names hold no such sign, so no column of the data is called like that.
    return f"{column}@{simple if simple.isalnum() else hashlib.sha256(simple.encode()).hexdigest()[:12]}"


def in_kept_types(parts: list[DataFrame], path: str, partitions: list[str]) -> DataFrame:
    """All rows under the physical names of the table at ``path``, whose shapes are noted first.

    The parts may differ in their columns and types; they become one DataFrame.
    """
    spark = parts[0].sparkSession
    shapes = kept_shapes(spark, path)
    fresh: Shapes = {}
    renamed = []
    for rows in parts:
        names = {}
        for f in rows.schema.fields:
            if f.name not in partitions:
                names[f.name] = _physical(f.name, f.dataType, shapes)
                if names[f.name] not in shapes.setdefault(f.name, {}):
                    shapes[f.name][names[f.name]] = f.dataType.json()
                    fresh.setdefault(f.name, {})[names[f.name]] = f.dataType.json()
        renamed.append(rows.select(*[F.col(quoted(c)).alias(names.get(c, c)) for c in rows.columns]))
    if fresh:
        write_text(spark, f"{path}/{_FOLDER}/{uuid.uuid4().hex}.json", json.dumps(fresh))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), renamed)


def _common(kinds: list[T.DataType]) -> str | None:
    """The type that holds all: the widest number, or None for text."""
    names = [k.simpleString() for k in kinds]
    if len(set(names)) == 1:
        return names[0]
    if not all(n in _NUMBERS for n in names):
        return None
    widest = max(names, key=_NUMBERS.index)
    # An integer of 32 bits is not exact as a float, but as a double.
    return "double" if widest == "float" and set(names) & set(_INTEGERS) else widest


def _inexact(rows: DataFrame, kinds: dict[str, dict[str, T.DataType]]) -> set[str]:
    """Columns that were integer and fractional and hold an integer that no double is equal to."""
    longs = {
        column: [n for n, k in parts.items() if k.simpleString() == "bigint"]
        for column, parts in kinds.items()
        if _common(list(parts.values())) == "double"
    }
    tests = {
        column: F.max(F.greatest(*[F.coalesce(~F.col(quoted(n)).between(-_EXACT, _EXACT), F.lit(False)) for n in names], F.lit(False)))
        for column, names in longs.items()
        if names
    }
    if not tests:
        return set()
    found = rows.agg(*[t.alias(f"c{i}") for i, t in enumerate(tests.values())]).first()
    return {column for column, wide in zip(tests, found) if wide}


def _as_text(part: str, kind: T.DataType) -> Column:
    nested = isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.VariantType))
    return F.to_json(F.col(quoted(part))) if nested else F.col(quoted(part)).cast("string")


def read_kept(spark: SparkSession, path: str, partitions: T.StructType) -> DataFrame:
    """The table with the union of all columns that were ever written; no file is opened for its schema.

    Numbers of several widths are read as the widest; a column that held other things as well is
    text.  So is one that was integer and fractional and holds integers beyond 2^53, which a double
    would change; only such mixed columns are looked at for that.
    """
    shapes = kept_shapes(spark, path)
    kinds = {c: {n: T._parse_datatype_json_string(t) for n, t in parts.items()} for c, parts in shapes.items()}
    physical = [T.StructField(n, k, True) for parts in kinds.values() for n, k in parts.items()]
    rows = spark.read.schema(T.StructType([*physical, *partitions.fields])).parquet(path)
    inexact = _inexact(rows, kinds)
    columns = []
    for column, parts in kinds.items():
        common = None if column in inexact else _common(list(parts.values()))
        merged = [
            _as_text(n, k) if common is None else F.col(quoted(n)) if k.simpleString() == common else F.col(quoted(n)).cast(common)
            for n, k in parts.items()
        ]
        columns.append((merged[0] if len(merged) == 1 else F.coalesce(*merged)).alias(column))
    return rows.select(*columns, *partitions.names)
