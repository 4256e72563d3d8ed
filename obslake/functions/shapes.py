"""Shapes of JSON found by ``schema_of_variant_agg``, as types to read with (driver side, types only)."""

from __future__ import annotations

import re

from pyspark.sql import types as T

from obslake.functions.names import quoted


def _settled(kind: T.DataType) -> T.DataType | None:
    """The type a column gets; None for an object without fields."""
    if isinstance(kind, T.StructType):
        fields = [(f.name, _settled(f.dataType)) for f in kind.fields]
        kept = [T.StructField(n, k, True) for n, k in fields if k is not None]
        return T.StructType(kept) if kept else None
    if isinstance(kind, T.ArrayType):
        element = _settled(kind.elementType)
        return None if element is None else T.ArrayType(element)
    if isinstance(kind, T.DecimalType):
        # Fractions are doubles; integers too large for a long keep their digits.
        return T.DoubleType() if kind.scale or kind.precision < 19 else kind
    if isinstance(kind, T.FloatType):
        return T.DoubleType()
    # Values of several kinds, or null throughout, are text.
    return T.StringType() if isinstance(kind, (T.VariantType, T.NullType)) else kind


def type_of_shape(shape: str | None) -> T.DataType | None:
    """The type for a shape such as ``OBJECT<a: BIGINT, `b c`: ARRAY<VOID>>``; None when there is nothing to read."""
    if shape is None or shape == "VOID":
        return None
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], shape)
    return _settled(T._parse_datatype_string(ddl))


def ddl(kind: T.DataType) -> str:
    """The type as text with every field name quoted."""
    if isinstance(kind, T.StructType):
        return "struct<" + ", ".join(f"{quoted(f.name)}: {ddl(f.dataType)}" for f in kind.fields) + ">"
    if isinstance(kind, T.ArrayType):
        return f"array<{ddl(kind.elementType)}>"
    return kind.simpleString()
