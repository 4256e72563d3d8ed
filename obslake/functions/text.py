"""Text helpers with the trimming rules of the wire formats."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters dropped by "trim" (every code point up to U+0020)
# and those counted as white space by "strip" and by blank checks (tab to carriage
# return, the separators 1C-1F, and the Unicode space, line and paragraph separators
# other than the no-break ones).
TRIM_CHARS = "".join(chr(i) for i in range(0x21))
WHITESPACE_CODES = [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x1680, *range(0x2000, 0x2007),
    *range(0x2008, 0x200B), 0x2028, 0x2029, 0x205F, 0x3000,
]
WHITESPACE_CHARS = "".join(chr(i) for i in WHITESPACE_CODES)


def trim_control(c: Column) -> Column:
    """Drop every character up to U+0020 (tabs and newlines too) at both ends."""
    return F.btrim(c, F.lit(TRIM_CHARS))


def strip_whitespace(c: Column) -> Column:
    """Drop Unicode white space at both ends."""
    return F.btrim(c, F.lit(WHITESPACE_CHARS))


def is_blank(c: Column) -> Column:
    """True for null and for text made of white space only."""
    return F.coalesce(strip_whitespace(c) == "", F.lit(True))


def fails_not_blank(c: Column) -> Column:
    """True where a not-blank constraint fails: null, or nothing left after ``trim_control``."""
    return F.coalesce(trim_control(c) == "", F.lit(True))
