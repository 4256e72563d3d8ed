"""Column-name rules (driver side, schema only)."""

from __future__ import annotations

import re
from collections.abc import Iterable


def normalize_col_name(name: str) -> str:
    """Lower-case, and every character outside ``[a-z0-9_]`` becomes ``_``."""
    return re.sub(r"[^a-z0-9_]", "_", name.lower())


def unique_names(names: Iterable[str]) -> list[str]:
    """Keep the first use of a name; later ones get ``_2``, ``_3``... in order."""
    names = list(names)
    wanted = set(names)
    taken: set[str] = set()
    out = []
    for name in names:
        candidate, n = name, 1
        while candidate in taken or (n > 1 and candidate in wanted):
            n += 1
            candidate = f"{name}_{n}"
        taken.add(candidate)
        out.append(candidate)
    return out


def quoted(*parts: str) -> str:
    """Back-quoted column path, safe for dots, dashes and back-quotes in field names."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)
