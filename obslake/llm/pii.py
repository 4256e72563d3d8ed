"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from obslake.llm.columns import unused

SPAN = StructType(
    [
        StructField("kind", StringType()),
        StructField("start", LongType()),
        StructField("end", LongType()),
        StructField("score", DoubleType()),
        StructField("base", LongType()),
    ]
)
# In this order spans of different kinds with the same start are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
CONTEXT = 40
# Proposals of the kinds that are not base stay from this score on.
LEAST_SCORE = 0.5


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


def mod97(code: str) -> bool:
    """The check of an international account number: country and check digits moved to the end, letters as 10 to 35."""
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _small_parts(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def _social(text: str) -> bool:
    area, group, serial = text.split("-")
    return area not in {"000", "666"} and area < "900" and group != "00" and serial != "0000"


@dataclass(frozen=True)
class Kind:
    """``find`` proposes (start, end) from left to right; ``valid`` confirms; words nearby raise or lower ``score``."""

    name: str
    find: Callable[[str], Iterator[tuple[int, int]]]
    valid: Callable[[str], bool]
    score: float
    raising: re.Pattern
    lowering: re.Pattern


def _matches(pattern: str) -> Callable[[str], Iterator[tuple[int, int]]]:
    compiled = re.compile(pattern)
    return lambda text: (m.span() for m in compiled.finditer(text))


_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail pattern, found from each @ outwards: the work is in proportion to the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain and at > done:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                done = domain.end()
                yield start, done
        at = text.find("@", at + 1)


def _near(words: str) -> re.Pattern:
    return re.compile(rf"\b(?:{words})", re.IGNORECASE)


_NEVER = re.compile(r"(?!)")
# A number or word run is taken whole, so each pattern reads the text once.
KINDS = (
    Kind("email", _emails, lambda t: True, 0.8, _near("e-?mail|contact|write|mail"), _near("example|noreply")),
    Kind(
        "ip", _matches(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"), _small_parts, 0.6,
        _near("ip|host|server|address|login"), _near("version|release|section|chapter"),
    ),
    Kind(
        "card", _matches(r"[0-9](?:[ -]?[0-9])++"), _is_card, 0.7,
        _near("card|visa|credit|payment|master"), _near("order|invoice|isbn|serial"),
    ),
    Kind(
        "phone", _matches(r"\+[0-9][ ().0-9-]+[0-9]"), lambda t: 9 <= len(_digits(t)) <= 15, 0.6,
        _near("phone|tel|call|mobile|fax|whatsapp"), _near("score|offset|utc|gmt"),
    ),
    Kind(
        "iban", _matches(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
        lambda t: mod97(t.replace(" ", "")), 0.7, _near("iban|bank|account|konto|compte|cuenta"), _NEVER,
    ),
    Kind(
        "ssn", _matches(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"), _social, 0.3,
        _near("ssn|social|security"), _near("order|invoice|part|ticket"),
    ),
)
_NEEDS = {"email": "@", "phone": "+", "ssn": "-"}
RAISE, LOWER = 0.25, 0.25


def spans_of(text: str | None) -> list[tuple[str, int, int, float, int]]:
    """Confirmed spans by start, then kind: (kind, start, end, score, 1 if base else 0), in code points."""
    found = []
    for order, kind in enumerate(KINDS):
        if not text or _NEEDS.get(kind.name, "") not in text:
            continue
        for start, end in kind.find(text):
            if not kind.valid(text[start:end]):
                continue
            near = text[max(0, start - CONTEXT) : start] + " " + text[end : end + CONTEXT]
            score = kind.score + (RAISE if kind.raising.search(near) else 0) - (LOWER if kind.lowering.search(near) else 0)
            base = kind.name in BASE_KINDS
            if base or score >= LEAST_SCORE:
                found.append((start, order, (kind.name, start, end, round(min(1.0, max(0.0, score)), 4), int(base))))
    return [f[2] for f in sorted(found)]


@F.pandas_udf(ArrayType(SPAN))
def _spans(texts: pd.Series) -> pd.Series:
    return pd.Series([[dict(zip(SPAN.names, s)) for s in spans_of(t)] for t in texts], dtype=object)


def find_personal_data(docs: DataFrame, column: str = "spans") -> DataFrame:
    """All rows and columns, and ``column``: the spans of personal data in ``text``.

    A span has its kind, ``start`` and ``end`` in code points, a score from 0 to 1, and ``base``
    (1 for the kinds email, ip, card and phone).  Matches of a kind are leftmost and do not
    overlap; those that fail their check are dropped.  A word nearby that speaks for the kind
    raises the score and one that speaks against it lowers it.  Base spans stay whatever their
    score, others from 0.5 on.  Whole texts are read, and each pattern reads a text once.

    A null or empty text has no spans.  Rows are independent: repeated rows get the same spans,
    an empty table gives no rows.  A column of that name is replaced.
    """
    return docs.withColumn(column, _spans("text"))


def _line(text_spans: list[tuple]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, *_ in text_spans)


@F.pandas_udf(
    StructType(
        [
            *(StructField(f"n_{k}", LongType()) for k in BASE_KINDS),
            StructField("base_sha256", StringType()),
            StructField("spans", StringType()),
        ]
    )
)
def _digest(spans: pd.Series) -> pd.DataFrame:
    rows = []
    for own in spans:
        own = [(s["kind"], s["start"], s["end"], s["base"]) for s in own]
        base = [s for s in own if s[3]]
        counts = [sum(s[0] == k for s in base) for k in BASE_KINDS]
        rows.append((*counts, hashlib.sha256(_line(base).encode()).hexdigest(), _line(own)))
    return pd.DataFrame(rows, columns=[*(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"])


def personal_data_table(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_sha256``, ``spans`` (kind:start:end, joined)."""
    (spans,) = unused(docs.columns, "found")
    found = find_personal_data(docs.select("doc_id", "text"), spans)
    return found.select("doc_id", _digest(spans).alias(spans)).select("doc_id", f"{spans}.*")


def mask_personal_data(docs: DataFrame, spans: str = "spans") -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in angle brackets; overlapping spans by the first."""

    @F.pandas_udf(StringType())
    def masked(texts: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for text, own in zip(texts, found):
            if text is None or own is None or not len(own):
                out.append(text)
                continue
            parts, done = [], 0
            for s in own:
                if s["start"] >= done:
                    parts += [text[done : s["start"]], f"<{s['kind']}>"]
                    done = s["end"]
                elif s["end"] > done:
                    done = s["end"]
            out.append("".join(parts) + text[done:])
        return pd.Series(out, dtype=object)

    return docs.withColumn("text", masked("text", spans))
