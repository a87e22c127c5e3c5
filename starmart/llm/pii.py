"""Personal data: patterns propose, checksums confirm, context scores (operator 4).

Base kinds (email, ip, card, phone) are found exactly as their patterns say,
leftmost and non-overlapping per kind. Added kinds are IBANs (mod-97), US social
security numbers (number rules) and labelled birth dates (context words needed).
Every span has a score: the base confidence of its kind, raised by context words
in the ``CONTEXT_CHARS`` before it. Base spans stay whatever their score; added
ones stay from ``LEAST_SCORE`` on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds in the order in which spans are listed, and their patterns.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "birth")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_BIRTH = re.compile(r"(?<![0-9])[0-9]{1,4}[./-][0-9]{1,2}[./-][0-9]{1,4}(?![0-9])")
_DIGIT_RUN = re.compile(r"[0-9](?:[\x20-]?[0-9]){12}")
CONFIDENCE = {
    "email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.4, "birth": 0.2,
}
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto"),
    "ssn": ("ssn", "social security"),
    "birth": ("born", "birth", "dob", "geboren", "né le", "nacido"),
}
CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.3
LEAST_SCORE = 0.5
MASK = "[{}]"


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @: the run of name characters before it and the domain after.
    Walking from the @ keeps long runs without one linear."""
    taken, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > taken and (text[begin - 1] in _LOCAL):
            begin -= 1
        domain = _DOMAIN.match(text, at) if begin < at else None
        if domain:
            yield begin, domain.end()
        # No name contains an @, so the next one cannot reach back before this.
        taken = domain.end() if domain else at + 1
        at = text.find("@", taken)


_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        # A part of over three digits may only have leading zeros.
        if all(int(p.lstrip("0")[:4] or 0) <= 255 for p in m[0].split(".")):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    if not _DIGIT_RUN.search(text):
        return
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in _IBAN.finditer(text):
        if mod97(m[0].replace(" ", "")):
            yield m.span()


def _ssns(text: str) -> Iterator[tuple[int, int]]:
    for m in _SSN.finditer(text):
        area, group, serial = m.groups()
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


def _births(text: str) -> Iterator[tuple[int, int]]:
    for m in _BIRTH.finditer(text):
        yield m.span()


_FINDERS = {
    "email": _emails, "ip": _ips, "card": _cards, "phone": _phones,
    "iban": _ibans, "ssn": _ssns, "birth": _births,
}


def find_spans(text: str | None) -> list[Span]:
    """Spans by kind in the order of KINDS, then start. Null and empty: none."""
    if not text:
        return []
    spans = []
    for kind in KINDS:
        for start, end in _FINDERS[kind](text):
            before = text[max(0, start - CONTEXT_CHARS) : start].lower()
            near = any(word in before for word in CONTEXT[kind])
            score = min(1.0, CONFIDENCE[kind] + CONTEXT_BONUS * near)
            if kind in BASE_KINDS or score >= LEAST_SCORE:
                spans.append(Span(kind, start, end, round(score, 3)))
    return spans


def masked(text: str | None, spans: list[Span]) -> str | None:
    """``text`` with each span replaced by its kind; of overlapping spans the
    first, and the longer of two with one start, names the joint stretch."""
    if not spans:
        return text
    parts, at, open_to = [], 0, 0
    for span in sorted(spans, key=lambda s: (s.start, -s.end)):
        if span.start >= open_to:
            parts += [text[at : span.start], MASK.format(span.kind.upper())]
        open_to = at = max(open_to, span.end)
    return "".join([*parts, text[at:]])


def listed(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def find_pii(docs: DataFrame, text_col: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with a column ``out``: array of (kind, start, end, score), ends
    exclusive, in code points of the whole text; empty for null and empty texts.
    An input column of that name is replaced."""

    @F.pandas_udf("array<struct<kind: string, start: int, end: int, score: double>>")
    def find(texts: pd.Series) -> pd.Series:
        return pd.Series([[s._asdict() for s in find_spans(t)] for t in texts], dtype=object)

    return docs.withColumn(out, find(F.col(text_col)))


def mask_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind."""

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        return pd.Series([masked(t, find_spans(t)) for t in texts], dtype=object)

    return docs.withColumn(text_col, mask(F.col(text_col)))
