"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Base kinds (email, ip, card, phone) are always reported once their validator passes. The
method adds kinds whose pattern alone is too weak (IBAN, social security number, national
phone number): a candidate starts with the prior of its kind, a checksum or range check
confirms or drops it, and words near it raise or lower the score; it is reported from
``MIN_SCORE`` on, unless a base span overlaps it (an IBAN is reported beside it). Every scan is linear in the text: the
patterns either cannot back up or are anchored at a character found by a search, so very long
runs of digits or letters are harmless.

Offsets are code points, ends exclusive; spans are sorted by start, then by kind in the order
of ``KINDS``. Edge cases: a null text is empty; an empty text has no spans and stays empty when
redacted; repeated rows get equal results; an empty table gives an empty result; all other
columns pass through untouched.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, table
from .spans import count_of, joined

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "local_phone")
MIN_SCORE = 0.6
CONTEXT_CHARS = 48
SPAN = "array<struct<kind:string,start:int,stop:int,score:double>>"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64())]))

#: Prior score of a confirmed candidate, and words near it that raise (first) or lower it.
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.8, "iban": 0.9, "ssn": 0.5, "local_phone": 0.4}
CONTEXT = {
    "email": (r"e-?mail|contact|courriel|correo|kontakt", r"example|noreply"),
    "ip": (r"\bip\b|address|host|server|adresse", r"version|release|section"),
    "card": (r"card|visa|credit|carte|karte|tarjeta", r"isbn|order|serial"),
    "phone": (r"phone|call|tel|mobile|fax|telefon|téléphone|teléfono", r"isbn|serial"),
    "iban": (r"iban|bank|account|konto|compte|cuenta", r"serial|part number"),
    "ssn": (r"\bssn\b|social security", r"isbn|serial|order|part"),
    "local_phone": (r"phone|call|tel|mobile|fax", r"isbn|serial|order|part"),
}
_NEAR = {k: (re.compile(a, re.I), re.compile(b, re.I)) for k, (a, b) in CONTEXT.items()}

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}))")
#: Lengths of the countries in the IBAN registry.
IBAN_LENGTH = {
    c: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for c in countries.split()
}
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+])\([0-9]{3}\)[\x20-]?[0-9]{3}[\x20-][0-9]{4}(?![0-9-])")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    """Luhn checksum over ASCII digits."""
    twice = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in twice)) % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 7064 mod 97-10 over an IBAN without spaces."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, floor = text.find("@"), 0
    while at >= 0:
        part = text[floor:at]
        start = len(part.rstrip(_LOCAL)) + floor
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        floor = m.end() if m else at + 1
        at = text.find("@", floor)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _DOTTED.finditer(text):
        parts, start = m.group().split("."), m.start()
        for k in range(0, len(parts) - 3, 4):  # four parts at a time, as a scan takes them
            four = parts[k : k + 4]
            stop = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, stop
            start = stop + 1


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "") if m.end() - m.start() < 40 else ""
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """At its country's length, or at the longest end of a word if the country is not in the registry."""
    floor = 0
    for m in _IBAN.finditer(text):
        start, run = m.start(), m.group(1)
        if start < floor:
            continue
        places = [i for i, c in enumerate(run) if c != " "]
        size = IBAN_LENGTH.get(run[:2])
        for n in range(len(places), 14, -1) if size is None else (size,) if size <= len(places) else ():
            stop = start + places[n - 1] + 1
            if not (stop < len(text) and text[stop].isascii() and text[stop].isalnum()) and mod97(run[: stop - start].replace(" ", "")):
                yield start, stop
                floor = stop
                break


def _ssns(text: str) -> Iterator[tuple[int, int]]:
    for m in _SSN.finditer(text):
        area, group, serial = m.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


def _local_phones(text: str) -> Iterator[tuple[int, int]]:
    return (m.span() for m in _LOCAL_PHONE.finditer(text))


def score(text: str, kind: str, start: int, stop: int) -> float:
    """The kind's prior, moved by the words within ``CONTEXT_CHARS`` of the span."""
    around = text[max(0, start - CONTEXT_CHARS) : start] + " \n " + text[stop : stop + CONTEXT_CHARS]
    good, bad = _NEAR[kind]
    return round(min(1.0, max(0.0, PRIOR[kind] + 0.3 * bool(good.search(around)) - 0.3 * bool(bad.search(around)))), 3)


def find(text: str) -> list[tuple[str, int, int, float]]:
    """``(kind, start, stop, score)`` of every span of one whole text."""
    found = [("email", *s) for s in _emails(text)] if "@" in text else []
    extra: list[tuple[str, int, int]] = []
    if _DIGIT.search(text):
        found += [("ip", *s) for s in _ips(text)]
        found += [("card", *s) for s in _cards(text)]
        found += [("phone", *s) for s in _phones(text)] if "+" in text else []
        extra += [("iban", *s) for s in _ibans(text)]
        if "-" in text:
            extra += [("ssn", *s) for s in _ssns(text)]
        if "(" in text:
            extra += [("local_phone", *s) for s in _local_phones(text)]
    out = [(k, a, b, score(text, k, a, b)) for k, a, b in found]
    if extra:
        base = sorted((a, b) for _, a, b in found)
        starts, reach = [a for a, _ in base], list(accumulate((b for _, b in base), max))
        for k, a, b in extra:
            before = bisect_left(starts, b)  # base spans that start before this one ends
            # The checksum of an IBAN is stronger than that of a card within it.
            if (k == "iban" or not (before and reach[before - 1] > a)) and (s := score(text, k, a, b)) >= MIN_SCORE:
                out.append((k, a, b, s))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def mask(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """The text with each span, or union of overlapping ones, replaced by ``<KIND>``."""
    out, at = [], 0
    for kind, a, b, _ in spans:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def _spans_of(texts: pa.Array) -> pa.Array:
    names = ("kind", "start", "stop", "score")
    return pa.array([[dict(zip(names, s)) for s in find(t.as_py() or "")] for t in texts], type=_ARROW)


def _masked(texts: pa.Array) -> pa.Array:
    whole = (t.as_py() for t in texts)
    return pa.array([t if t is None else mask(t, find(t)) for t in whole], type=pa.string())


def find_pii(docs: DataFrame, text_col: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with ``out``: the spans of every whole text and their scores."""
    prepare(docs.sparkSession)
    return docs.withColumn(out, F.arrow_udf(_spans_of, SPAN)(F.col(text_col)))


def redact_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind; a null text stays null."""
    prepare(docs.sparkSession)
    return docs.withColumn(text_col, F.arrow_udf(_masked, "string")(F.col(text_col)))


def q_op1_pii(spark, sf_dir) -> DataFrame:
    """Personal data of every document: counts, digest of the base spans and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_pii(docs).select("doc_id", "spans")
    return found.select(
        "doc_id",
        *(count_of("spans", k).alias(f"n_{k}") for k in BASE),
        F.sha2(joined("spans", BASE), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )
