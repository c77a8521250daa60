"""Personal data: regular expressions propose spans, checksums confirm them, nearby
context words move the score.

Base kinds (always reported): email, ip, card (Luhn), phone.  Added kinds: iban
(mod-97) and ssn (needs a context word to reach the threshold).  Spans are code
point offsets into the whole text, end exclusive.  A null text is empty: zero
counts, no spans.  Repeated rows each get a row; extra columns are ignored (or
carried through by ``redact``).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquia.llm.common import batches, prepare

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]
CONTEXT_CHARS = 48
THRESHOLD = 0.5

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit run is entered at its start only: a match ends at a run's end, so no
# later match can begin inside one.
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Characters of an IBAN by country, from the public registry.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22,
    "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18,
    "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SD": 18,
    "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22,
    "VG": 24, "XK": 20}


def _iban(length: int) -> str:
    """Country, check digits, and groups of four (with or without blanks) to that length."""
    countries = "|".join(c for c, n in IBAN_LENGTHS.items() if n == length)
    groups, rest = divmod(length - 4, 4)
    tail = rf"\x20?[A-Z0-9]{{{rest}}}" if rest else ""
    return rf"(?:{countries})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{groups}}}{tail}"


IBAN = rf"\b(?:{'|'.join(map(_iban, sorted(set(IBAN_LENGTHS.values()))))})\b"
SSN = r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"
_IBAN, _SSN = re.compile(IBAN, re.ASCII), re.compile(SSN, re.ASCII)
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: Score of a confirmed span, and words nearby that raise it.
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
CONTEXT = {
    "email": ("mail", "contact", "write to", "correo", "courriel"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security", "tax id"),
}
NEAR = {k: r"\b(?:" + "|".join(w) + r")\b" for k, w in CONTEXT.items()}
CONTEXT_BONUS = 0.3
_NEAR = {k: re.compile(p, re.ASCII) for k, p in NEAR.items()}
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Span(NamedTuple):
    start: int
    kind: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if i % 2:
            v = v * 2 - 9 * (v > 4)
        total += v
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 7064: the first four characters go to the end, letters count from 10."""
    s = iban[4:] + iban[:4]
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local@domain.  The local part cannot hold an @, so each match is
    the run of local characters before an @ (not before the previous match's end)."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = start < at and _DOMAIN.match(text, at + 1)
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _confirmed(text: str) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) that pass their kind's check."""
    for s, e in _emails(text):
        yield 0, s, e
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.groups()):
            yield 1, m.start(), m.end()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield 2, m.start(), m.end()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(map(m[0].count, "0123456789")) <= 15:
                yield 3, m.start(), m.end()
    for m in _IBAN.finditer(text):
        if mod97(m[0].replace(" ", "")):
            yield 4, m.start(), m.end()
    for m in _SSN.finditer(text):
        area = m[0][:3]
        if area not in ("000", "666") and area[0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000":
            yield 5, m.start(), m.end()


def find_spans(text: str) -> list[Span]:
    """All spans at or above the threshold, by start, then kind as listed.

    A confirmed base span stays whatever its context.  The context is the
    ``CONTEXT_CHARS`` characters on both sides."""
    out = []
    for kind, s, e in _confirmed(text):
        name = KINDS[kind]
        near = text[max(0, s - CONTEXT_CHARS):s] + " " + text[e:e + CONTEXT_CHARS]
        score = min(1.0, PRIOR[name] + (CONTEXT_BONUS if _NEAR[name].search(near.translate(_LOWER)) else 0.0))
        if kind < len(BASE_KINDS) or score >= THRESHOLD:
            out.append(Span(s, kind, e, score))
    out.sort()
    return out


def span_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[x.kind]}:{x.start}:{x.end}" for x in spans)


def detect(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans``: array of (kind, start, end, score) per row of ``docs``."""
    prepare(docs.sparkSession)
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            found = [[(KINDS[x.kind], x.start, x.end, x.score) for x in find_spans(t.as_py() or "")]
                     for t in b.column(1)]
            rows = pa.array([[dict(zip(("kind", "start", "end", "score"), x)) for x in f] for f in found],
                            pa.list_(kind))
            yield pa.RecordBatch.from_arrays([b.column(0), rows], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, spans array<struct<kind:string,start:long,end:long,score:double>>")


def digest(docs: DataFrame) -> DataFrame:
    """Counts, the hash of the base spans and all spans with their scores, per row."""
    prepare(docs.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            cols: list[list] = [[] for _ in range(7)]
            for t in b.column(1):
                spans = find_spans(t.as_py() or "")
                base = [x for x in spans if x.kind < len(BASE_KINDS)]
                for k in range(4):
                    cols[k].append(sum(x.kind == k for x in base))
                cols[4].append(hashlib.sha256(span_text(base).encode()).hexdigest())
                cols[5].append(span_text(spans))
                cols[6].append(",".join(f"{x.score:.2f}" for x in spans))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in cols[:4]), *(pa.array(c, pa.string()) for c in cols[4:])],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "scores"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
             "spans string, scores string")


def mask(text: str) -> str:
    """``text`` with every span (overlapping ones merged) replaced by <KIND>."""
    out, done = [], 0
    for x in find_spans(text):
        if x.start >= done:
            out += [text[done:x.start], f"<{KINDS[x.kind].upper()}>"]
        done = max(done, x.end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; ``n_chars`` follows the text.

    All rows and columns stay; a null text stays null."""
    prepare(docs.sparkSession)
    at = docs.columns.index("text")
    size = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            cols = list(b.columns)
            old = cols[at].to_pylist()
            new = [t if t is None else mask(t) for t in old]
            cols[at] = pa.array(new, cols[at].type)
            if size is not None:
                lengths = [n if a == b_ else len(b_) for n, a, b_ in zip(cols[size].to_pylist(), old, new)]
                cols[size] = pa.array(lengths, cols[size].type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return docs.mapInArrow(run, docs.schema)
