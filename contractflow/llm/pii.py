"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust their score."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

#: The kinds whose spans a score cannot remove, in the order of their digest.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "imei", "routing", "dni", "nir", "secret")
#: Words that make a proposed span of the kind likelier when they stand near it.
CONTEXT = {
    "email": ("mail", "contact"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "mastercard", "credit", "debit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank"),
    "ssn": ("ssn", "social", "security"),
    "imei": ("imei", "device", "handset"),
    "routing": ("routing", "aba", "bank", "transit"),
    "dni": ("dni", "nif", "documento", "identidad"),
    "nir": ("nir", "insee", "secu", "sociale", "social"),
    "secret": ("token", "secret", "password", "passwd", "pwd", "key", "apikey", "auth", "bearer", "credential", "credentials"),
}
#: What a confirmed span of the kind scores more. A check digit that one number in ten passes by chance needs a context word as well;
#: a form without any checksum needs it even more.
CONFIRMED = {**dict.fromkeys((*BASE, "iban", "nir"), 0.4), **dict.fromkeys(("imei", "routing", "dni"), 0.15), "ssn": 0.0, "secret": 0.0}
SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]++")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can only begin where a run of digits begins: starts inside a run would fail for the same reason as the run itself.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NUMBER = re.compile(r"(?<![0-9])[0-9]++(?![0-9])")
_DNI = re.compile(r"(?<![0-9A-Za-z])[0-9]{8}-?[A-Z](?![0-9A-Za-z])")
_NIR = re.compile(r"(?<![0-9])[12] ?[0-9]{2} ?[01][0-9] ?[0-9]{2} ?[0-9]{3} ?[0-9]{3} ?[0-9]{2}(?![0-9])")
_SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}")
_NEAR_WORD = re.compile(r"[a-z]+")


@dataclass(frozen=True)
class Scoring:
    """Scores of a proposed span: at first, and what a context word adds (a checksum adds what its kind says); the least that is kept."""

    proposed: float = 0.4
    context: float = 0.3
    keep: float = 0.6
    window: int = 40


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def routing(number: str) -> bool:
    """Weights 3, 7 and 1 over the nine digits of a bank's routing number."""
    return number != "000000000" and sum(int(d) * (3, 7, 1)[i % 3] for i, d in enumerate(number)) % 10 == 0


def dni(number: str) -> bool:
    """The letter behind eight digits is chosen by their remainder by 23."""
    return "TRWAGMYFPDXBNJZSQVHLCKE"[int(number[:8]) % 23] == number[-1]


def nir(number: str) -> bool:
    """The last two of fifteen digits complete the others to a multiple of 97."""
    return 97 - int(number[:13]) % 97 == int(number[13:])


def opaque(text: str) -> bool:
    """Letters and digits mixed, as in keys and tokens, and not one long word or number."""
    body = text.rstrip("=")
    digits = sum(map(str.isdecimal, body))
    return 3 <= digits < len(body) and sum(map(str.isalpha, body)) >= 3 and len(set(body)) >= 8


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses, found from each @ outwards, so that long runs without one cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        end = at + 1
        if domain:
            yield start, (end := domain.end())
            done = end
        else:
            done = max(done, end)  # nothing before a failed @ can be part of a later address: @ is in neither half
        at = text.find("@", end)


def _digits(text: str) -> str:
    return "".join(filter(str.isdecimal, text))


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    m = _IBAN.search(text)
    while m:
        ends = [m.end(), *(m.start() + i for i, c in reversed(list(enumerate(m[0]))) if c == " ")]
        after = ends[-1]  # nothing accepted: another may begin behind the first group
        for end in ends:  # a following word in capitals may have been taken in: give it back group by group
            value = text[m.start() : end].replace(" ", "")
            if 15 <= len(value) <= 34 and mod97(value):
                yield m.start(), end
                after = end
                break
        m = _IBAN.search(text, after)


def proposals(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """Spans (kind, start, end, confirmed by a checksum or by its value), by kind and start."""
    if "@" in text:
        yield from (("email", *span, True) for span in emails(text))
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            yield "ip", *m.span(), True
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield "card", *m.span(), True
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                yield "phone", *m.span(), True
    yield from (("iban", *span, True) for span in _ibans(text))
    yield from (("ssn", *m.span(), False) for m in _SSN.finditer(text))
    numbers = [m for m in _NUMBER.finditer(text) if m.end() - m.start() in (9, 15)]
    yield from (("imei", *m.span(), True) for m in numbers if len(m[0]) == 15 and luhn(m[0]))
    yield from (("routing", *m.span(), True) for m in numbers if len(m[0]) == 9 and routing(m[0]))
    yield from (("dni", *m.span(), True) for m in _DNI.finditer(text) if dni(m[0].replace("-", "")))
    yield from (("nir", *m.span(), True) for m in _NIR.finditer(text) if nir(_digits(m[0])))
    yield from (("secret", *m.span(), False) for m in _SECRET.finditer(text) if opaque(m[0]))


def find(text: str | None, scoring: Scoring = Scoring()) -> list[dict]:
    """The spans of a text (null: none) whose score is high enough; those of the base kinds always stay."""
    out, text = [], text or ""
    for kind, start, end, confirmed in proposals(text):
        near = text[max(0, start - scoring.window) : start] + " " + text[end : end + scoring.window]
        known = not CONTEXT[kind] or not set(_NEAR_WORD.findall(near.lower())).isdisjoint(CONTEXT[kind])
        score = min(1.0, scoring.proposed + CONFIRMED[kind] * confirmed + scoring.context * known)
        if kind in BASE or score >= scoring.keep:
            out.append({"kind": kind, "start": start, "end": end, "score": round(score, 4)})
    return out


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text", scoring: Scoring = Scoring()) -> DataFrame:
    """Spans of personal data of every document: key, ``spans`` (kind, start, end in code points, score).

    One row per input row, repeated and null keys included; a null or empty text has no spans; other columns are
    not read. Each text is handled whole, by one pass of linear expressions.
    """
    schema = frame_schema(docs, key)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def work(batch: pa.RecordBatch):
        spans = [find(t.as_py(), scoring) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=[key, "spans"])

    return map_batches(docs.select(key, text), work, schema)


def frame_schema(docs: DataFrame, key: str) -> str:
    return f"`{key}` {docs.schema[key].dataType.simpleString()}, spans {SPANS}"


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document: counts of the base kinds, the digest of their spans, all spans as text, n_other (spans of other kinds), score (the best, or 0)."""
    written = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        key,
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(written(of(*BASE)).cast("binary"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["kind"].isin(*BASE))).cast("long").alias("n_other"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"),
    )
