"""Personal data: fixed patterns, and identifiers in disguise found through an offset-preserving transducer.

The transducer rewrites a text piece by piece (look-alike letters and digits, zero-width marks, spelled
digits, ``(at)`` and ``[dot]`` disguises) and remembers for every output character the source characters
it came from. The patterns run on its output; a span found there is mapped back to source characters and
added unless it lies inside a span of the same kind that the plain text already gave.

Odd input: null is empty and has no spans; repeated rows are kept; other columns are ignored (``redact``
keeps them). Offsets are code points, end exclusive.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import per_batch, sha256

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_MAIL_RUN = re.compile(r"[A-Za-z0-9._%+@-]+")
# an address can only begin where a run of digits begins, the run being greedy
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, in linear time."""
    out = []
    run_end = 0
    at = text.find("@")
    while at >= 0:
        if at >= run_end:  # a new run of address characters
            start = at
            while start > run_end and _MAIL_RUN.match(text[start - 1]):
                start -= 1
            run_end = _MAIL_RUN.match(text, at).end()
        domain = _DOMAIN.match(text, at + 1) if at > start else None
        if domain:
            out.append((start, domain.end()))
            start = domain.end()
        else:
            start = at + 1
        at = text.find("@", start)
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def detect(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by the fixed patterns, ordered by start and kind."""
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                found.append(("phone", m.start(), m.end()))
    return _ordered(found)


def _ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


# Letters of other scripts that look like Latin ones, and their Latin forms
_LOOKALIKE = dict(
    zip(
        "аеорсухіјѕԁһԛԝАВЕКМНОРСТУХІЈЅαορνικΑΒΕΖΗΙΚΜΝΟΡΤΥΧı",
        "aeopcyxijsdhqwABEKMHOPCTYXIJSaopvikABEZHIKMNOPTYXi",
    )
)
_LOOKALIKE |= {chr(0xFF01 + k): chr(0x21 + k) for k in range(94)}  # full-width forms
for _zero in (0x0660, 0x06F0, 0x0966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6):  # digits of other scripts
    _LOOKALIKE |= {chr(_zero + k): str(k) for k in range(10)}
_LOOKALIKE |= dict.fromkeys("\u2010\u2011\u2012\u2013\u2014\u2212\ufe63", "-")
_LOOKALIKE |= dict.fromkeys("\u00a0\u2002\u2003\u2007\u2009\u200a\u202f\u3000", " ")
_LOOKALIKE |= dict.fromkeys("\u3002\u2024\ufe52\uff61", ".")
_LOOKALIKE |= dict.fromkeys("\u200b\u200c\u200d\u2060\ufeff\u00ad", "")
_LOOKALIKE |= {"﹫": "@"}
_ODD = re.compile("[" + re.escape("".join(_LOOKALIKE)) + "]")

_DIGITS = "zero one two three four five six seven eight nine".split()
_VALUE = {w: str(k) for k, w in enumerate(_DIGITS)} | {"oh": "0"}
_SPELL = "|".join((*_DIGITS, "oh"))
# at least four digits in a row, one or more of them spelled, count as spelled digits
_SPELLED = re.compile(
    rf"\b(?:plus[ ,-]+)?(?:(?:{_SPELL})\b|[0-9]+)(?:[ ,.-]{{1,2}}(?:(?:dot|point)[ ,-]+)?(?:(?:{_SPELL})\b|[0-9]+)){{3,}}",
    re.IGNORECASE,
)
_SPELLED_PART = re.compile(rf"\b(plus)[ ,-]+|[ ,-]*\b(dot|point)\b[ ,-]*|\b({_SPELL})\b", re.IGNORECASE)
_BRACKETED = re.compile(r"\s*(?:[\[({<]\s*(at|dot|@|\.)\s*[\])}>]|[_-](at|dot)[_-])\s*", re.IGNORECASE)
# bare words count only in the whole form "name at host dot domain"
_BARE = re.compile(
    r"[A-Za-z0-9._%+-]+(\s+at\s+)[A-Za-z0-9-]+((?:(?:\s+dot\s+|\.)[A-Za-z0-9-]+)*?)(\s+dot\s+)[A-Za-z]{2,}", re.IGNORECASE
)
_HOST_DOT = re.compile(r"@[A-Za-z0-9.-]+(\s+dot\s+)[A-Za-z0-9-]+", re.IGNORECASE)
_SPACED = re.compile(r"(?<=[A-Za-z0-9])( ?@ ?)(?=[A-Za-z0-9-]+( ?\. ?)[A-Za-z]{2,})")
_NUMERIC_DOT = re.compile(r"(?<=[0-9])\s*(?:[\[({]\s*(?:dot|\.)\s*[\])}]|\bdot\b)\s*(?=[0-9])", re.IGNORECASE)


class Mapped:
    """A rewritten text with, per character, the source span it stands for."""

    def __init__(self, text: str, start: list[int] | range, end: list[int] | range):
        self.text, self.start, self.end = text, start, end

    def replace(self, cuts: list[tuple[int, int, str]]) -> Mapped:
        """Non-overlapping pieces (from, to, new text) in order; new characters stand for the whole piece."""
        if not cuts:
            return self
        text, start, end, at = [], [], [], 0
        for a, b, new in cuts:
            text += [self.text[at:a], new]
            start += self.start[at:a]
            end += self.end[at:a]
            if b > a:
                start += [self.start[a]] * len(new)
                end += [self.end[b - 1]] * len(new)
            at = b
        text.append(self.text[at:])
        start += self.start[at:]
        end += self.end[at:]
        return Mapped("".join(text), start, end)


def normalise(text: str) -> Mapped | None:
    """The rewritten text, or None where nothing is rewritten."""
    out = Mapped(text, range(len(text)), range(1, len(text) + 1))
    if not text.isascii():
        out = out.replace([(m.start(), m.end(), _LOOKALIKE[m.group()]) for m in _ODD.finditer(text)])
    low = out.text.lower() if len(out.text.lower()) == len(out.text) else out.text
    if any(w in low for w in _VALUE if w != "oh") or ("plus" in low):
        cuts = []
        for run in _SPELLED.finditer(out.text):
            for m in _SPELLED_PART.finditer(out.text, run.start(), run.end()):
                new = "+" if m[1] else "." if m[2] else _VALUE[m[3].lower()]
                cuts.append((m.start(), m.end(), new))
        out = out.replace(cuts)
    if "at" in low or "dot" in low or "@" in low:
        out = out.replace([(m.start(), m.end(), ".") for m in _NUMERIC_DOT.finditer(out.text)])
        cuts = []
        for m in _BRACKETED.finditer(out.text):
            cuts.append((m.start(), m.end(), "@" if (m[1] or m[2]).lower() in ("at", "@") else "."))
        out = out.replace(cuts)
        if "dot" in low:
            cuts = []
            for m in _BARE.finditer(out.text):
                cuts.append((m.start(1), m.end(1), "@"))
                cuts += [(m.start(2) + d.start(), m.start(2) + d.end(), ".") for d in re.finditer(r"(?i)\s+dot\s+", m[2])]
                cuts.append((m.start(3), m.end(3), "."))
            out = out.replace(cuts)
            while m := _HOST_DOT.search(out.text):
                out = out.replace([(m.start(1), m.end(1), ".")])
        cuts = []
        for m in _SPACED.finditer(out.text):
            if len(m[1]) + len(m[2]) > 2:
                cuts += [(m.start(1), m.end(1), "@"), (m.start(2), m.end(2), ".")]
        out = out.replace(cuts)
    return None if out.text == text else out


def disguised(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans of ``text`` that only its normal form shows."""
    form = normalise(text)
    if form is None:
        return []
    taken: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    for kind, a, b in base:
        taken[kind].append((a, b))
    out = []
    for kind, a, b in detect(form.text):
        a, b = form.start[a], form.end[b - 1]
        if not any(x <= a and b <= y for x, y in taken[kind]):
            taken[kind].append((a, b))
            out.append((kind, a, b))
    return out


def spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all spans, of a text."""
    base = detect(text)
    return base, _ordered(base + disguised(text, base))


def _named(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def find(documents: DataFrame) -> DataFrame:
    """The contract's columns; the counts ``n_*`` are those of the base patterns."""

    def work(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c: [] for c in ("base_sha256", "spans", *(f"n_{k}" for k in KINDS))}
        for text in batch.column("text").to_pylist():
            base, every = spans(text or "")
            for kind in KINDS:
                out[f"n_{kind}"].append(sum(k == kind for k, _, _ in base))
            out["base_sha256"].append(sha256(_named(base)))
            out["spans"].append(_named(every))
        return out | {"doc_id": batch.column("doc_id")}

    kind = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
    return per_batch(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work, kind)


def redact_text(text: str) -> str:
    out, at = [], 0
    for kind, a, b in spans(text)[1]:
        if b <= at:
            continue
        out += [text[at : max(a, at)], f"[{kind.upper()}]"] if a >= at else []
        at = b
    return "".join((*out, text[at:]))


def redact(documents: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; null texts stay null."""

    @F.pandas_udf("string")
    def hide(texts):
        return texts.map(redact_text, na_action="ignore")

    return documents.withColumn("text", hide("text"))
