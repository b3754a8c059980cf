"""Personal data in texts: patterns propose, checksums confirm, context adjusts.

Base kinds (``email``, ``ip``, ``card``, ``phone``) follow fixed patterns and are
always reported. The method adds to them: cards and phone numbers in a usual
layout that a longer run of digits hid from the fixed patterns, ``iban`` (ISO 7064
mod-97 confirms) and ``id`` (a bare national or account number, which only counts
where a cue word stands near). Every span gets a score: a prior by kind, raised
when a checksum holds, moved by cue words on either side of it. Added spans are kept from
``MIN_SCORE`` on; the score never removes a base span.

The scanners are linear in the text: an email is looked for around each ``@``,
and runs are entered only at their first character, where the leftmost match of
the pattern begins.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradescope.llm.common import documents_of, map_rows, sha256_hex, span_list

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "id")

EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
BARE_ID = re.compile(r"(?<![A-Za-z0-9.+-])[0-9]{3}(?:[ -]?[0-9]){4,14}(?![0-9A-Za-z])")
#: Usual layouts within a run of digits that fails as a whole.
LAID_OUT_CARD = re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9])")
LAID_OUT_PHONE = re.compile(r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])")
NOT_DIGIT = re.compile(r"[^0-9]")
WORD = re.compile(r"\w+")

#: Prior score by kind, and what a checksum that holds adds.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.5, "phone": 0.6, "iban": 0.4, "id": 0.2}
CHECKSUM_BONUS = {"card": 0.3, "iban": 0.5}
#: Cue words near a span: the text's case and accents are kept as they are, compared in lower case.
CUES = {
    "email": ("mail", "email", "e mail", "contact", "kontakt", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "teléfono"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "id": ("ssn", "social security", "passport", "id number", "tax id", "ausweis", "passeport", "dni"),
}
DOUBT = ("example", "test", "sample", "version", "isbn", "order", "part no")
CUE_BONUS, DOUBT_MALUS = 0.35, 0.2
#: Characters on either side of a span in which cue words count.
CONTEXT = 40
#: What parts the words behind a span from it: cues there belong to the next sentence or line.
SENTENCE_END = re.compile(r"[.;!?]\s|\n")
MIN_SCORE = 0.5
IBAN_LEAST = 15


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def mod_97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found around each ``@``."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        domain = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            yield start, last
            at = text.find("@", last)
        else:
            # A later start meets the same "@"; what stands left of it cannot serve the next one.
            last = at + 1
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The fixed patterns by kind as listed, then start; a match that fails its test is dropped without a retry."""
    out = [("email", a, b) for a, b in emails(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def score(text: str, kind: str, start: int, end: int, confirmed: bool) -> float:
    """Prior by kind, checksum, and the cue words near the span: before it, and behind it up to the end of the sentence."""
    behind = text[end : end + CONTEXT]
    stop = SENTENCE_END.search(behind)
    sides = (text[max(0, start - CONTEXT) : start], behind[: stop.start()] if stop else behind)
    near = [f" {' '.join(WORD.findall(side.lower()))} " for side in sides]
    value = PRIOR[kind] + (CHECKSUM_BONUS.get(kind, 0) if confirmed else 0)
    value += CUE_BONUS * any(f" {c} " in side for c in CUES[kind] for side in near) - DOUBT_MALUS * any(f" {c} " in side for c in DOUBT for side in near)
    return min(1.0, max(0.0, round(value, 4)))


def find_spans(text: str) -> list[Span]:
    """Base spans with scores, and the added spans that reach ``MIN_SCORE``; by kind as listed, then start."""
    base = base_spans(text)
    out = [Span(kind, a, b, score(text, kind, a, b, kind == "card")) for kind, a, b in base]
    free = Gaps([(a, b) for _, a, b in base])
    for m in LAID_OUT_PHONE.finditer(text):
        out += propose(text, free, "phone", m.start(), m.end(), False)
    free = Gaps([(s.start, s.end) for s in out])
    for m in LAID_OUT_CARD.finditer(text):
        if luhn(NOT_DIGIT.sub("", m[0])):
            out += propose(text, free, "card", m.start(), m.end(), True)
    free = Gaps([(s.start, s.end) for s in out])
    for m in IBAN.finditer(text):
        # Words in capitals may follow: the longest run of whole groups that the checksum confirms counts.
        found = m[0]
        while len(compact := found.replace(" ", "")) >= IBAN_LEAST and not mod_97(compact):
            found = found.rpartition(" ")[0]
        if len(compact) >= IBAN_LEAST:
            out += propose(text, free, "iban", m.start(), m.start() + len(found), True)
    free = Gaps([(s.start, s.end) for s in out])
    for m in BARE_ID.finditer(text):
        out += propose(text, free, "id", m.start(), m.end(), False)
    return sorted(out, key=lambda s: (KINDS.index(s.kind), s.start))


class Gaps:
    """Which places no given span covers."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(spans):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(b, self.ends[-1])
            else:
                self.starts.append(a)
                self.ends.append(b)

    def hold(self, a: int, b: int) -> bool:
        k = bisect_left(self.starts, b)
        return not k or self.ends[k - 1] <= a


def propose(text: str, free: Gaps, kind: str, a: int, b: int, confirmed: bool) -> list[Span]:
    value = score(text, kind, a, b, confirmed)
    return [Span(kind, a, b, value)] if value >= MIN_SCORE and free.hold(a, b) else []


def mask(text: str, spans: list[Span]) -> str:
    """Each span replaced by its kind in brackets; spans that overlap become one mark of the first."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if s.start >= at:
            out += [text[at : s.start], f"[{s.kind.upper()}]"]
        at = max(at, s.end)
    return "".join([*out, text[at:]])


def detect(docs: DataFrame) -> DataFrame:
    """Spans of every whole text: ``doc_id, spans array<struct<kind, start, end, score>>``.

    One row per input row. Offsets count code points. Null and empty texts have
    no spans; a null doc_id stays null; other columns are ignored.
    """

    def run(cols):
        found = [[s._asdict() for s in find_spans(t)] for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "spans": found}

    return map_rows(documents_of(docs), run, "doc_id long, spans array<struct<kind: string, start: long, end: long, score: double>>")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The same rows and columns with the spans in ``text`` masked; ``n_chars``, where present, is counted anew.

    Null texts stay null, texts without spans stay as they are.
    """

    @F.pandas_udf("string")
    def masked(texts):
        return texts.map(lambda t: mask(t, find_spans(t)) if isinstance(t, str) else None)

    out = docs.withColumn(text, masked(F.col(text)))
    return out.withColumn("n_chars", n_chars(F.col(text)).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def n_chars(text: Column) -> Column:
    return F.char_length(F.coalesce(text, F.lit("")))


def report(docs: DataFrame) -> DataFrame:
    """Counts and digests of the base spans, and all spans as text, per document; see ``detect`` for the edge cases.

    ``n_<kind>`` counts base spans of the base kinds, and the spans of the added kinds.
    """

    def run(cols):
        out = {"doc_id": cols["doc_id"]} | {k: [] for k in (*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "scores")}
        for text in cols["text"]:
            spans, base = find_spans(text), base_spans(text)
            for k in KINDS:
                out[f"n_{k}"].append(sum(s[0] == k for s in (base if k in BASE_KINDS else spans)))
            out["base_sha256"].append(sha256_hex(span_list(base)))
            out["spans"].append(span_list(s[:3] for s in spans))
            out["scores"].append([s.score for s in spans])
        return out

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return map_rows(documents_of(docs), run, f"doc_id long, {counts}, base_sha256 string, spans string, scores array<double>")
