"""Secrets in texts: fixed patterns, and a battery of randomness tests on other tokens.

Base kinds (``assign``, ``access``, ``hex``) follow fixed patterns and are
always reported. The method adds ``random``: a token of one inferred encoding (hex,
base32, base36, base62, base64) whose characters look drawn uniformly; names before
``=`` and, where no encoding fits, paths around it are cut off (``parts_of``).
Three tests put that to the proof: chi-squared uniformity over the encoding's
alphabet, the number of runs about the alphabet's middle, and the lag-one
serial correlation. Their smallest p-value, times three, is the token's; the values of
base spans are tested as well and their p-values reported.

Two false-discovery controls decide, both over all tokens of the table:

* A token is refuted, i.e. not random, where the Benjamini-Hochberg procedure rejects
  uniformity, apart for each encoding and band of lengths: short tokens have little
  power, so they must not share their error budget with long ones.
* What is not refuted is reported only on evidence against ordinary text. A token's
  evidence is the ratio of its probability under uniform draws (a mixture over the
  encodings) to that under a model of the corpus's own words and numbers: which
  character follows which. Its mean over ordinary tokens is at most 1, so it grows with
  length only for tokens that are not ordinary, and the procedure of
  Benjamini and Hochberg on such ratios (e-BH) bounds the share of ordinary tokens
  among the reported ones by ``WRONG``, however tokens depend on each other.

Counts are bounded grids of bins that Spark sums.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradescope.llm.common import cut, documents_of, map_rows
from tradescope.llm.sentencepiece_bpe import groups_by_size

BASE_KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_VALUE = 12

#: A run that tokens are cut from (see ``parts_of``); the battery tests those of this length with a digit and a letter.
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
WHOLE = re.compile(r"[A-Za-z0-9+/_-]{12,}")
#: Pieces of a run that no alphabet holds.
PIECES = tuple(re.compile(p) for p in (r"[A-Za-z0-9+]{12,}", r"[A-Za-z0-9+/]{12,}", r"[A-Za-z0-9_-]{12,}"))
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
#: The first alphabet that holds all of a token's characters is its encoding.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": BASE64[:62],
    "base64": BASE64,
    "base64url": BASE64[:62] + "-_",
}
ORDER = {name: {c: k for k, c in enumerate(a)} for name, a in ALPHABETS.items()}
#: Lower ends of the length bands; share of false refutations among refuted tokens.
BANDS = (12, 16, 20, 24, 32, 48, 64, 128, 512)
Q = 0.05
#: Share of ordinary tokens among the reported ones, at most.
WRONG = 0.05
#: p-values are binned on a log scale, so many bins a decade, down to the last one.
BINS_A_DECADE, DECADES = 50, 40
LAST_BIN = BINS_A_DECADE * DECADES
#: Evidence is binned on a log scale too, up to this bin.
EVIDENCE_A_DECADE, LAST_EVIDENCE = 10, 2000
#: Characters of tokens, by number; one more number stands for what is before a run.
CHARACTERS = BASE64 + "-_"
NUMBER = {c: k for k, c in enumerate(CHARACTERS)}
BEFORE = len(CHARACTERS)


class Token(NamedTuple):
    start: int
    end: int
    group: str
    bin: int
    evidence: int


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The fixed patterns by start, then kind as listed; a match that fails its length is dropped without a retry."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST_VALUE]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(BASE_KINDS[k], a, b) for a, k, b in sorted(out)]


def encoding_of(token: str) -> str | None:
    chars = set(token)
    return next((name for name, order in ORDER.items() if chars <= order.keys()), None)


def _normal_tail(z: float) -> float:
    """Two-sided tail of the standard normal."""
    return math.erfc(abs(z) / math.sqrt(2))


def p_uniform(token: str, encoding: str) -> float:
    """How well the token's characters agree with independent uniform draws from the encoding's alphabet."""
    order = ORDER[encoding]
    values, n, k = [order[c] for c in token], len(token), len(order)
    # Chi-squared over the alphabet, by the Wilson-Hilferty cube root.
    counts = [0] * k
    for v in values:
        counts[v] += 1
    chi2 = sum((c - n / k) ** 2 for c in counts) * k / n
    d = k - 1
    z = ((chi2 / d) ** (1 / 3) - (1 - 2 / (9 * d))) / math.sqrt(2 / (9 * d))
    p_chi = math.erfc(z / math.sqrt(2)) / 2
    # Runs above and below the middle of the alphabet.
    high = [v >= k / 2 for v in values]
    n1 = sum(high)
    n0 = n - n1
    runs = 1 + sum(a != b for a, b in zip(high, high[1:], strict=False))
    mean = 1 + 2 * n0 * n1 / n
    variance = (mean - 1) * (mean - 2) / (n - 1)
    p_runs = _normal_tail((runs - mean) / math.sqrt(variance)) if variance > 0 else 2.0 ** (1 - n)
    # Lag-one serial correlation of the values.
    centre = (k - 1) / 2
    spread = (k * k - 1) / 12
    r = sum((a - centre) * (b - centre) for a, b in zip(values, values[1:], strict=False)) / (spread * (n - 1))
    p_serial = _normal_tail(r * math.sqrt(n - 1))
    return min(1.0, 3 * min(p_chi, p_runs, p_serial))


def bin_of(p: float) -> int:
    """0 for p = 1, higher for smaller p; a bin's p-values are counted at its upper edge."""
    return min(LAST_BIN, int(-math.log10(p) * BINS_A_DECADE)) if p > 0 else LAST_BIN


def parts_of(run: str) -> list[tuple[int, int]]:
    """Where the tokens of a run begin and end, by start.

    ``=`` belongs to no alphabet: it pads a value or parts a name from it, so
    each side is a token of its own. A side that no alphabet holds has ``/`` or ``+``
    along with ``-`` or ``_``, like a value glued to a path. Which of them part and
    which belong to the value is open, so its long pieces between ``/``, ``-`` and
    ``_`` are tokens and its longest pieces of one alphabet as well; these may overlap.
    """
    out = set()
    for side in re.finditer("[^=]+", run):
        patterns = (WHOLE,) if encoding_of(side[0]) else PIECES
        out |= {m.span() for pattern in patterns for m in pattern.finditer(run, *side.span())}
    return sorted(out)


# -- ordinary text -------------------------------------------------------------
CODE = np.full(0x80, BEFORE, dtype=np.int64)
CODE[[ord(c) for c in CHARACTERS]] = np.arange(BEFORE)


def followers(texts: list[str]) -> np.ndarray:
    """How often each character follows each, or begins, in runs of letters alone or digits alone (with ``+/-_`` in either)."""
    joined = "\n".join(["", *texts, ""])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    code = CODE[np.where(codes < 0x80, codes, 0)]
    inside = code < BEFORE
    run = np.cumsum(inside & ~np.r_[False, inside[:-1]]) * inside  # 0: outside
    digit, letter = (np.bincount(run[kind & inside], minlength=int(run.max()) + 1) > 0 for kind in ((code >= 52) & (code < 62), code < 52))
    plain = inside & ~(digit & letter)[run]
    before = np.r_[BEFORE, code[:-1]]
    return np.bincount(before[plain] * BEFORE + code[plain], minlength=(BEFORE + 1) * BEFORE)


def count_followers(docs: DataFrame) -> DataFrame:
    """``pair, n`` over all texts: a row per task and pair of characters at most enters the shuffle."""

    def run(batches):
        total = np.zeros((BEFORE + 1) * BEFORE, dtype=np.int64)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in groups_by_size(texts):
                total += followers(texts[a:b])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"pair": pa.array(at.astype(np.int32)), "n": pa.array(total[at])})

    return documents_of(docs).mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def ordinary_model(counts: dict[int, int]) -> np.ndarray:
    """-log10 of the probability of each character after each (or at the beginning), half a count added to every pair."""
    table = np.full((BEFORE + 1, BEFORE), 0.5)
    for pair, n in counts.items():
        table[pair // BEFORE, pair % BEFORE] += n
    return -np.log10(table / table.sum(axis=1, keepdims=True))


def evidence_of(token: str, encoding: str, model: np.ndarray) -> int:
    """The bin (rounded down) of the token's evidence against ordinary text."""
    at = [NUMBER[c] for c in token]
    surprise = float(model[[BEFORE, *at[:-1]], at].sum())
    value = surprise - len(token) * math.log10(len(ORDER[encoding])) - math.log10(len(ORDER))
    return max(0, min(LAST_EVIDENCE, math.floor(value * EVIDENCE_A_DECADE)))


def tokens_of(text: str, base: list[tuple[str, int, int]], model: np.ndarray) -> list[Token]:
    """Tokens to test: with a digit and a letter, of a known encoding, and outside the base spans."""
    spans = sorted((a, b) for _, a, b in base)
    starts, reach = [a for a, _ in spans], 0
    ends = [reach := max(reach, b) for _, b in spans]
    out = []
    for m in TOKEN.finditer(text):
        for x, y in parts_of(m[0]):
            token, a, b = m[0][x:y], m.start() + x, m.start() + y
            before = bisect_left(starts, b)
            if b - a < BANDS[0] or before and ends[before - 1] > a:
                continue
            if not re.search("[0-9]", token) or not re.search("[A-Za-z]", token):
                continue
            if encoding := encoding_of(token):
                band = max(x for x in BANDS if x <= b - a)
                out.append(Token(a, b, f"{encoding}/{band}", bin_of(p_uniform(token, encoding)), evidence_of(token, encoding, model)))
    return out


def base_p(text: str, kind: str, start: int, end: int) -> float | None:
    """The battery's p-value of a base span's value; none where it is too short or of no encoding."""
    value = text[start:end]
    if kind == "assign":
        value = ASSIGN.match(value)[1].rstrip("=")
    elif kind == "access":
        value = value[4:]
    encoding = encoding_of(value)
    return p_uniform(value, encoding) if encoding and len(value) >= BANDS[0] else None


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, base array<span>, tokens array<token>`` of every whole text, one row per input row."""
    counts = {r["pair"]: r["n"] for r in count_followers(docs).collect()}  # bounded by the pairs of characters
    shared = docs.sparkSession.sparkContext.broadcast(ordinary_model(counts))

    def run(cols):
        model, out = shared.value, {"doc_id": cols["doc_id"], "base": [], "tokens": []}
        for t in cols["text"]:
            base = base_spans(t)
            out["base"].append([{"kind": k, "start": a, "end": b, "p": base_p(t, k, a, b)} for k, a, b in base])
            out["tokens"].append([x._asdict() for x in tokens_of(t, base, model)])
        return out

    return map_rows(
        documents_of(docs),
        run,
        "doc_id long, base array<struct<kind: string, start: long, end: long, p: double>>, tokens array<struct<start: long, end: long, group: string, bin: int, evidence: int>>",
    )


def refuted_from(scanned: DataFrame, q: float = Q) -> DataFrame:
    """``group, refuted_from``: the least bin of each group that Benjamini-Hochberg rejects; groups without one are left out.

    At most (encodings x bands) groups and ``LAST_BIN`` bins each, whatever the table.
    """
    bins = scanned.select(F.explode("tokens").alias("t")).groupBy(F.col("t.group").alias("group"), F.col("t.bin").alias("bin")).count()
    by_p = Window.partitionBy("group").orderBy(F.desc("bin"))
    edge = F.pow(F.lit(10.0), -F.col("bin") / F.lit(float(BINS_A_DECADE)))
    ranked = bins.withColumn("rank", F.sum("count").over(by_p)).withColumn("total", F.sum("count").over(Window.partitionBy("group")))
    return ranked.where(edge <= F.col("rank") / F.col("total") * q).groupBy("group").agg(F.min("bin").alias("refuted_from"))


def reported_from(scanned: DataFrame, wrong: float = WRONG) -> int:
    """The least bin of evidence that e-BH accepts: evidence of at least n / (wrong * k) for the k tokens that have as much."""
    bins = scanned.select(F.explode("tokens").alias("t")).groupBy(F.col("t.evidence").alias("bin")).count().collect()  # LAST_EVIDENCE + 1 at most
    total, so_far, out = sum(r["count"] for r in bins), 0, LAST_EVIDENCE + 1
    for r in sorted(bins, key=lambda r: -r["bin"]):
        so_far += r["count"]
        if r["bin"] / EVIDENCE_A_DECADE >= math.log10(total / (wrong * so_far)):
            out = r["bin"]
    return out


def find_secrets(docs: DataFrame, q: float = Q, wrong: float = WRONG) -> DataFrame:
    """``doc_id, spans array<struct<kind, start, end, p>>``, base spans and reported tokens by start, then kind.

    ``p`` is the battery's p-value (of a random token: its bin's upper edge; null
    where a base span cannot be tested). One row per input row: null and empty texts
    have no spans, a null doc_id stays null, repeated rows are repeated, other
    columns are ignored.
    """
    scanned = cut(scan(docs))
    limits = {r["group"]: r["refuted_from"] for r in refuted_from(scanned, q).collect()}  # bounded: one row per group
    known = F.create_map(*[x for k, v in sorted(limits.items()) for x in (F.lit(k), F.lit(v))]) if limits else F.lit(None).cast("map<string,int>")
    least = reported_from(scanned, wrong)
    kept = F.filter("tokens", lambda t: (t["bin"] < F.coalesce(F.try_element_at(known, t["group"]), F.lit(LAST_BIN + 1))) & (t["evidence"] >= least))
    edge = lambda t: F.pow(F.lit(10.0), -t["bin"] / F.lit(float(BINS_A_DECADE)))
    added = F.transform(kept, lambda t: F.struct(F.lit("random").alias("kind"), t["start"].alias("start"), t["end"].alias("end"), edge(t).alias("p")))
    rank = F.create_map(*[x for k, kind in enumerate((*BASE_KINDS, "random")) for x in (F.lit(kind), F.lit(k))])
    keyed = F.transform(F.concat("base", added), lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"), s["p"].alias("p")))
    spans = F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["p"].alias("p")))
    return scanned.select("doc_id", spans.alias("spans"))


def report(docs: DataFrame, q: float = Q) -> DataFrame:
    """Counts and digests of the base spans, and all spans as text, per document; see ``find_secrets`` for the edge cases."""
    spans = find_secrets(docs, q)

    def joined(column):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(kind):
        return F.filter("spans", lambda s: s["kind"] == kind)

    base = F.filter("spans", lambda s: s["kind"] != "random")
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in (*BASE_KINDS, "random")]
    return spans.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), F.col("spans.p").alias("p_values"))


