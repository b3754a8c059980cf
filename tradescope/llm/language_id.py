"""Language identification by a mixture of character n-gram models.

Training counts hashed letter trigrams per language over all labelled rows (no
sample): each task adds up its own rows, Spark sums the tasks. The model is a
table of ``BUCKETS`` likelihoods per language.

A text's trigrams are taken as draws from a mixture of the languages; the
mixture's proportions come from expectation-maximisation, whose steps end when the
likelihood is known to lie within a tolerance of its maximum. The reported set of
languages is the one with the highest likelihood less a penalty for each
language beyond the first (half the logarithm of the number of trigrams, times
``PENALTY``). The prediction is the language with the largest proportion in that
set, and its score is that proportion.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradescope.llm.common import documents_of, map_rows
from tradescope.llm.sentencepiece_bpe import groups_by_size

BUCKETS = 1 << 16
#: Added to each bucket's count of each language.
SMOOTHING = 0.5
PENALTY = 2.0
#: Log-likelihood that a mixture may lie below its maximum.
TOLERANCE = 0.01
#: Up to so many languages all sets of them are tried.
MOST_TRIED = 6
UNKNOWN = "und"
#: Characters times languages that one round of numpy arrays holds.
CELLS_AT_ONCE = 1_600_000


class Model(NamedTuple):
    languages: list[str]
    likelihood: np.ndarray  # BUCKETS x languages


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all letter trigrams, text after text, and how many each text has.

    There is one trigram around each letter; what is no letter counts as a blank.
    """
    lowered = [t.lower() for t in texts]
    joined = "\n".join(["", *lowered, ""])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = letters()[codes]
    ends = np.cumsum([len(t) + 1 for t in lowered]) if lowered else np.zeros(0, dtype=np.int64)
    so_far = np.r_[0, np.cumsum(letter)]
    counts = np.diff(so_far[np.r_[0, ends] + 1])
    at = np.flatnonzero(letter)
    c = np.where(letter, codes, 0).astype(np.uint64)
    mixed = c[at - 1] * np.uint64(0x9E3779B97F4A7C15) + c[at] * np.uint64(0xC2B2AE3D27D4EB4F) + c[at + 1] * np.uint64(0x165667B19E3779F9)
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)).astype(np.int64), counts


def count_trigrams(labelled: DataFrame) -> DataFrame:
    """``lang, bucket, n`` over all rows of ``lang, text``: a row per task, language and bucket at most enters the shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lang in sorted(set(langs)):
                mine = [t for t, x in zip(texts, langs, strict=True) if x == lang]
                total = sums.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                for a, z in groups_by_size(mine):
                    total += np.bincount(trigrams(mine[a:z])[0], minlength=BUCKETS)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()), "bucket": pa.array(at.astype(np.int32)), "n": pa.array(total[at])})

    rows = labelled.select("lang", "text").mapInArrow(run, "lang string, bucket int, n long")
    return rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame) -> Model:
    """Learns from all rows with non-null ``lang`` and ``text`` that have letters.

    What comes to the driver is bounded by ``BUCKETS`` rows per language,
    whatever the number of documents.
    """
    table = count_trigrams(labelled.where("lang IS NOT NULL AND text IS NOT NULL")).toArrow()
    names = table.column("lang").to_pylist()
    languages = sorted(set(names))
    counts = np.full((BUCKETS, len(languages)), SMOOTHING)
    where = {x: k for k, x in enumerate(languages)}
    index = np.fromiter(map(where.__getitem__, names), dtype=np.int64, count=len(names))
    counts[table.column("bucket").to_numpy(), index] += table.column("n").to_numpy()
    return Model(languages, (counts / counts.sum(axis=0)).astype(np.float32) if languages else counts.astype(np.float32))


def _mixture(
    p: np.ndarray, n: np.ndarray, starts: np.ndarray, sizes: np.ndarray, total: np.ndarray, allowed: np.ndarray, enough: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Proportions, log-likelihood, and an upper bound of the best log-likelihood, per text.

    ``p`` and ``n`` hold a text's distinct trigrams in a row, ``allowed`` marks its
    languages. A step multiplies each proportion by a factor; the log-likelihood is concave in
    the proportions, so it lies at most ``total * log(largest factor)`` below its
    maximum. A text's steps end when that gap is at most ``TOLERANCE``, or when the
    bound shows that it cannot exceed ``enough``.
    """
    share_out = allowed / allowed.sum(axis=1, keepdims=True)
    fit_out, bound_out = np.zeros(len(total)), np.zeros(len(total))
    at, share = np.arange(len(total)), share_out.copy()
    while len(at):
        inside = (p * np.repeat(share, sizes, axis=0)).sum(axis=1)
        factor = np.add.reduceat(p * (n / inside)[:, None], starts, axis=0) / total[at][:, None]
        value = np.add.reduceat(n * np.log(inside), starts)
        gap = total[at] * np.log(np.maximum((factor * (allowed[at] > 0)).max(axis=1), 1.0))
        done = (gap <= TOLERANCE) | (value + gap <= enough[at])
        share_out[at[done]], fit_out[at[done]], bound_out[at[done]] = share[done], value[done], (value + gap)[done]
        share = share * factor
        share /= share.sum(axis=1, keepdims=True)
        if done.any():
            going = np.repeat(~done, sizes)
            p, n, at, share, sizes = p[going], n[going], at[~done], share[~done], sizes[~done]
            starts = np.cumsum(sizes) - sizes
    return share_out, fit_out, bound_out


def candidate_sets(k: int, size: int, order: np.ndarray) -> Iterator[np.ndarray]:
    """Marks (texts x languages) of the sets of ``size`` languages to try: all of them, with more than
    ``MOST_TRIED`` languages the ones with the largest proportions."""
    if k <= MOST_TRIED:
        for chosen in combinations(range(k), size):
            marks = np.zeros(order.shape)
            marks[:, chosen] = 1.0
            yield marks
    else:
        marks = np.zeros(order.shape)
        np.put_along_axis(marks, order[:, :size], 1.0, axis=1)
        yield marks


def language_sets(model: Model, texts: list[str]) -> list[list[tuple[str, float]]]:
    """Selected languages with their proportions, largest first; an empty list for a text without letters (or without a model)."""
    bucket, counts = trigrams(texts)
    out: list[list[tuple[str, float]]] = [[] for _ in texts]
    k = len(model.languages)
    if not k or not len(bucket):
        return out
    keys, n = np.unique(np.repeat(np.arange(len(texts)), counts) * BUCKETS + bucket, return_counts=True)
    doc, p, n = keys // BUCKETS, model.likelihood[keys % BUCKETS].astype(np.float64), n.astype(np.float64)
    present, starts, sizes = np.unique(doc, return_index=True, return_counts=True)
    total = counts[present].astype(np.float64)
    single = np.add.reduceat(n[:, None] * np.log(p), starts, axis=0)
    first = single.argmax(axis=1)
    chosen = np.zeros((len(present), k))
    chosen[np.arange(len(present)), first] = 1.0
    best = single.max(axis=1)
    price = PENALTY * 0.5 * np.log(total + 1)
    # No set can beat the mixture of all languages, whose bound settles most texts: their best single language stays.
    share, _, bound = _mixture(p, n, starts, sizes, total, np.ones((len(present), k)), best + price)
    order = np.argsort(-share, axis=1, kind="stable")
    for size in range(2, k + 1):
        open_ = np.flatnonzero(bound - price * (size - 1) > best)
        if not len(open_):
            break
        rows = np.concatenate([np.arange(a, a + s) for a, s in zip(starts[open_], sizes[open_], strict=True)])
        begin = np.cumsum(sizes[open_]) - sizes[open_]
        for allowed in candidate_sets(k, size, order[open_]):
            part, value, _ = _mixture(p[rows], n[rows], begin, sizes[open_], total[open_], allowed, best[open_] + price[open_] * (size - 1))
            value = value - price[open_] * (size - 1)
            better = value > best[open_]
            best[open_[better]] = value[better]
            chosen[open_[better]] = part[better]
    for at, row in zip(present.tolist(), chosen, strict=True):
        ranked = np.argsort(-row, kind="stable")
        out[at] = [(model.languages[j], float(min(1.0, row[j]))) for j in ranked.tolist() if row[j] > 0]
    return out


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, languages`` of every whole text, one row per input row.

    A null text, or one without a letter, is ``und`` with score 0, as is every
    text when nothing was learned. ``languages`` lists ``lang:proportion``.
    The order of rows and other columns play no part; a null doc_id stays null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages numbers

    def run(cols):
        known, out = shared.value, {"doc_id": cols["doc_id"], "lang_pred": [], "score": [], "languages": []}
        limit = max(20_000, CELLS_AT_ONCE // max(1, len(known.languages)))
        for a, b in groups_by_size(cols["text"], limit):
            for found in language_sets(known, cols["text"][a:b]):
                out["lang_pred"].append(found[0][0] if found else UNKNOWN)
                out["score"].append(found[0][1] if found else 0.0)
                out["languages"].append(",".join(f"{x}:{s:.3f}" for x, s in found))
        return out

    return map_rows(documents_of(docs), run, "doc_id long, lang_pred string, score double, languages string")


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 2 when divided by 4; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Learns from the rows that are not held out, then predicts every row: ``doc_id, held_out, lang_pred, score, languages``."""
    model = fit(docs.where(~held_out(F.col("doc_id"))).select("lang", "text"))
    return predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "languages")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text has a language, unchanged; texts that are null or without letters go.

    Where no row has a label there is no language to reject by: every text with a letter stays.
    """
    model = fit(docs.where(~held_out(F.col("doc_id"))).select("lang", "text"))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def identified(texts):
        whole = [t if isinstance(t, str) else "" for t in texts]
        known, kept = shared.value, []
        for a, b in groups_by_size(whole, max(20_000, CELLS_AT_ONCE // max(1, len(known.languages)))):
            kept += [bool(x) for x in language_sets(known, whole[a:b])]
        return texts.__class__(kept, dtype=bool)

    return docs.where(identified(F.col("text")))
