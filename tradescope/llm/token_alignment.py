"""Alignment of two tokenizers' tokens over the same text, by interval coalescing.

Tokenizer A is a byte-level BPE, tokenizer B a SentencePiece model. Each token
covers a range of the text's bytes. All ranges of A and B are sorted by start
(``lexsort``), a running maximum of their ends tells how far the tokens so far
reach, and a group ends where the next start reaches that maximum: there, and
only there, a token of A and one of B end together. What overlaps stays in its
group. All texts of a chunk lie one after another on one line of bytes, so one
sort serves them all.

Neither tokenizer has a token that reaches over a single blank between two letters,
digits or marks: such a token would hold a blank behind another character. Texts are
cut there, and each distinct segment that a task meets is encoded and aligned
once (the segments kept are bounded); a text is put together from its segments.

A link is an occurrence of a token of A and one of B that end at the same byte.
One of the two then ends with the other, so the number of different id pairs is
bounded by the vocabularies (see ``most_pairs``), whatever the corpus: their
counts can be held by the driver and broadcast.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradescope.llm.common import cut, documents_of
from tradescope.llm.sentencepiece_bpe import BLANK, groups_by_size

#: Characters of the texts that are aligned together.
CHARS_AT_ONCE = 300_000
#: Segments, and characters of them, that a Python worker keeps aligned; beyond either it starts anew.
KEPT_SEGMENTS, KEPT_CHARS = 400_000, 16_000_000
#: A single blank between characters that are no white space in any reading: a boundary of both tokenizers.
BOUNDARY = re.compile(r"(?<=[\w!-~]) (?=[\w!-~])")
#: A blank beside another character, which is no boundary.
OTHER_BLANK = re.compile(r"^ |[^\w!-~] | [^\w!-~]| $")
#: Segments that may stand between two boundaries, and how many of them are encoded as one text.
INNER = re.compile(r"[\w!-~](?:(?s:.*)[\w!-~])?")
TOGETHER = 500
#: Separators before a token of the written form: first of a text, in its list, first of B, first of a group.
SEPARATORS = ["", ",", "|", ";"]


@lru_cache(maxsize=1)
def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable bytes stand for themselves; the others take the characters from 256 on, in order.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out = {chr(b): b for b in printable}
    for k, b in enumerate(b for b in range(256) if b not in printable):
        out[chr(256 + k)] = b
    return out


class TokenizerPair:
    """Both tokenizers with the bytes of every id."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = byte_of_character()
        by_id = {i: token for token, i in self.a.get_vocab().items()}
        self.bytes_a = [bytes(byte_of.get(ch, 0x3F) for ch in by_id.get(i, "?")) for i in range(max(by_id) + 1)]
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(BLANK, " ").encode())
        if not all(self.bytes_a) or not all(self.bytes_b):
            raise ValueError("a vocabulary entry without bytes ends nowhere")
        self.length_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        # A token with a blank behind a character that is no white space could reach over a boundary; texts then stay whole.
        within = any(re.search(r"\S ", x.decode("utf-8", "replace")) for x in [*self.bytes_a, *self.bytes_b])
        self.boundary = None if within else BOUNDARY
        self.segments = Segments(self)
        ids = [str(i) for i in range(len(self.bytes_a))] + [str(i) for i in range(len(self.bytes_b))]
        self.written = [s + i for s in SEPARATORS for i in ids]

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of A over a blank and the text, and of B over the text; none for a text that either does not spell out."""
        found = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        ids_a = [x.ids for x in found]
        ids_b = self.b.encode(texts, num_threads=1) if texts else []
        for k, t in enumerate(texts):
            whole = b" " + t.encode("utf-8", "surrogatepass")
            if not t or b"".join(map(self.bytes_a.__getitem__, ids_a[k])) != whole or b"".join(map(self.bytes_b.__getitem__, ids_b[k])) != whole:
                ids_a[k], ids_b[k] = [], []
        return [np.array(x, dtype=np.int64) for x in ids_a], [np.array(x, dtype=np.int64) for x in ids_b]


@lru_cache(maxsize=2)
def tokenizer_pair(path_a: str, path_b: str) -> TokenizerPair:
    return TokenizerPair(path_a, path_b)


def coalesce(starts: np.ndarray, ends: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of each range (in the order of the input), and where each group ends.

    Ranges are sorted by start; a group breaks where a start reaches the running maximum of the ends.
    """
    if not len(starts):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    order = np.lexsort((kinds, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.r_[False, starts[order][1:] >= reach[:-1]]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(breaks)
    return group, reach[np.r_[np.flatnonzero(breaks) - 1, len(order) - 1]]


class Aligned(NamedTuple):
    """The alignment of some texts: per text counts and written form, and its distinct linked id pairs, text after text."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    n_pairs: np.ndarray
    pairs: np.ndarray
    times: np.ndarray


def align_whole(tokenizers: TokenizerPair, texts: list[str]) -> Aligned:
    """Encodes and aligns texts as they are."""
    ids_a, ids_b = tokenizers.encode(texts)
    a, b = (np.concatenate([np.zeros(0, dtype=np.int64), *ids]) for ids in (ids_a, ids_b))
    # One line of bytes for all texts: both tokenizers spell out the same bytes, so the sums of lengths agree at every text's end.
    return align_ids(tokenizers, a, b, np.cumsum([int(tokenizers.length_a[x].sum()) for x in ids_a]))


def align_ids(tokenizers: TokenizerPair, a: np.ndarray, b: np.ndarray, text_ends: np.ndarray) -> Aligned:
    """Aligns the tokens of texts that lie one after another and end at the bytes ``text_ends``."""
    n, n_ids = len(text_ends), len(tokenizers.bytes_a)
    ends = np.r_[np.cumsum(tokenizers.length_a[a]), np.cumsum(tokenizers.length_b[b])]
    starts = ends - np.r_[tokenizers.length_a[a], tokenizers.length_b[b]]
    kinds = np.repeat([0, 1], [len(a), len(b)])
    group, group_ends = coalesce(starts, ends, kinds)
    text = np.searchsorted(text_ends, starts, side="right")
    n_a, n_b = np.bincount(text[: len(a)], minlength=n), np.bincount(text[len(a) :], minlength=n)

    # The written form: group after group, in each the tokens of A before those of B.
    order = np.argsort(group * 2 + kinds, kind="stable")
    own, of, kind = np.r_[a, b + n_ids][order], group[order], kinds[order]
    new_group = np.r_[True, of[1:] != of[:-1]][: len(of)]
    new_text = np.r_[True, text[order][1:] != text[order][:-1]][: len(of)]
    separator = np.where(new_text, 0, np.where(new_group, 3, np.where(np.r_[False, kind[1:] != kind[:-1]][: len(of)], 2, 1)))
    pieces = list(map(tokenizers.written.__getitem__, (separator * (n_ids + len(tokenizers.bytes_b)) + own).tolist()))
    edges = np.r_[0, np.cumsum(n_a + n_b)].tolist()
    groups = ["".join(pieces[x:y]) for x, y in zip(edges, edges[1:], strict=False)]

    # Links: in each group the tokens that end where the group ends, one of A and one of B.
    last = ends == group_ends[group] if len(group) else np.zeros(0, dtype=bool)
    last_a, last_b = np.flatnonzero(last[: len(a)]), np.flatnonzero(last[len(a) :])
    link_text = text[: len(a)][last_a]
    keys, inverse_text, times = count_pairs(link_text, (a[last_a] << 32) | b[last_b])
    per_text = np.bincount(link_text, minlength=n)
    n_groups = np.bincount(text[order][new_group], minlength=n)
    return Aligned(n_a, n_b, n_groups, per_text, groups, np.bincount(inverse_text, minlength=n), keys, times)


def count_pairs(text: np.ndarray, pair: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs per text, in the order of texts: pair, its text, how often (``times`` each)."""
    order = np.lexsort((pair, text))
    text, pair = text[order], pair[order]
    new = np.r_[True, (text[1:] != text[:-1]) | (pair[1:] != pair[:-1])][: len(text)]
    at = np.flatnonzero(new)
    if times is None:
        return pair[at], text[at], np.diff(np.r_[at, len(text)])
    return pair[at], text[at], np.add.reduceat(times[order], at) if len(at) else times


class Segments:
    """Alignments of segments that were met before, by number."""

    def __init__(self, tokenizers: TokenizerPair):
        self.tokenizers = tokenizers
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.chars, self.n_pairs_kept = 0, 0
        self.counts = np.zeros((4, 1024), dtype=np.int64)  # n_a, n_b, n_groups, n_links
        self.begin = np.zeros(1025, dtype=np.int64)
        self.pairs, self.times = np.zeros(4096, dtype=np.int64), np.zeros(4096, dtype=np.int64)

    def learn(self, segments: list[str]) -> None:
        """Encodes and aligns segments; those that may stand between boundaries are encoded many at a time."""
        inner = [x for x in segments if INNER.fullmatch(x)]
        alone = list(set(segments).difference(inner))
        blobs = [inner[k : k + TOGETHER] for k in range(0, len(inner), TOGETHER)]
        ids_a, ids_b = self.tokenizers.encode([" ".join(x) for x in blobs])
        spelled = [k for k, x in enumerate(ids_a) if len(x)]
        for k in set(range(len(blobs))).difference(spelled):
            alone += blobs[k]
        if spelled:
            a, b = (np.concatenate([ids[k] for k in spelled]) for ids in (ids_a, ids_b))
            words = [x for k in spelled for x in blobs[k]]
            self._keep(words, align_ids(self.tokenizers, a, b, np.cumsum([1 + len(x.encode("utf-8", "surrogatepass")) for x in words])))
        if alone:
            self._keep(alone, align_whole(self.tokenizers, alone))

    def _keep(self, segments: list[str], got: Aligned) -> None:
        n, m = len(self.groups), self.n_pairs_kept
        while n + len(segments) > self.counts.shape[1]:
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)], axis=1)
            self.begin = np.r_[self.begin, np.zeros(len(self.begin) - 1, dtype=np.int64)]
        while m + len(got.pairs) > len(self.pairs):
            self.pairs, self.times = (np.r_[x, np.zeros_like(x)] for x in (self.pairs, self.times))
        self.counts[:, n : n + len(segments)] = got[:4]
        self.begin[n + 1 : n + 1 + len(segments)] = m + np.cumsum(got.n_pairs)
        self.pairs[m : m + len(got.pairs)], self.times[m : m + len(got.pairs)] = got.pairs, got.times
        self.n_pairs_kept = m + len(got.pairs)
        self.groups += got.groups
        self.number.update(zip(segments, range(n, n + len(segments)), strict=True))
        self.chars += sum(map(len, segments))

    def align(self, texts: list[str]) -> Aligned:
        """As ``align_whole``, by the segments of each text."""
        if len(self.groups) > KEPT_SEGMENTS or self.chars > KEPT_CHARS:
            self.clear()
        # Each segment stands for a blank (A takes it along, B adds it) and itself.
        parts = [(t.split(" ") if OTHER_BLANK.search(t) is None else self.tokenizers.boundary.split(t)) if t else [] for t in texts]
        new = set().union(*parts).difference(self.number)
        if new:
            self.learn(list(new))
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        known = np.fromiter(map(self.number.__getitem__, chain.from_iterable(parts)), dtype=np.int64, count=int(sizes.sum()))
        text = np.repeat(np.arange(len(texts)), sizes)
        # A segment that a tokenizer does not spell out takes the tokens from its whole text.
        spoilt = np.unique(text[self.counts[0][known] == 0])
        if len(spoilt):
            stays = ~np.isin(text, spoilt)
            known, text = known[stays], text[stays]
        counts = [np.bincount(text, weights=c[known], minlength=len(texts)).astype(np.int64) for c in self.counts]
        edges, spelled = np.r_[0, np.cumsum(np.bincount(text, minlength=len(texts)))].tolist(), list(map(self.groups.__getitem__, known.tolist()))
        groups = [";".join(spelled[x:y]) for x, y in zip(edges, edges[1:], strict=False)]
        segment, of, often = count_pairs(text, known)
        each = self.begin[segment + 1] - self.begin[segment]
        at = np.arange(int(each.sum())) + np.repeat(self.begin[segment] - (np.cumsum(each) - each), each)
        pairs, of, times = count_pairs(np.repeat(of, each), self.pairs[at], self.times[at] * np.repeat(often, each))
        return Aligned(*counts, groups, np.bincount(of, minlength=len(texts)), pairs, times)


def align_texts(tokenizers: TokenizerPair, texts: list[str]) -> Aligned:
    return align_whole(tokenizers, texts) if tokenizers.boundary is None else tokenizers.segments.align(texts)


SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The alignment of every whole text, one row per input row, rows in the scan's partitions.

    ``groups`` writes it out as ``a1,a2|b1;a3|b2,b3``: ids of A and B, group
    after group. ``pairs`` holds the distinct linked id pairs (A's id times 2**32
    plus B's) and ``times`` how often the text holds each. A text that is null
    or empty, or whose bytes either tokenizer does not give back, has no tokens:
    zeros and empty lists. Ids may be null or repeated; other columns play no part.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizer_pair(path_a, path_b)
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1).to_pylist()
            for x, y in groups_by_size(texts, CHARS_AT_ONCE):
                got = align_texts(both, texts[x:y])
                offsets = pa.array(np.r_[0, np.cumsum(got.n_pairs)].astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int64))) for v in (got.pairs, got.times)]
                columns = [doc_ids.slice(x, y - x), *[pa.array(v.astype(np.int64)) for v in got[:4]], pa.array(got.groups, pa.string()), *lists]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return documents_of(docs).mapInArrow(run, SCHEMA)


def most_pairs(tokenizers: TokenizerPair) -> int:
    """An upper bound of the different id pairs that can be linked.

    The token that is no longer than the other is an ending of it, and each
    ending of an entry is the bytes of at most so many ids of the other
    vocabulary as share their bytes there.
    """

    def ids_sharing(entries: list[bytes]) -> int:
        seen: dict[bytes, int] = {}
        for x in entries:
            seen[x] = seen.get(x, 0) + 1
        return max(seen.values())

    return int(tokenizers.length_a.sum()) * ids_sharing(tokenizers.bytes_b) + int(tokenizers.length_b.sum()) * ids_sharing(tokenizers.bytes_a)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n``: how many links of the corpus hold each id pair."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("p.pairs", "p.times")
    return each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n"))


def score_links(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Adds ``n_best`` and ``count_sum`` to rows with ``pairs, times``, which it drops.

    ``n_best`` counts the links whose pair's count is the highest of all pairs
    with its id of B (ties included), ``count_sum`` adds up the counts over the
    links. ``counts`` has at most ``most_pairs`` rows, about half a million for
    vocabularies of 50 000 and 32 000 ids.
    """
    table = counts.orderBy("pair").toArrow()
    pair, n = table.column("pair").to_numpy(), table.column("n").to_numpy()
    best = np.zeros(int((pair & 0xFFFFFFFF).max()) + 1 if len(pair) else 1, dtype=np.int64)
    np.maximum.at(best, pair & 0xFFFFFFFF, n)
    shared = aligned.sparkSession.sparkContext.broadcast((pair, n, n == best[pair & 0xFFFFFFFF]))
    kept = [f for f in aligned.schema.fields if f.name not in ("pairs", "times")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", n_best long, count_sum long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, top = shared.value
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times").flatten().to_numpy()
            sizes = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(len(sizes)), sizes)
            at = np.searchsorted(pair, lists.flatten().to_numpy())
            sums = []
            for weight in (top[at], n[at]) if len(row) else (np.zeros(0), np.zeros(0)):
                total = np.zeros(len(sizes), dtype=np.int64)
                np.add.at(total, row, times * weight.astype(np.int64))
                sums.append(pa.array(total))
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, *sums], names=[*[f.name for f in kept], "n_best", "count_sum"])

    return aligned.mapInArrow(run, schema)


def alignment_digest(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum``, one row per input row (see ``align``).

    The written form of a text is several times its length, so only its digest is
    kept; the digest of a text without tokens is the empty string.
    """
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    rows = align(docs, path_a, path_b).withColumn("groups_sha256", digest)
    rows = cut(rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"))
    return score_links(rows, pair_counts(rows))
