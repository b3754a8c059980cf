"""Exact top-k lexical search with norm buckets (after LEMP).

A document is a vector of impacts, one for each term of the queries: the square
root of the term's weight times its saturated frequency. A query is a vector of
term counts times the same square roots, so scores are inner products.

The documents' vectors are ordered by length and cut into buckets of neighbouring
lengths, one file of the shared folder each. The bucket of the longest vectors is
searched first; its k-th scores are the first thresholds. In all other buckets:

* Cauchy-Schwarz drops a bucket, or the tail of one, for a query where
  ``|query| * |document|`` stays below the threshold; buckets that no query can use
  are not read;
* inside, a query's heaviest coordinates are its focus: they are chosen so that a
  document without any of them cannot reach the threshold. The partial score over
  the focus and a bound of the rest (Cauchy-Schwarz on what is left of both vectors,
  and the largest impact of each other coordinate in the bucket) filter the others;
* survivors are scored again exactly, in integers, and raise the threshold.

Queries come to the tasks in blocks of ``BLOCK_CHARS`` characters; the documents
are searched block after block.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradescope.llm.common import cut, documents_of

#: Maximal runs of these bytes are terms: ASCII letters and digits, and every byte of a character beyond ASCII.
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Characters of query texts that are searched together; more queries take more blocks.
BLOCK_CHARS = 4_000_000
#: Vectors of one bucket that are compared with all queries at a time.
CHUNK = 8192
#: Relative slack of bounds that are computed in floating point.
SLACK = 1e-9


def terms_of(text: str) -> list[bytes]:
    """Terms in order; only A-Z are lower-cased (which is what ``bytes.lower`` does)."""
    return TERM.findall(text.encode("utf-8", "surrogatepass").lower())


class Queries(NamedTuple):
    """A block of queries: their ids, and per query its distinct term numbers and counts."""

    item_ids: list
    vocabulary: dict[bytes, int]
    terms: list[np.ndarray]
    counts: list[np.ndarray]


def queries_of(rows: list[tuple]) -> Queries:
    """From rows ``item_id, text``; those without a term have no results and are left out."""
    vocabulary: dict[bytes, int] = {}
    out = Queries([], vocabulary, [], [])
    for item_id, text in rows:
        found = Counter(terms_of(text or ""))
        if found:
            out.item_ids.append(item_id)
            out.terms.append(np.array([vocabulary.setdefault(t, len(vocabulary)) for t in found], dtype=np.int64))
            out.counts.append(np.array(list(found.values()), dtype=np.int64))
    return out


class Statistics(NamedTuple):
    """Of all documents: how many have a term, how many terms they have, and each query term's weight."""

    n_docs: int
    n_terms: int
    weight: np.ndarray


def term_vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, times``: number of terms of each whole text, and how often it holds those of ``vocabulary``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # bounded by BLOCK_CHARS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            n, sizes, terms, times = [], [0], [], []
            for text in batch.column(1):
                words = terms_of(text.as_py())
                found = Counter(map(number, words))
                found.pop(None, None)
                n.append(len(words))
                terms += found.keys()
                times += found.values()
                sizes.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(x, pa.int32())) for x in (terms, times)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "terms", "times"])

    return documents_of(docs).mapInArrow(run, "doc_id long, n long, terms array<int>, times array<int>")


def statistics(vectors: DataFrame, n_vocabulary: int) -> Statistics:
    """Counts over all documents; a row per query term at most reaches the driver."""
    total = vectors.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_docs, n_terms = int(total[0]), int(total[1])
    held = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toArrow()
    df = np.zeros(n_vocabulary, dtype=np.int64)
    df[held.column("term").to_numpy()] = held.column("df").to_numpy()
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()]
    return Statistics(n_docs, n_terms, np.array(weight, dtype=np.int64))


def impact_vectors(vectors: DataFrame, stats: Statistics) -> DataFrame:
    """``doc_id, norm, terms, impacts``: saturated frequencies, and the length of the impact vector.

    Documents whose vector is zero score nothing with any query and are left out.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(stats)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            lists = batch.column("terms")
            sizes = np.diff(lists.offsets.to_numpy())
            terms, tf = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy().astype(np.int64)
            # In Python integers, which cannot overflow.
            m = np.array([75 + 25 * n * known.n_docs // known.n_terms if n else 75 for n in batch.column("n").to_pylist()], dtype=np.int64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[row])
            norm = np.sqrt(np.bincount(row, weights=known.weight[terms] * impact.astype(np.float64) ** 2, minlength=len(sizes)))
            impacts = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(impact.astype(np.int32)))
            out = [batch.column("doc_id"), pa.array(norm), lists, impacts]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "norm", "terms", "impacts"])

    return vectors.mapInArrow(run, "doc_id long, norm double, terms array<int>, impacts array<int>").where("norm > 0")


def norm_buckets(impacts: DataFrame) -> DataFrame:
    """The vectors in buckets by length, numbered from 0 (the longest), one file each, longest first.

    Vectors of one length (copies, say) are dealt over neighbouring buckets by the hash of their ids.
    """
    n = int(impacts.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ranged = impacts.repartitionByRange(n, F.col("norm").desc(), F.xxhash64("doc_id", "terms"))
    return ranged.withColumn("bucket", F.spark_partition_id()).sortWithinPartitions(F.col("norm").desc())


class Best:
    """The k best rows of one query so far: highest score first, then least id, null ids last."""

    def __init__(self, k: int, threshold: int):
        self.k, self.threshold = k, threshold
        self.score = self.doc = np.zeros(0, dtype=np.int64)
        self.null = np.zeros(0, dtype=bool)

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        score, doc, null = np.r_[self.score, score], np.r_[self.doc, doc], np.r_[self.null, null]
        order = np.lexsort((doc, null, -score))[: self.k]
        self.score, self.doc, self.null = score[order], doc[order], null[order]
        if len(order) == self.k:
            self.threshold = max(self.threshold, int(self.score[-1]))


class Chunk(NamedTuple):
    """Vectors of one bucket, longest first, as lists of rows by term."""

    doc: np.ndarray
    null: np.ndarray
    norm: np.ndarray
    begin: np.ndarray  # where each term's list begins
    row: np.ndarray
    impact: np.ndarray
    largest: np.ndarray  # the largest impact of each term


def chunk_of(batch: pa.RecordBatch, n_terms: int) -> Chunk:
    doc, norm = batch.column("doc_id"), batch.column("norm").to_numpy()
    order = np.argsort(-norm, kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    lists = batch.column("terms")
    sizes = np.diff(lists.offsets.to_numpy())
    term, impact = lists.flatten().to_numpy(), batch.column("impacts").flatten().to_numpy().astype(np.int64)
    row = place[np.repeat(np.arange(len(sizes)), sizes)]
    by_term = np.lexsort((row, term))
    term, row, impact = term[by_term], row[by_term], impact[by_term]
    begin = np.searchsorted(term, np.arange(n_terms + 1))
    largest = np.zeros(n_terms, dtype=np.int64)
    np.maximum.at(largest, term, impact)
    null = np.array(doc.is_null())[order]
    return Chunk(doc.fill_null(0).to_numpy()[order], null, norm[order], begin, row, impact, largest)


def search_chunk(chunk: Chunk, terms: np.ndarray, counts: np.ndarray, weight: np.ndarray, best: Best) -> int:
    """Adds the chunk's rows that can be among the best of one query, and returns how many were scored exactly.

    ``terms`` are in order of decreasing coordinates of the query.
    """
    factor = counts * weight[terms]
    coordinate2 = counts * factor  # squares of the query's coordinates
    left2 = np.r_[np.cumsum(coordinate2[::-1])[::-1], 0].astype(np.float64)  # of the coordinates from each place on
    least = best.threshold * (1 - SLACK)
    # Length: beyond this row no vector is long enough.
    n = int(np.searchsorted(-chunk.norm, -(least / math.sqrt(left2[0])), side="right")) if left2[0] else 0
    if not n:
        return 0
    rest_largest = np.r_[np.cumsum((factor * chunk.largest[terms])[::-1])[::-1], 0].astype(np.float64)
    rest = np.minimum(np.sqrt(left2) * chunk.norm[0], rest_largest)
    focus = int(np.argmax(rest < least)) if rest[-1] < least else len(terms)
    if not focus:
        return 0
    score, seen2 = np.zeros(n, dtype=np.int64), np.zeros(n)
    for t, f in zip(terms[:focus].tolist(), factor[:focus].tolist(), strict=True):
        a, b = chunk.begin[t], chunk.begin[t + 1]
        b = a + int(np.searchsorted(chunk.row[a:b], n))
        row, impact = chunk.row[a:b], chunk.impact[a:b]
        score[row] += f * impact
        seen2[row] += weight[t] * impact.astype(np.float64) ** 2
    at = np.flatnonzero(score)
    if focus < len(terms):
        unseen = np.sqrt(np.maximum(chunk.norm[at] ** 2 * (1 + SLACK) - seen2[at], 0))
        at = at[score[at] + np.minimum(math.sqrt(left2[focus]) * unseen, rest_largest[focus]) >= least]
    exact = score[at]
    for t, f in zip(terms[focus:].tolist(), factor[focus:].tolist(), strict=True):
        a, b = chunk.begin[t], chunk.begin[t + 1]
        if a < b and len(at):
            found = a + np.searchsorted(chunk.row[a:b], at)
            found = np.minimum(found, b - 1)
            exact += np.where(chunk.row[found] == at, f * chunk.impact[found], 0)
    kept = exact >= max(1, best.threshold)
    if kept.any():
        best.add(exact[kept], chunk.doc[at[kept]], chunk.null[at[kept]])
    return len(at)


def search_buckets(buckets: DataFrame, queries: Queries, weight: np.ndarray, thresholds: np.ndarray, k: int) -> DataFrame:
    """``query, doc_id, score, scored``: each task's k best rows of every query (``scored``: vectors it scored exactly)."""
    shared = buckets.sparkSession.sparkContext.broadcast((queries.terms, queries.counts, weight, thresholds))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, counts, weight, thresholds = shared.value
        order = [np.argsort(-(c * c * weight[t]), kind="stable") for t, c in zip(terms, counts, strict=True)]
        ordered = [(t[o], c[o]) for t, c, o in zip(terms, counts, order, strict=True)]
        best, scored = [Best(k, int(x)) for x in thresholds], np.zeros(len(terms), dtype=np.int64)
        for batch in batches:
            for x in range(0, batch.num_rows, CHUNK):
                chunk = chunk_of(batch.slice(x, CHUNK), len(weight))
                for q, (t, c) in enumerate(ordered):
                    scored[q] += search_chunk(chunk, t, c, weight, best[q])
        for q, b in enumerate(best):
            if len(b.score):
                out = {
                    "query": pa.array(np.full(len(b.score), q, dtype=np.int32)),
                    "doc_id": pa.array(b.doc, mask=b.null),
                    "score": pa.array(b.score),
                    "scored": pa.array(np.r_[scored[q], np.zeros(len(b.score) - 1, dtype=np.int64)]),
                }
                yield pa.RecordBatch.from_pydict(out)

    return buckets.select("doc_id", "norm", "terms", "impacts").mapInArrow(run, "query int, doc_id long, score long, scored long")


def best_rows(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_block(docs: DataFrame, queries: Queries, k: int) -> DataFrame:
    """``query, rank, doc_id, score`` of all documents for one block of queries."""
    spark = docs.sparkSession
    vectors = cut(term_vectors(docs, queries.vocabulary))
    stats = statistics(vectors, len(queries.vocabulary))
    buckets = cut(norm_buckets(cut(impact_vectors(vectors, stats))))
    nothing = np.zeros(len(queries.terms), dtype=np.int64)
    first = cut(search_buckets(buckets.where("bucket = 0"), queries, stats.weight, nothing, k))
    # The k-th score of a query, where it has so many rows; at most one number per query.
    kth = best_rows(first, k).where(F.col("rank") == k).select("query", "score").toArrow()
    thresholds = nothing.copy()
    thresholds[kth.column("query").to_numpy()] = kth.column("score").to_numpy()
    length = np.array([math.sqrt(float((c * c * stats.weight[t]).sum())) for t, c in zip(queries.terms, queries.counts, strict=True)])
    least = float((thresholds[length > 0] / length[length > 0]).min()) if (length > 0).any() else 0.0
    others = buckets.where((F.col("bucket") > 0) & (F.col("norm") >= least * (1 - SLACK)))
    found = first.unionByName(search_buckets(others, queries, stats.weight, thresholds, k))
    ids = spark.createDataFrame(list(enumerate(queries.item_ids)), "query int, item_id long")
    return best_rows(found, k).join(F.broadcast(ids), "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """The k best documents of each item: ``item_id, rank, doc_id, score``, scores above 0 only.

    A term's weight and a document's length norm count all documents; repeated
    terms of an item count as often. Equal scores rank by ascending doc_id, null
    ids last; rows that share an id or a text are documents of their own, as
    are items that share an id. Null and empty texts (of either side) hold no
    term: such documents are never found, such items have no rows. Other
    columns play no part. ``items`` is a set of queries, ``docs`` any table.
    """
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).where("text <> ''")
    n_blocks = max(1, math.ceil((items.agg(F.sum(F.char_length("text"))).first()[0] or 0) / BLOCK_CHARS))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in range(n_blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block)
        queries = queries_of([tuple(r) for r in mine.orderBy("item_id", "text").collect()])  # about BLOCK_CHARS characters
        if queries.item_ids:
            out = out.unionByName(search_block(docs, queries, k))
    return out
