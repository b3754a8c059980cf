"""Exact top-k inner products by the three-phase uniform threshold method.

Vectors become whole numbers, ``floor(1024 * x)``. A vector's dimensions are dealt
into ``SLICES`` (component i to slice i modulo their number); a score is the sum of
one partial score per slice. Queries and candidates are dealt into blocks of bounded
size, and a task meets one block of each.

1. The heads of the slices' lists, the candidates whose parts are longest, are
   scored per slice. A query's best partial scores there are resolved, and the
   k-th best of them is a cutoff that no answer falls below.
2. The cutoff travels to the tasks with the queries. By Cauchy-Schwarz a candidate
   whose parts are too short for every cutoff of a block of queries is not sent to
   that block. Of what arrives, a score at or above the cutoff has at least one
   partial score of the cutoff divided by the number of slices; only such entries
   are collected, and those whose upper bound (unseen slices at that threshold)
   stays below the cutoff are dropped again.
3. What remains is resolved exactly; each task passes on its k best per query.

All candidates are met once, in the second phase; the first one scores a number of
heads that does not grow with the table.
"""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradescope.llm.common import cut

SCALE = 1024
SLICES = 4
#: Queries and candidates that one task holds at a time.
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 8192
#: Groups of candidates that each give the longest of every slice as a head.
HEAD_GROUPS = CANDIDATE_BLOCK // SLICES
#: Scores that a task computes at a time.
CELLS = 1 << 20
#: Below this, sums of floats are exact, also those of ``SLICES`` times a score.
EXACT_FLOAT = 2.0**49
LONGEST = 2**63 - 1
#: Lengths are floats; so much may be lost to rounding.
SLACK = 1e-9
PARTS = [f"part{s}" for s in range(SLICES)]


def usable(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    """``vec_id, vector`` of the rows that take part: an id, and a vector without null, NaN or infinite components."""
    rows = df.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)))


def with_lengths(df: DataFrame) -> DataFrame:
    """Adds ``PARTS``: a bound on the length of each slice of ``vector`` in whole numbers (rounding down adds at most 1)."""

    def length(s: int) -> Column:
        part = F.filter("vector", lambda x, i: i % SLICES == s)
        return F.sqrt(F.aggregate(part, F.lit(0.0), lambda total, x: total + F.pow(F.abs(x) * SCALE + 1, F.lit(2.0))))

    return df.select("*", *[length(s).alias(name) for s, name in enumerate(PARTS)])


def matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Whole-number components as floats, a row per vector; short vectors are filled with zeros."""
    flat = pa.concat_arrays(vectors.chunks) if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(flat.offsets.to_numpy())
    values = np.floor(flat.flatten().to_numpy(zero_copy_only=False) * SCALE)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def widths(*vectors: pa.ChunkedArray) -> int:
    return max([1, *(int(n) for v in vectors for n in pc.list_value_length(v).to_pylist())])


class Block:
    """One block of queries against one block of candidates."""

    def __init__(self, queries: pa.Table, candidates: pa.Table):
        q, c = queries.column("vector"), candidates.column("vector")
        width = widths(q, c)
        self.ids, self.query_ids = candidates.column("vec_id").to_numpy(), queries.column("query_id").to_numpy()
        self.left, self.right = matrix(q, width), matrix(c, width)
        # In floats a sum is exact below a limit; larger components are whole numbers of any size.
        self.whole = width * np.abs(self.left).max(initial=0) * np.abs(self.right).max(initial=0) >= EXACT_FLOAT
        if self.whole:
            whole = np.vectorize(int, otypes=[object])
            self.left, self.right = (whole(x) if x.size else x.astype(object) for x in (self.left, self.right))

    def chunks(self):
        """Queries a few at a time: their numbers, and partial scores per slice (queries x candidates)."""
        step = max(1, CELLS // max(1, len(self.ids)))
        for a in range(0, len(self.query_ids), step):
            rows = np.arange(a, min(a + step, len(self.query_ids)))
            yield rows, [self.left[rows, s::SLICES] @ self.right[:, s::SLICES].T for s in range(SLICES)]

    def best(self, query: np.ndarray, among: np.ndarray, scores: np.ndarray, k: int) -> pa.Table:
        """Each query's k best of some candidates, ties to the smaller id, without the query itself."""
        other = self.ids[among] != self.query_ids[query]
        query, among, scores = query[other], among[other], scores[other]
        scores = np.clip(scores, -LONGEST - 1, LONGEST).astype(np.int64) if len(scores) else np.zeros(0, dtype=np.int64)
        # ~x turns the order of whole numbers round without leaving their range.
        order = np.lexsort((self.ids[among], ~scores, query))
        query, among, scores = query[order], among[order], scores[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        top = place < k
        return pa.table([self.query_ids[query[top]], self.ids[among[top]], scores[top]], schema=SCORED)


SCORED = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def together(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables) if tables else SCORED.empty_table()


def local_lists(k: int):
    """Phase 1: heads with the k + 1 best partial scores of any slice, resolved."""

    def run(queries: pa.Table, heads: pa.Table) -> pa.Table:
        block, out = Block(queries, heads), []
        n = len(block.ids)
        for rows, parts in block.chunks() if n else ():
            # One more than k, as the query itself may be among them.
            tops = [np.argpartition(-p.astype(float), min(k, n - 1), axis=1)[:, : k + 1] for p in parts]
            listed = np.zeros((len(rows), n), dtype=bool)
            np.put_along_axis(listed, np.concatenate(tops, axis=1), True, axis=1)
            q, c = np.nonzero(listed)
            out.append(block.best(rows[q], c, reduce(add, [p[q, c] for p in parts]), k))
        return together(out)

    return run


def resolve(k: int):
    """Phases 2 and 3: entries over the uniform threshold, their upper bounds, and exact scores of what remains."""

    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        block, out = Block(queries, candidates), []
        # Without a cutoff there are fewer than k candidates in all; the least score of all may stand for any below.
        known = [-np.inf if c is None or c < -LONGEST else c for c in queries.column("cutoff").to_pylist()]
        cutoffs = np.array(known, dtype=object if block.whole else float)
        for rows, parts in block.chunks() if len(block.ids) else ():
            # All is multiplied by the number of slices, so that the threshold, cutoff / SLICES, is whole too.
            cutoff = cutoffs[rows][:, None]
            seen = [(p * SLICES >= cutoff).astype(bool) for p in parts]
            q, c = np.nonzero(np.logical_or.reduce(seen))
            least = cutoff[q, 0]
            bound = reduce(add, [np.where(s[q, c], p[q, c] * SLICES, least) for s, p in zip(seen, parts, strict=True)])
            able = (bound >= least * SLICES).astype(bool)
            q, c, least = q[able], c[able], least[able]
            exact = reduce(add, [p[q, c] for p in parts])
            over = (exact >= least).astype(bool)
            out.append(block.best(rows[q[over]], c[over], exact[over], k))
        return together(out)

    return run


def heads_of(candidates: DataFrame) -> DataFrame:
    """``vec_id, vector`` of at most ``CANDIDATE_BLOCK`` candidates: the longest of each slice in every group, an id once."""
    group = F.pmod(F.xxhash64("vec_id"), F.lit(HEAD_GROUPS))
    row = F.struct("vec_id", "vector")
    longest = candidates.groupBy(group.alias("g")).agg(F.array(*[F.max_by(row, F.col(p)) for p in PARTS]).alias("rows"))
    return longest.select(F.explode("rows").alias("row")).select("row.*").dropDuplicates(["vec_id"])


def reach_of(told: DataFrame) -> DataFrame:
    """``qb, reach0..``: per block of queries and slice, the largest length of a query's part in units of its cutoff."""
    return told.groupBy("qb").agg(
        *[F.max(F.when(F.col("cutoff") > 0, F.col(p) / F.col("cutoff")).otherwise(float("inf"))).alias(f"reach{s}") for s, p in enumerate(PARTS)]
    )


def sent(candidates: DataFrame, reach: DataFrame) -> DataFrame:
    """A row per candidate and block of queries that it may score at or above a cutoff with (NaN counts as such)."""
    bound = reduce(add, [F.col(f"reach{s}") * F.col(p) for s, p in enumerate(PARTS)])
    return candidates.join(reach, "qb").where(bound >= 1 - SLACK)


def top_k(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best candidates of each query, all if there are fewer.

    Both inputs have ``vec_id, vector`` (see ``usable``). A candidate with the
    query's own id does not count; ties go to the smaller id; repeated
    candidate rows count each. Where queries share an id, the one whose vector
    hashes lowest is meant. Vectors of different lengths are compared as if
    filled with zeros. Scores beyond 64 bits
    count as the nearest long.
    """
    queries = queries.groupBy(F.col("vec_id").alias("query_id")).agg(F.min_by("vector", F.xxhash64("vector")).alias("vector"))
    queries, candidates = with_lengths(queries), with_lengths(candidates)
    n_queries, n_candidates = queries.count(), candidates.count()
    query_blocks, candidate_blocks = max(1, -(-n_queries // QUERY_BLOCK)), max(1, -(-n_candidates // CANDIDATE_BLOCK))

    def to_all(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    queries = queries.withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)))
    schema = "query_id long, vec_id long, score long"
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    heads = heads_of(candidates).withColumn("qb", to_all(query_blocks))
    first = queries.select("qb", "query_id", "vector").groupBy("qb").cogroup(heads.groupBy("qb")).applyInArrow(local_lists(k), schema)
    cutoffs = first.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") == k).select("query_id", F.col("score").alias("cutoff"))
    told = cut(queries.join(cutoffs, "query_id", "left"))
    # One row per 1024 queries; as a written table its size is known when the join is chosen.
    reach = cut(reach_of(told))
    # Rows are numbered, not hashed: repeated rows spread over the blocks as well.
    dealt = candidates.withColumn("cb", F.pmod(F.monotonically_increasing_id(), F.lit(candidate_blocks))).withColumn("qb", to_all(query_blocks))
    dealt = sent(dealt, reach).select("qb", "cb", "vec_id", "vector")
    asking = told.select("qb", "query_id", "vector", "cutoff").withColumn("cb", to_all(candidate_blocks))
    last = asking.groupBy("qb", "cb").cogroup(dealt.groupBy("qb", "cb")).applyInArrow(resolve(k), schema)
    return last.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
