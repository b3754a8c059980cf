"""Best-fit packing of tokenised documents into sequences of bounded length.

1. Every document becomes token ids plus an end id; only documents longer than
   a sequence are cut. A piece carries its length and a checksum, never its ids.
2. The pieces are counted by length: a histogram of at most ``capacity`` rows,
   whatever the size of the table. That is all the planning step reads.
3. Martello-Toth dominance reduction on the histogram: for a longest piece, if
   one piece, or a pair, provably dominates everything else that could share
   its sequence, that set is fixed for good; the rest is a smaller instance.
   What cannot be reduced is packed best-fit in descending order. Both work on
   whole length classes, so the plan is a list of patterns with multiplicities.
4. Each piece gets a rank among the pieces of its length (length classes are
   split by a hash, so a length that a third of all pieces share is ranked in
   many tasks) and the plan turns the rank into a sequence and an offset.
"""

from __future__ import annotations

import os
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradescope.llm.common import cut, documents_of, map_rows

CAPACITY = 4096
END_ID = 1
#: Words kept per Python worker; the cache is emptied beyond it.
CACHE_WORDS = 350_000
#: Most pieces of one length that are ranked together.
RANKED_TOGETHER = 50_000
#: Below this letter lower-casing and NFC work letter by letter, and no letter combines.
SIMPLE_LETTERS = "\u0250"
DOTTED_I = "\u0130"
#: Marks that never join a letter in the pre-tokenizer (an apostrophe may).
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class WordTokens(dict):
    """Token ids of whole texts from a tokenizer whose pre-tokenizer drops white space.

    No merge reaches across white space, so a text's ids are those of its
    blank-separated parts in turn. This dictionary holds the ids of the parts
    met so far as little-endian unsigned 32-bit numbers. A part of plain
    letters, with marks after it, goes straight to the tokenizer's merges
    (lower case, byte-level form); any other part goes through all of its steps.
    The strings of special tokens hold no blank, so a part holds them whole; with
    ``special_ids`` they get their own ids, as in the library's default, otherwise
    they are ordinary text.
    """

    def __init__(self, tokenizer_file: str, special_ids: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__({"": b""})
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.encode_special_tokens = not special_ids
        self.merges = self.tokenizer.model
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_form = {chr(c): level.pre_tokenize_str(chr(c))[0][0] for c in range(0x41, ord(SIMPLE_LETTERS)) if chr(c).isalpha()}

    def __missing__(self, part: str) -> bytes:
        core = part.rstrip(MARKS)
        if core and core.isalpha() and max(core) < SIMPLE_LETTERS and DOTTED_I not in core:
            if core != part:
                ids = self[core] + self[part[len(core) :]]
            elif (lower := core.lower()) != core:
                ids = self[lower]
            else:
                known = core if core.isascii() else "".join(map(self.byte_form.__getitem__, core))
                ids = self._as_bytes([t.id for t in self.merges.tokenize(known)])
        else:
            ids = self._as_bytes(self.tokenizer.encode(part, add_special_tokens=False).ids)
        if len(self) >= CACHE_WORDS:
            self.clear()
            self[""] = b""
        self[part] = ids
        return ids

    @staticmethod
    def _as_bytes(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def token_bytes(self, text: str) -> bytes:
        """The ids of a whole text."""
        parts = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(map(self.__getitem__, parts))


@lru_cache(maxsize=2)
def word_tokens(tokenizer_file: str, special_ids: bool = False) -> WordTokens:
    return WordTokens(tokenizer_file, special_ids)


def pieces_of(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of each whole text (null: empty, i.e. only the end id).

    The ids are those of ``Tokenizer.encode(text, add_special_tokens=False)`` with the tokenizer as loaded.
    """
    tail = np.array([end_id], dtype="<u4").tobytes()

    def run(cols):
        enc = word_tokens(tokenizer_file, special_ids=True)
        out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
        for doc_id, text in zip(cols["doc_id"], cols["text"], strict=True):
            ids = enc.token_bytes(text) + tail
            for piece, begin in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[begin : begin + 4 * capacity]
                for k, v in zip(out, (doc_id, piece, begin // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                    out[k].append(v)
        return out

    return map_rows(documents_of(docs), run, "doc_id long, piece int, start long, length long, ids_crc32 long")


# -- the plan ---------------------------------------------------------------
Pattern = tuple[tuple[tuple[int, int], ...], int]
"""(length, copies) pairs that share a sequence, and how many such sequences."""


def _largest(n: np.ndarray, upto: int) -> int:
    """Longest length that is left and at most ``upto`` (0: none)."""
    if upto < 1:
        return 0
    at = np.flatnonzero(n[1 : upto + 1])
    return int(at[-1]) + 1 if len(at) else 0


def _smallest(n: np.ndarray, how_many: int) -> list[int]:
    """The shortest pieces that are left, with repeats."""
    out: list[int] = []
    for length in np.flatnonzero(n)[:how_many].tolist():
        out += [length] * min(int(n[length]), how_many - len(out))
    return out


def _pair_escapes(n: np.ndarray, free: int, a: int, b: int) -> bool:
    """Whether some pair that fits ``free`` is not dominated by the set {a, b} (b = 0: {a}); a is the longest that fits."""
    lengths = np.flatnonzero(n[: free + 1])
    for q in lengths[(lengths > b) & (lengths <= free // 2)].tolist():
        p = _largest(n, free - q)
        if p == q and n[q] < 2:
            rest = lengths[lengths < q]
            p = int(rest[-1]) if len(rest) else 0
        if p >= q and p + q > a:
            return True
    return False


def dominant_sets(counts: np.ndarray, capacity: int = CAPACITY) -> tuple[list[Pattern], np.ndarray]:
    """Martello-Toth reduction: patterns that some best packing contains, and the counts that remain.

    ``counts[length]`` pieces of each length from 1 to ``capacity``. A set is
    fixed for a longest piece j if every other set that fits beside j can be
    dealt onto the set's pieces so that no piece receives more than its length.
    """
    n, fixed = counts.copy(), []

    def fix(lengths: list[int], times: int) -> None:
        kinds = {x: lengths.count(x) for x in lengths}
        for x, k in kinds.items():
            n[x] -= k * times
        fixed.append((tuple(sorted(kinds.items(), reverse=True)), times))

    def at_most(lengths: list[int]) -> int:
        return min(int(n[x]) // lengths.count(x) for x in set(lengths))

    changed = True
    while changed:
        changed = False
        for j in range(capacity, 0, -1):
            while n[j]:
                n[j] -= 1  # j itself; what else is left may join it
                free = capacity - j
                a = _largest(n, free)
                small = _smallest(n, 3)
                chosen: list[int] | None = None
                if not a:
                    chosen = [j]
                elif a == free or len(small) < 2 or small[0] + small[1] > free:
                    chosen = [j, a]  # one more at most, or a perfect fit: the longest dominates
                elif len(small) < 3 or sum(small) > free:
                    n[a] -= 1
                    b = _largest(n, free - a)
                    n[a] += 1
                    if not _pair_escapes(n, free, a, b):
                        chosen = [j, a, b] if b else [j, a]
                n[j] += 1
                if chosen is None:
                    break
                fix(chosen, at_most(chosen))
                changed = True
    return fixed, n


def best_fit(counts: np.ndarray, capacity: int = CAPACITY) -> list[Pattern]:
    """Best-fit decreasing on length classes: each piece goes where it leaves the least room."""
    open_bins: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}
    room = np.zeros(capacity + 1, dtype=bool)
    done: list[Pattern] = []

    def put(left: int, pattern: tuple[tuple[int, int], ...], times: int) -> None:
        if left and times:
            open_bins.setdefault(left, []).append((pattern, times))
            room[left] = True
        elif times:
            done.append((pattern, times))

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            at = np.flatnonzero(room[length:])
            free = int(at[0]) + length if len(at) else capacity
            pattern, bins = open_bins[free].pop() if len(at) else ((), left)
            if len(at) and not open_bins[free]:
                room[free] = False
            each = free // length  # a bin that took one piece has the least room for the next
            whole, rest = min(bins, left // each), 0
            if whole < bins and left > whole * each:
                rest = min(left - whole * each, each - 1)
            put(free - each * length, (*pattern, (length, each)), whole)
            if rest:
                put(free - rest * length, (*pattern, (length, rest)), 1)
            if len(at):
                put(free, pattern, bins - whole - bool(rest))
            left -= whole * each + rest
    for bins in open_bins.values():
        done.extend(bins)
    return done


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that hold every piece of the histogram: reduced sets first, the remainder best-fit."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        counts[length] = n
    fixed, rest = dominant_sets(counts, capacity)
    return fixed + best_fit(rest, capacity)


def runs_of(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """The plan by length and rank: sorted ``code`` (length, first rank), first ``sequence``, ``copies`` a sequence, ``offset``."""
    rows, used, sequence = [], {}, 0
    for pattern, times in patterns:
        offset = 0
        for length, copies in pattern:
            first = used.get(length, 0)
            rows.append(((length << 44) | first, sequence, copies, offset, length))
            used[length] = first + copies * times
            offset += length * copies
        sequence += times
    rows.sort()
    names = ("code", "sequence", "copies", "offset", "length")
    return {k: np.array([r[i] for r in rows], dtype=np.int64) for i, k in enumerate(names)}


def assign(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to ``pieces`` (any columns with ``doc_id, piece, start, length, ids_crc32``).

    ``pieces`` is read several times, so pass a materialised table.
    """
    spark = pieces.sparkSession
    per_length = pieces.groupBy("length").count()
    histogram = {r["length"]: r["count"] for r in per_length.collect()}  # at most ``capacity`` rows
    total = sum(histogram.values())
    width = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    together = max(1, min(RANKED_TOGETHER, total // (4 * width)))
    runs = runs_of(plan(histogram, capacity))
    shares = spark.createDataFrame([(k, -(-v // together)) for k, v in histogram.items()], "length long, shares long")
    # Bounded by the capacity: one row per length.
    split = pieces.join(F.broadcast(shares), "length").withColumn("share", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("shares")))
    sizes = split.groupBy("length", "share").count()
    before = sizes.select(
        "length", "share", (F.sum("count").over(Window.partitionBy("length").orderBy("share")) - F.col("count")).alias("before")
    )
    order = Window.partitionBy("length", "share").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = split.withColumn("rank", F.row_number().over(order)).join(before, ["length", "share"]).withColumn("rank", F.col("rank") - 1 + F.col("before"))
    out = ranked.select(*pieces.columns, "rank")
    schema = out.drop("rank").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema

    def place(batches):
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(k)).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("length", "rank"))
            at = np.searchsorted(runs["code"], (length << 44) | rank, side="right") - 1
            nth = rank - (runs["code"][at] & ((1 << 44) - 1))
            sequence = runs["sequence"][at] + nth // runs["copies"][at]
            offset = runs["offset"][at] + (nth % runs["copies"][at]) * length
            kept = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=schema.names)

    return out.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Packs all documents: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``, one row per piece.

    Null and empty texts are pieces of the end id alone. Repeated rows are
    packed each on its own; a null doc_id stays null. An empty table gives no
    rows. Other columns are ignored.
    """
    return assign(cut(pieces_of(docs, tokenizer_file, capacity, end_id)), capacity)
