"""Near-duplicate classes by BagMinHash signatures, banding and exact verification.

A text is the multiset of its shingles of five words. Two texts are near
duplicates if their weighted Jaccard similarity (sum of the smaller counts over
sum of the larger ones) is at least ``THRESHOLD``; classes are the connected
components of that relation.

Signature. Each shingle owns Poisson processes over the weights, one for each
dyadic interval (0, 1], (1, 2], (2, 4], (4, 8], ... A point of a process has a
time, a component of the signature and a place in the interval, found by halving
it down to whole weights; a shingle of weight w owns the points up to w. The
signature holds the first time in each component, so two components agree with
the weighted Jaccard similarity as probability, without bias. Points are made
for all texts of a chunk at once, and a process ends when its time passes the
largest of its text's components.

Candidates. Bands of the signature become bucket keys. Texts with equal words
are one node from the start, so copies never meet in a bucket. Small buckets
are compared pair by pair. In a large bucket every member is compared with one
pivot, which differs from band to band; what the pivots leave outside a bucket's
largest component is then held against all members of other components, in
chunks of bounded size, by signatures of ``FINE`` components. A bucket of very many
members is banded again by these first, so that members which are all unlike do not
meet in it. Within a component no
further link can change the classes, so no class is lost and no bucket is
spelled out as pairs. A sketch of one bit per component, or the finer signature,
drops pairs that are far below the threshold (four standard deviations) before
their texts are compared.

Verification compares the multisets exactly. Components come from repeated
contraction of the links, materialised in the shared folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradescope.llm.common import cut, keyed, map_rows, same_row
from tradescope.llm.sentencepiece_bpe import groups_by_size

SHINGLE = 5
THRESHOLD = 0.8
COMPONENTS = 256
#: Bands and rows: a pair of similarity 0.8 shares a bucket with probability 0.9998.
BANDS, ROWS = 36, 7
#: Of 256 sketch bits a pair at the threshold differs in 25.6 on average (standard deviation 4.8).
MOST_BITS = 45
#: Components of the finer signature, one byte each: a pair at the threshold agrees in 80 % (standard deviation 1.25 %).
FINE = 1024
LEAST_FINE = 0.75
#: Characters of the texts that get finer signatures together.
FINE_CHARS = 100_000
#: Rows of a large bucket, on either side, that one task compares at a time (on average: rows are dealt by hash).
CHUNK = 2048
SKETCH = [f"s{k}" for k in range(COMPONENTS // 64)]
#: Buckets up to this size are compared pair by pair.
SMALL_BUCKET = 24
#: Buckets beyond this size are banded again by the finer signature: 102 bands of 10 of its bytes, which
#: a pair at the threshold passes with probability 0.99999 and a pair of similarity 0.3 with 0.0007.
OVERSIZED = 8 * CHUNK
SUB_BANDS, SUB_ROWS = 102, 10

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit numbers."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(maxsize=1)
def word_characters() -> np.ndarray:
    return np.fromiter((chr(c).isalnum() or c == 0x5F for c in range(0x110000)), dtype=bool, count=0x110000)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-case words of all texts in turn, and how many words each text has.

    A text without words that is not empty counts as one word, itself.
    """
    lowered = [t.lower() for t in texts]
    joined = "\n".join(["", *lowered, ""])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    inside = word_characters()[codes]
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    text_ends = np.cumsum([len(t) + 1 for t in lowered])
    counts = np.diff(np.r_[0, np.searchsorted(starts, text_ends, side="right")])
    if len(starts):
        sizes = ends - starts
        at = np.flatnonzero(inside)
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        place = np.arange(len(at)) - first
        powers = np.cumprod(np.full(int(sizes.max()), 0x9E3779B97F4A7C15, dtype=U))
        sums = np.add.reduceat(mix(codes[at].astype(U)) * powers[place], np.cumsum(sizes) - sizes)
        hashes = mix(sums + sizes.astype(U))
    else:
        hashes = np.zeros(0, dtype=U)
    bare = [k for k, (t, n) in enumerate(zip(lowered, counts.tolist(), strict=True)) if t and not n]
    if bare:
        at = np.cumsum(counts)[bare]
        own = [int.from_bytes(hashlib.blake2b(lowered[k].encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for k in bare]
        hashes = np.insert(hashes, at, np.array(own, dtype=U))
        counts[bare] = 1
    return hashes, counts


def content_keys(hashes: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """One 128-bit key per text: equal for texts with the same words in the same order."""
    raw, ends = hashes.tobytes(), (np.cumsum(counts) * 8).tolist()
    return [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip([0, *ends], ends, strict=False)]


def shingles(hashes: np.ndarray, counts: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: text number (ascending), hash (ascending within a text), multiplicity.

    Fewer than ``width`` words make one shingle; an empty text has none.
    """
    text = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
    left = np.repeat(counts, counts) - place
    begins = (left >= width) | (place == 0)
    padded = np.r_[hashes, np.zeros(width, dtype=U)]
    total = np.zeros(len(hashes), dtype=U)
    for k in range(width):
        total = mix(total + np.where(k < left, padded[k : k + len(hashes)], U(0)) + U(k + 1))
    text, total = text[begins], total[begins]
    order = np.lexsort((total, text))
    text, total = text[order], total[order]
    new = np.r_[True, (text[1:] != text[:-1]) | (total[1:] != total[:-1])] if len(text) else np.zeros(0, dtype=bool)
    at = np.flatnonzero(new)
    return text[at], total[at], np.diff(np.r_[at, len(text)])


def signatures(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_texts: int, m: int = COMPONENTS) -> np.ndarray:
    """BagMinHash: first times per text and component (infinite for a text without shingles)."""
    level = np.ceil(np.log2(weight)).astype(np.int64)  # the intervals that a weight reaches into: 0..level
    owner = np.repeat(np.arange(len(text)), level + 1)
    interval = np.arange(len(owner)) - np.repeat(np.cumsum(level + 1) - (level + 1), level + 1)
    below = np.where(interval == 0, 0, 1 << np.maximum(interval - 1, 0))  # the interval is (below, below + size]
    size = np.maximum(below, 1)
    seed = mix(shingle[owner] + interval.astype(U) * U(0xD6E8FEB86659FD93))
    doc, w = text[owner], weight[owner]
    times = np.zeros(len(owner))
    out = np.full(n_texts * m, np.inf)
    last = np.full(n_texts, np.inf)
    active, made, block = np.arange(len(owner)), 0, 1
    while len(active):
        nth = np.arange(made, made + block, dtype=U)
        raw = mix(seed[active][:, None] + nth * U(0x9E3779B97F4A7C15))
        gap = -np.log(((raw >> U(11)).astype(np.float64) + 0.5) * 2.0**-53) / size[active][:, None]
        at = times[active][:, None] + np.cumsum(gap, axis=1)
        times[active] = at[:, -1]
        other = mix(raw + U(0xA0761D6478BD642F))
        part = size[active] > 1
        owned = np.ones(at.shape, dtype=bool)
        if part.any():  # the place in the interval: its high bits tell the half, the next the quarter, ...
            place = below[active][part, None] + 1 + (((other[part] >> U(32)).astype(np.float64) * 2.0**-32) * size[active][part, None]).astype(np.int64)
            owned[part] = place <= w[active][part, None]
        cell = doc[active][:, None] * m + (other & U(m - 1)).astype(np.int64)
        owned &= at < last[doc[active]][:, None]
        np.minimum.at(out, cell[owned], at[owned])
        last = out.reshape(n_texts, m).max(axis=1)
        active = active[times[active] < last[doc[active]]]
        made += block
        block = min(256, block + max(1, block // 2))
    return out.reshape(n_texts, m)


def band_keys(signature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket keys (texts x bands) and sketch words (texts x 64-bit words) of finite signatures."""
    identity = mix(signature.view(U))
    rows = identity[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U), rows.shape[:2]).copy()
    for k in range(ROWS):
        keys = mix(keys + rows[:, :, k])
    bits = (identity >> U(17)) & U(1)
    words = (bits.reshape(len(signature), -1, 64) << np.arange(64, dtype=U)).sum(axis=2, dtype=U)
    return keys.view(np.int64), words.view(np.int64)


def sign(docs: DataFrame) -> DataFrame:
    """``doc_id, t1, t2, content, buckets array<long>, s0..s3`` of each whole text; a text without words has no buckets."""

    def run(cols):
        out = {c: cols[c] for c in ("doc_id", "t1", "t2")} | {"content": [], "buckets": []} | {s: [] for s in SKETCH}
        for a, b in groups_by_size(cols["text"]):
            hashes, counts = word_hashes(cols["text"][a:b])
            out["content"] += content_keys(hashes, counts)
            full = np.flatnonzero(counts)
            text, shingle, weight = shingles(hashes, counts[full])
            keys, words = band_keys(signatures(text, shingle, weight, len(full)))
            buckets: list[list[int]] = [[] for _ in range(b - a)]
            sketch = np.zeros((b - a, len(SKETCH)), dtype=np.int64)
            sketch[full] = words
            for k, row in zip(full.tolist(), keys.tolist(), strict=True):
                buckets[k] = row
            out["buckets"] += buckets
            for k, s in enumerate(SKETCH):
                out[s] += sketch[:, k].tolist()
        return out

    return map_rows(keyed(docs), run, f"doc_id long, t1 long, t2 long, content binary, buckets array<long>, {', '.join(f'{s} long' for s in SKETCH)}")


# -- verification -------------------------------------------------------------
def shingle_counts(text: str) -> tuple[np.ndarray, np.ndarray, bytes]:
    hashes, counts = word_hashes([text])
    _, shingle, weight = shingles(hashes, counts)
    return shingle, weight, content_keys(hashes, counts)[0]


def similarity(a: tuple[np.ndarray, np.ndarray, bytes], b: tuple[np.ndarray, np.ndarray, bytes]) -> float:
    """Weighted Jaccard similarity; two texts without shingles are equal."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    both = int(a[1].sum() + b[1].sum()) - common
    return common / both if both else 1.0


def rows_of(keyed_rows: DataFrame, holders: DataFrame, names: list[str]) -> DataFrame:
    """``names`` of the rows that ``holders`` names (by ``doc_id, t1, t2``; ``copies`` equal rows exist), each once.

    Always by shuffle, since the list grows with the table. Only rows that exist
    more than once take the step that leaves one of them.
    """
    found = keyed_rows.alias("d").join(holders.hint("merge").alias("h"), same_row("d", "h"))
    found = found.select("copies", *[F.col(f"d.{c}").alias(c) for c in ("doc_id", "t1", "t2")], *names)
    several = found.where("copies > 1").dropDuplicates(["doc_id", "t1", "t2"])
    return found.where("copies = 1").unionByName(several).select(*names)


def texts_of(contents: DataFrame, docs: DataFrame, holders: DataFrame) -> DataFrame:
    """``content, text`` for the given contents; ``holders`` names one row for each."""
    return rows_of(keyed(docs), holders.join(contents, "content"), ["content", "text"])


def verify(pairs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs ``a, b`` (contents) whose texts reach the threshold, with their exact ``similarity``."""
    left = texts.select(F.col("content").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("content").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[np.ndarray, np.ndarray, bytes]] = {}

        def counts(content: bytes, text: str) -> tuple[np.ndarray, np.ndarray, bytes]:
            if content not in known:
                if len(known) >= 64:
                    known.clear()
                known[content] = shingle_counts(text)
            return known[content]

        for batch in batches:
            out = {"a": [], "b": [], "similarity": []}
            for k in range(batch.num_rows):
                a, b, text_a, text_b = (batch.column(i)[k].as_py() for i in range(4))
                x, y = counts(a, text_a), counts(b, text_b)
                if (s := similarity(x, y)) >= threshold:
                    for name, v in zip(out, (a, b, s), strict=True):
                        out[name].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("a", pa.binary()), ("b", pa.binary()), ("similarity", pa.float64())]))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary, similarity double")


# -- components -----------------------------------------------------------------
def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every end of ``links`` (``a, b``): the least node that a path of links reaches.

    Each round hooks every node to its least neighbour, follows that node's own
    hook, and contracts: links between the merged nodes remain, those within one
    vanish. A path of n links takes about log(n) rounds, links shrink with every
    round, and the rounds end when none is left.
    """
    edges = cut(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), free=True)
    labels = edges.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct()
    while edges.limit(1).count():
        hooks = cut(edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("hook")), free=True)
        second = hooks.select(F.col("a").alias("hook"), F.col("hook").alias("to"))
        parents = cut(hooks.join(second, "hook").select("a", "to"), free=True)
        labels = cut(labels.join(parents.withColumnRenamed("a", "label"), "label", "left").select("node", F.coalesce("to", "label").alias("label")), free=True)
        left, right = parents.select("a", F.col("to").alias("x")), parents.select(F.col("a").alias("b"), F.col("to").alias("y"))
        edges = cut(edges.join(left, "a").join(right, "b").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), free=True)
    return labels


# -- candidates -------------------------------------------------------------------
def _close(a: str, b: str) -> Column:
    """The sketches of two rows differ in few bits."""
    return sum((F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in SKETCH), F.lit(0)) <= MOST_BITS


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.least("x.content", "y.content").alias("a"), F.greatest("x.content", "y.content").alias("b")).distinct()


def shared_buckets(nodes: DataFrame) -> DataFrame:
    """``bucket, content, n, pivot, s0..s3``: members of buckets with at least two nodes; ``pivot`` marks one in each."""
    members = nodes.select("content", F.explode("buckets").alias("bucket"))
    place = F.xxhash64("bucket", "content")
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1")
    found = members.join(sizes, "bucket").select("bucket", "content", "n", (place == F.col("first")).alias("pivot"))
    return found.join(nodes.select("content", *SKETCH), "content")


def first_pairs(shared: DataFrame) -> DataFrame:
    """All pairs of small buckets, and each member of a large one with the bucket's pivot."""
    small, large = shared.where(F.col("n") <= SMALL_BUCKET), shared.where(F.col("n") > SMALL_BUCKET)
    every = small.alias("x").join(small.alias("y"), (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.content") < F.col("y.content")) & _close("x", "y"))
    pivots = large.where("pivot")
    star = large.alias("x").join(pivots.alias("y"), (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.content") != F.col("y.content")) & _close("x", "y"))
    return _pairs(every).union(_pairs(star)).distinct()


def fine_signatures(texts: DataFrame) -> DataFrame:
    """``content, fine``: signatures of ``FINE`` components, one byte of each."""

    def run(cols):
        out = {"content": [], "fine": []}
        for a, b in groups_by_size(cols["text"], FINE_CHARS):
            hashes, counts = word_hashes(cols["text"][a:b])
            keys, full = content_keys(hashes, counts), np.flatnonzero(counts)
            text, shingle, weight = shingles(hashes, counts[full])
            fine = (mix(signatures(text, shingle, weight, len(full), FINE).view(U)) >> U(40)).astype(np.uint8)
            for k, row in zip(full.tolist(), fine, strict=True):
                out["content"].append(keys[k])
                out["fine"].append(row.tobytes())
        return out

    return map_rows(texts.select("content", "text"), run, "content binary, fine binary")


def close_pairs(outside: pa.Table, members: pa.Table) -> pa.Table:
    """Pairs of a row outside and a member with another label that the sketch and the finer signature let pass.

    Two texts may share several buckets; the first of these passes their pair on.
    """
    out: dict[str, list[bytes]] = {"a": [], "b": []}
    if outside.num_rows and members.num_rows:
        sketch = [np.stack([t.column(s).to_numpy() for s in SKETCH], axis=1).view(U) for t in (outside, members)]
        fine = [np.frombuffer(b"".join(t.column("fine").to_pylist()), dtype=np.uint8).reshape(-1, FINE) for t in (outside, members)]
        names = [t.column("content").to_pylist() for t in (outside, members)]
        buckets = [t.column("buckets").to_pylist() for t in (outside, members)]
        here, apart = outside.column("bucket")[0].as_py(), members.column("outside").to_pylist()
        number = {x: k for k, x in enumerate({*outside.column("label").to_pylist(), *members.column("label").to_pylist()})}
        label = [np.array([number[x] for x in t.column("label").to_pylist()]) for t in (outside, members)]
        for i, name in enumerate(names[0]):
            bits = np.bitwise_count(sketch[0][i] ^ sketch[1]).sum(axis=1)
            near = np.flatnonzero((bits <= MOST_BITS) & (label[1] != label[0][i]))
            equal = (fine[1][near] == fine[0][i]).mean(axis=1)
            mine = set(buckets[0][i])
            for j in near[(equal - 1 / 256) / (1 - 1 / 256) >= LEAST_FINE].tolist():
                other = names[1][j]
                # A pair of two rows outside meets twice in a bucket.
                if here == min(mine.intersection(buckets[1][j])) and not (apart[j] and other < name):
                    a, b = sorted((name, other))
                    out["a"].append(a)
                    out["b"].append(b)
    return pa.table({k: pa.array(v, pa.binary()) for k, v in out.items()})


def left_over_pairs(shared: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """In large buckets: members outside the bucket's largest component with the members of other components that come close."""
    large = shared.where(F.col("n") > SMALL_BUCKET)
    fine = cut(fine_signatures(texts.join(large.select("content").distinct(), "content", "left_semi")))
    sketches = large.select("content", *SKETCH).dropDuplicates(["content"])
    large = large.select("bucket", "content", "n").join(labels.withColumnRenamed("node", "content"), "content", "left").withColumn("label", F.coalesce("label", "content"))
    per_label = large.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("k"))
    main = per_label.groupBy("bucket").agg(F.max_by("label", F.struct("k", "label")).alias("main"), (F.sum("k") - F.max("k")).alias("n_outside"))
    large = large.join(main.where("n_outside > 0"), "bucket").join(fine, "content")
    # Members of an oversized bucket only meet where a band of their finer signatures agrees, as if in buckets of their own.
    again = F.transform(F.sequence(F.lit(0), F.lit(SUB_BANDS - 1)), lambda i: F.xxhash64("bucket", i, F.substring(F.col("fine"), i * SUB_ROWS + 1, F.lit(SUB_ROWS))))
    places = F.when(F.col("n") > OVERSIZED, again).otherwise(F.array("bucket"))
    large = cut(large.select("content", "label", (F.col("label") != F.col("main")).alias("outside"), F.explode(places).alias("bucket")))
    sizes = large.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("outside").cast("long")).alias("n_outside"))
    chunks = [F.ceil(F.col(n) / CHUNK).cast("long").alias(c) for n, c in (("n", "chunks"), ("n_outside", "outside_chunks"))]
    large = large.join(sizes.where("n > 1 AND n_outside > 0").select("bucket", *chunks), "bucket")
    own = large.groupBy("content").agg(F.collect_list("bucket").alias("buckets"))  # one per band at most, or sub-band of one
    large = cut(large.join(fine, "content").join(sketches, "content").join(own, "content"))

    def dealt(side: DataFrame, own_chunk: str, of: str, other_chunk: str, others: str) -> DataFrame:
        """Every row in one chunk of its own side and in all chunks of the other."""
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(others) - 1))
        return side.withColumn(own_chunk, F.pmod(F.xxhash64("content"), of)).withColumn(other_chunk, every).groupBy("bucket", "outside_chunk", "chunk")

    outside = dealt(large.where("outside"), "outside_chunk", "outside_chunks", "chunk", "chunks")
    members = dealt(large, "chunk", "chunks", "outside_chunk", "outside_chunks")
    met = outside.cogroup(members).applyInArrow(close_pairs, "a binary, b binary")
    return met.distinct()


def classify(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, contents, links): ``doc_id, t1, t2, content`` of every row; per content the row that stands for it and its class; verified links.

    ``contents`` has ``content, doc_id, t1, t2, copies, label, class_id, kept``: the
    row with the least id that has these words (null ids last), how many rows equal
    it, the class's label and least id, and whether its row is the one that the
    class keeps.
    """
    signed = cut(sign(docs))
    holder = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "t1", "t2")
    nodes = signed.groupBy("content").agg(F.min(holder).alias("holder"), F.first("buckets").alias("buckets"), *[F.first(s).alias(s) for s in SKETCH])
    repeated = signed.groupBy("doc_id", "t1", "t2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    holders = nodes.select("content", "holder.doc_id", "holder.t1", "holder.t2").alias("h").join(repeated.alias("r"), same_row("h", "r"), "left")
    holders = cut(holders.select("content", "h.doc_id", "h.t1", "h.t2", F.coalesce("n", F.lit(1)).alias("copies")))
    shared = cut(shared_buckets(nodes))
    texts = cut(texts_of(shared.select("content").distinct(), docs, holders))
    tried = cut(first_pairs(shared))
    links = cut(verify(tried, texts, threshold))
    labels = components(links)
    if shared.where(F.col("n") > SMALL_BUCKET).limit(1).count():
        more = cut(left_over_pairs(shared, labels, texts).join(tried, ["a", "b"], "left_anti"))
        links = cut(links.union(verify(more, texts, threshold)))
        labels = components(links)
    classed = holders.join(labels.withColumnRenamed("node", "content"), "content", "left").withColumn("label", F.coalesce("label", "content"))
    first = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "content")
    least = classed.groupBy("label").agg(F.min(first).alias("first"))
    contents = classed.join(least, "label").withColumn("class_id", F.col("first.doc_id")).withColumn("kept", F.col("content") == F.col("first.content"))
    return signed.select("doc_id", "t1", "t2", "content"), contents.drop("first"), links


def near_classes(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(documents, links): ``doc_id, content, class_id, kept`` for every row, and the verified links ``a, b, similarity``.

    ``class_id`` is the least doc_id of the class. Rows with equal words (case
    and punctuation aside) are always one class; so are all empty and null
    texts, which have no words at all. A null doc_id keeps its row and is matched
    as any other; it is a class's id only if the class has no other. Rows that
    share an id are rows of their own, in the class of their text. ``kept`` marks
    the row of each class that stays (and rows equal to it in id and text).
    """
    rows, contents, links = classify(docs, threshold)
    of = contents.select("content", "class_id", *[F.col(c).alias(f"kept_{c}") for c in ("doc_id", "t1", "t2")], "kept")
    is_it = F.col("doc_id").eqNullSafe(F.col("kept_doc_id")) & (F.col("t1") == F.col("kept_t1")) & (F.col("t2") == F.col("kept_t2"))
    return rows.join(of, "content").select("doc_id", "content", "class_id", (F.col("kept") & is_it).alias("kept")), links


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, class_id, kept`` (see ``near_classes``)."""
    return near_classes(docs, threshold)[0].select("doc_id", "class_id", "kept")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class, unchanged: the one with the least id, or one without an id if the class has no other.

    Rows are told apart by id and text, so unlike texts under one id all stay,
    each for its class. Of rows equal in both, one stays.
    """
    keepers = cut(classify(docs, threshold)[1].where("kept").select("doc_id", "t1", "t2", "copies"))
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"), F.struct(*docs.columns).alias("row"))
    return rows_of(whole, keepers, ["row"]).select("row.*")
