"""SimHash fingerprints of documents, and block tables that find the close ones.

Only DataFrame functions are used. A text's terms are its distinct lower-case words; a
term's hash votes on 128 signed bits with the weight of the word's length (at most
``HEAVIEST``), since longer words say more. A bit is set where the votes for it
outweigh those against. (Pairs of neighbouring words as terms would flip half as many
bits again for the same change of a text.)

Votes are summed two bits at a time: ``(hash >> i) & 0x1_0000_0001`` holds bit i
in its lower and bit i + 32 in its upper half, so 32 sums serve 64 bits and
a text's terms never leave the task that holds the text.

Search. The 128 bits are cut into ``parts`` and each part into blocks. Of up to ``RADIUS``
flipped bits some part holds at most ``RADIUS // parts``, which leave all but so many of
its blocks untouched: with one table for each part and choice of that many blocks, two
fingerprints within the radius meet under an equal key in at least one table.
Longer keys take more tables; the layout follows the number of fingerprints, so that
unlike ones seldom meet, and finds the same ones in every case.

Near copies are reported as classes, the connected components of "within the radius".
Small buckets of a table are compared pair by pair. Every member of a large one is compared
with one pivot; what stays outside the bucket's largest component
then meets the members of other components, in chunks of bounded size. Within a
component no further link can change a class, so a large group of copies is never
spelled out as pairs.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradescope.llm.common import cut, dealt, documents_of
from tradescope.llm.near_dedup import components

BITS = 128
HEAVIEST = 16
#: Two texts of similarity 0.9 (five-word shingles; 1 word in 100 replaced) differ in 6 to 7 bits on average, 9 in 10 of them in 11 at most.
RADIUS = 11
#: Parts, and blocks of a part, by growing length of the keys.
LAYOUTS = ((4, 4), (4, 5), (4, 6), (3, 7), (3, 8), (2, 9), (2, 10))
#: Values of a key for each fingerprint: at most one unlike fingerprint in so many meets another by chance.
ROOM = 8
#: Buckets up to this size are compared pair by pair.
SMALL_BUCKET = 4
#: Rows of a large bucket, on either side, that are compared at a time (on average: rows are dealt by hash).
CHUNK = 2048
#: Fingerprints of more than 1 / HOT_SHARE of all rows, fewer than HOT_SHARE of them, are joined by broadcast.
HOT_SHARE = 1000
HALVES = 0x100000001
NOT_A_WORD = r"[^\p{L}\p{N}]+"


def with_terms(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys, place, word``: distinct words; a text without words is one word, itself."""
    words = texts.select(*keys, text, F.filter(F.split(F.lower(text), NOT_A_WORD), lambda w: w != "").alias("words"))
    # Each step is a projection of its own, so that no text is split more than once.
    words = words.select(*keys, F.when(F.size("words") > 0, F.array_distinct("words")).otherwise(F.array(text)).alias("words"))
    return words.select(*keys, F.posexplode("words").alias("place", "word"))


def _votes(bits: str, weight: str) -> list[Column]:
    return [F.sum(F.shiftright(F.col(bits), i).bitwiseAND(F.lit(HALVES)) * F.col(weight)).alias(f"{bits}{i}") for i in range(32)]


def _signs(bits: str, weight: str) -> Column:
    """64 bits from 32 sums of two votes each, set where the votes outweigh half of all."""
    sums = F.array(*[F.col(f"{bits}{i}") for i in range(32)])
    return F.aggregate(
        F.transform(
            sums,
            lambda v, i: F.when(v.bitwiseAND(F.lit(0xFFFFFFFF)) * 2 > F.col(weight), F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))
            + F.when(F.shiftrightunsigned(v, 32) * 2 > F.col(weight), F.call_function("shiftleft", F.lit(1).cast("long"), i + 32)).otherwise(F.lit(0).cast("long")),
        ),
        F.lit(0).cast("long"),
        lambda bits_so_far, pair: bits_so_far.bitwiseOR(pair),
    )


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys, copies, high, low`` for each distinct combination of ``keys``, which must determine ``text``."""
    first = F.xxhash64("word")
    weight = F.least(F.char_length("word"), F.lit(HEAVIEST)).cast("long")
    hashed = with_terms(texts, keys, text).select(*keys, "place", weight.alias("weight"), first.alias("h"), F.xxhash64(first, F.lit(1)).alias("l"))
    votes = hashed.groupBy(*keys).agg(
        F.sum("weight").alias("total"),
        F.sum(F.when(F.col("place") == 0, 1).otherwise(0)).alias("copies"),
        *_votes("h", "weight"),
        *_votes("l", "weight"),
    )
    return votes.select(*keys, "copies", _signs("h", "total").alias("high"), _signs("l", "total").alias("low"))


def distance(high_a: Column, low_a: Column, high_b: Column, low_b: Column) -> Column:
    return F.bit_count(high_a.bitwiseXOR(high_b)) + F.bit_count(low_a.bitwiseXOR(low_b))


def as_hex(high: Column, low: Column) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(x), 16, "0") for x in (high, low)]))


def key_bits(parts: int, blocks: int, radius: int = RADIUS) -> float:
    return BITS / parts * (blocks - radius // parts) / blocks


def layout_for(n: int, radius: int = RADIUS) -> tuple[int, int]:
    """The shortest keys with ``ROOM`` times as many values as there are fingerprints (the longest, if none has)."""
    fits = [x for x in LAYOUTS if x[1] > radius // x[0] and key_bits(*x, radius) >= math.log2(max(n, 2) * ROOM)]
    return fits[0] if fits else LAYOUTS[-1]


def block_keys(radius: int, parts: int, blocks: int) -> list[Column]:
    """One key per table: a part of the columns ``high, low`` and a choice of its blocks, with the table's number."""
    flips = radius // parts
    if not 0 <= flips < blocks:
        raise ValueError("a part's share of the radius must be smaller than its number of blocks")
    out = []
    for p in range(parts):
        begin, end = BITS * p // parts, BITS * (p + 1) // parts
        edges = [begin + (end - begin) * k // blocks for k in range(blocks + 1)]
        pieces = []
        for a, b in zip(edges, edges[1:], strict=False):
            found = []
            for name, x, y in (("low", a, min(b, 64)), ("high", max(a, 64) - 64, b - 64)):
                if x < y:
                    found.append(F.shiftrightunsigned(F.col(name), x).bitwiseAND(F.lit((1 << (y - x)) - 1 if y - x < 64 else -1)))
            pieces.append(found)
        for chosen in combinations(range(blocks), blocks - flips):
            out.append(F.xxhash64(F.lit(len(out)), *[x for i in chosen for x in pieces[i]]))
    return out


def _close(radius: int) -> Column:
    return distance(F.col("x.high"), F.col("x.low"), F.col("y.high"), F.col("y.low")) <= radius


def _links(joined: DataFrame) -> DataFrame:
    """``a, b``: the fingerprints of both sides, the lesser first."""
    x, y = (F.struct(F.col(f"{s}.high").alias("high"), F.col(f"{s}.low").alias("low")) for s in "xy")
    return joined.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))


def _on(*columns: str) -> Column:
    return reduce(lambda p, q: p & q, [F.col(f"x.{c}") == F.col(f"y.{c}") for c in columns])


def near_links(prints: DataFrame, radius: int = RADIUS, layout: tuple[int, int] | None = None) -> DataFrame:
    """``node, label``: the class of each of the distinct fingerprints ``high, low`` that has another within the radius."""
    keys = block_keys(radius, *(layout or layout_for(prints.count(), radius)))
    table = prints.select("high", "low", F.explode(F.array(*keys)).alias("key"))
    # A pivot in one table is likely the pivot of its neighbours in the others, so few of their links differ.
    place = F.xxhash64("high", "low")
    sizes = table.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1")
    chunk = F.pmod(F.xxhash64("high", "low"), F.col("chunks")).alias("chunk")
    found = table.join(dealt(sizes), "key").select("key", "high", "low", "n", (place == F.col("first")).alias("pivot"), F.ceil(F.col("n") / CHUNK).cast("long").alias("chunks"))
    found = cut(found.select("*", chunk), free=True)
    small, large = found.where(F.col("n") <= SMALL_BUCKET), found.where(F.col("n") > SMALL_BUCKET)
    ordered = F.struct("x.high", "x.low") < F.struct("y.high", "y.low")
    every = small.alias("x").join(dealt(small.alias("y")), _on("key") & ordered & _close(radius))
    pivots = large.where("pivot").drop("chunk").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    star = large.where("NOT pivot").alias("x").join(dealt(pivots.alias("y")), _on("key", "chunk") & _close(radius))
    links = cut(_links(every).union(_links(star)).distinct(), free=True)
    labels = components(links)
    if not large.limit(1).count():
        return labels
    return components(cut(links.union(left_over(large, labels, radius)), free=True))


def left_over(large: DataFrame, labels: DataFrame, radius: int) -> DataFrame:
    """Links of large buckets between members outside the bucket's largest component and members of other components."""
    node = F.struct("high", "low")
    large = large.withColumn("node", node).join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    per_label = large.groupBy("key", "label").agg(F.count(F.lit(1)).alias("k"), F.max("chunks").alias("chunks"))
    main = per_label.groupBy("key").agg(F.max_by("label", F.struct("k", "label")).alias("main"), (F.sum("k") - F.max("k")).alias("n_outside"), F.max("chunks").alias("chunks"))
    main = main.where("n_outside > 0").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).drop("chunks")
    rows = large.join(dealt(main), ["key", "chunk"]).select(
        "key", "high", "low", "label", "chunk", "chunks", (F.col("label") != F.col("main")).alias("outside"), F.ceil(F.col("n_outside") / CHUNK).cast("long").alias("own_chunks")
    )
    rows = cut(rows, free=True)

    def spread(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    outside = rows.where("outside").withColumn("own_chunk", F.pmod(F.xxhash64("high", "low"), F.col("own_chunks"))).drop("chunk").withColumn("chunk", spread("chunks"))
    members = rows.withColumn("own_chunk", spread("own_chunks"))
    met = outside.alias("x").join(dealt(members.alias("y")), _on("key", "chunk", "own_chunk") & (F.col("x.label") != F.col("y.label")) & _close(radius))
    return _links(met).distinct()


def near_classes(prints: DataFrame, radius: int = RADIUS, layout: tuple[int, int] | None = None) -> DataFrame:
    """``high, low, documents, near_class, near_docs`` of distinct fingerprints ``high, low, documents, least_id``.

    ``near_class`` is the least id of the documents in the fingerprint's class,
    ``near_docs`` how many other documents the class has.
    """
    node = F.struct("high", "low")
    labels = near_links(prints, radius, layout)
    classed = prints.withColumn("node", node).join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = classed.groupBy("label").agg(F.min("least_id").alias("near_class"), (F.sum("documents") - 1).alias("near_docs"))
    return classed.join(least, "label").select("high", "low", "documents", "near_class", "near_docs")


def join_prints(rows: DataFrame, found: DataFrame, total: int) -> DataFrame:
    """``rows`` with their fingerprint's columns of ``found``; the few fingerprints that very many rows share come by broadcast."""
    many = F.broadcast(found.where(F.col("documents") > total / HOT_SHARE))
    few = found.where(F.col("documents") <= total / HOT_SHARE)
    keys = ["high0", "low0"]
    return rows.join(many, keys).unionByName(rows.join(many.select(*keys), keys, "left_anti").join(few, keys))


def followers(ids: DataFrame) -> DataFrame:
    """Adds ``next_id`` to rows with a distinct ``doc_id``: the next smaller id, and the largest after the smallest and after null.

    Ids are dealt into ranges; within a range a window finds the neighbour, and
    between ranges the ranges' largest ids do, one row per range.
    """
    width = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ranged = cut(ids.repartitionByRange(width, "doc_id").withColumn("range", F.spark_partition_id()), free=True)
    tops = ranged.groupBy("range").agg(F.max("doc_id").alias("top"))  # at most ``width`` rows
    below = tops.select("range", F.lag("top").over(Window.orderBy("range")).alias("below"), F.max("top").over(Window.partitionBy()).alias("largest"))
    inside = ranged.withColumn("next_id", F.lag("doc_id").over(Window.partitionBy("range").orderBy("doc_id")))
    return inside.join(below, "range").select(*ids.columns, F.coalesce("next_id", "below", "largest").alias("next_id"))


def edited_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, text, edited, next_id, next_key``: each text with its last third replaced from the next document's start.

    The next document has the next smaller doc_id (after the smallest: the
    largest). Where rows share an id, the next document is the one of them whose
    text hashes lowest. Rows without an id follow the smallest, so the largest is
    next to them; they are next to themselves only where no row has an id.
    ``next_key`` is the hash of the next document's text.
    """
    docs = documents_of(docs)
    third = F.floor(F.char_length("text") / 3).cast("int")
    after = followers(docs.groupBy("doc_id").agg(F.max(third).alias("need")))
    asked = after.select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("for_id"), "need")
    start = docs.alias("d").join(asked.alias("a"), F.col("d.doc_id").eqNullSafe(F.col("a.doc_id"))).drop(F.col("a.doc_id")).select(
        F.col("for_id").alias("doc_id"), F.struct(F.xxhash64("text").alias("key"), F.col("doc_id").alias("id"), F.expr("substring(text, 1, need)").alias("start")).alias("next")
    )
    start = start.groupBy("doc_id").agg(F.min("next").alias("next"))
    n = F.char_length("text")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring(F.col("next.start"), F.lit(1), third))
    both = docs.alias("d").join(start.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id"))).drop(F.col("s.doc_id"))
    return both.select("doc_id", "text", edited.alias("edited"), F.col("next.id").alias("next_id"), F.col("next.key").alias("next_key"))


def compare_edited(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Fingerprints of every whole text and of its edited form (see ``edited_texts``), how alike they are, and close documents.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``, and ``near_class, near_docs``: the least id of its
    class of documents linked within the Hamming radius, and how many others the
    class has. One row per input row. Null texts count as empty; an empty text has the
    fingerprint of no votes, zero.
    """
    rows = edited_texts(docs)
    both = F.array(F.struct(F.lit(0).alias("version"), F.col("text").alias("body")), F.struct(F.lit(1).alias("version"), F.col("edited").alias("body")))
    keyed = rows.select(
        "doc_id",
        F.xxhash64("text").alias("key"),
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "next_id",
        "next_key",
        F.explode(both).alias("v"),
    )
    keys = ["doc_id", "key", "n_chars", "edited_sha256", "next_id", "next_key"]
    prints = fingerprints(keyed.select(*keys, "v.version", "v.body"), [*keys, "version"], "body")
    of = [F.max(F.when(F.col("version") == k, F.col(c))).alias(f"{c}{k}") for k in (0, 1) for c in ("high", "low")]
    rows = cut(prints.groupBy(*keys).agg(F.max("copies").alias("copies"), *of), free=True)
    distinct = rows.groupBy(F.col("high0").alias("high"), F.col("low0").alias("low"))
    distinct = cut(distinct.agg(F.sum("copies").alias("documents"), F.min("doc_id").alias("least_id")), free=True)
    total = distinct.agg(F.coalesce(F.sum("documents"), F.lit(0))).first()[0]
    found = cut(near_classes(distinct, radius), free=True).withColumnsRenamed({"high": "high0", "low": "low0"})
    following = rows.groupBy(F.col("doc_id").alias("id"), F.col("key").alias("text_key")).agg(F.max("high0").alias("high2"), F.max("low0").alias("low2"))
    out = rows.join(following, F.col("next_id").eqNullSafe(F.col("id")) & (F.col("next_key") == F.col("text_key")))
    out = join_prints(out, found, total)

    def alike(k: int) -> Column:
        return 1 - distance(F.col("high0"), F.col("low0"), F.col(f"high{k}"), F.col(f"low{k}")) / F.lit(float(BITS))

    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_hex(F.col("high0"), F.col("low0")).alias("fingerprint"),
        as_hex(F.col("high1"), F.col("low1")).alias("edited_fingerprint"),
        alike(1).alias("near_edited"),
        alike(2).alias("near_next"),
        "near_class",
        "near_docs",
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")
