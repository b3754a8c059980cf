"""Contract columns against plain Python, the votes against a plain sum, and the block tables against all pairs."""

import hashlib
import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tradescope.llm import fingerprints as P
from tradescope.llm.common import cut

SF = "/root/testdata/sf0.001"


def plain_edited(rows):
    """(doc_id, n_chars, edited_sha256) in plain Python; ids distinct."""
    rows = sorted(((i, t or "") for i, t in rows), reverse=True)
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        third = len(t) // 3
        out.append((i, len(t), hashlib.sha256((t[: len(t) - third] + after[:third]).encode()).hexdigest()))
    return sorted(out)


def distance(a, b):
    return (int(a, 16) ^ int(b, 16)).bit_count()


def test_query_against_plain_python(spark):
    from tradescope.llm.queries import QUERIES

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = QUERIES["op1_simhash"](spark, SF).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in out) == plain_edited(docs.items())
    prints = {r.doc_id: r.fingerprint for r in out}
    order = sorted(docs, reverse=True)
    following = dict(zip(order, [*order[1:], order[0]], strict=True))
    for r in out:
        assert len(r.fingerprint) == len(r.edited_fingerprint) == 32
        assert r.near_edited == 1 - distance(r.fingerprint, r.edited_fingerprint) / 128
        assert r.near_next == 1 - distance(r.fingerprint, prints[following[r.doc_id]]) / 128
    groups = plain_classes({int(f, 16) for f in prints.values()}, P.RADIUS)
    members = {}
    for i, f in prints.items():
        members.setdefault(groups[int(f, 16)], []).append(i)
    assert all((r.near_class, r.near_docs + 1) == (min(m), len(m)) for r in out for m in [members[groups[int(r.fingerprint, 16)]]])
    by_text = {}
    for i, t in docs.items():
        assert by_text.setdefault(t, prints[i]) == prints[i]
    apart = [r for r in out if docs[r.doc_id] != docs[following[r.doc_id]] and len(docs[r.doc_id].split()) > 40]
    assert sum(r.near_edited > r.near_next for r in apart) >= 0.97 * len(apart)


def test_votes_as_a_plain_sum(spark):
    text = "The the cat; sat on the mat, extraordinarily"
    words = "the cat sat on mat extraordinarily".split()
    frame = spark.createDataFrame([(w,) for w in words], "word string").select(F.xxhash64("word").alias("h"), F.length("word").alias("n"))
    rows = frame.withColumn("l", F.xxhash64("h", F.lit(1))).collect()
    total = sum(min(r.n, 16) for r in rows)

    def half(name):
        return sum(1 << b for b in range(64) if 2 * sum(min(r.n, 16) * ((r[name] >> b) & 1) for r in rows) > total)

    got = P.fingerprints(spark.createDataFrame([(1, text)], "k int, text string"), ["k"]).select(P.as_hex(F.col("high"), F.col("low")).alias("x")).first().x
    assert got == f"{half('h'):016x}{half('l'):016x}"


def plain_classes(values, radius):
    """value -> least value that a path of pairs within the radius reaches, over all pairs."""
    values, up = sorted(values), {}
    for v in values:
        up[v] = v

    def top(v):
        while up[v] != v:
            v = up[v]
        return v

    for a, b in itertools.combinations(values, 2):
        if (a ^ b).bit_count() <= radius:
            x, y = sorted((top(a), top(b)))
            up[y] = x
    return {v: top(v) for v in values}


def signed(x):
    return x - (1 << 64) * (x >> 63)


@pytest.mark.parametrize("radius, layout, small, chunk", [(11, (4, 4), 24, 2048), (11, (4, 5), 2, 5), (11, (3, 7), 24, 2048), (3, (1, 5), 2, 3), (5, (2, 6), 3, 2048)])
def test_tables_find_all_within_radius(spark, monkeypatch, radius, layout, small, chunk):
    """Scattered groups, a dense one, and a chain; large buckets with pivots, left-over members and chunks."""
    monkeypatch.setattr(P, "SMALL_BUCKET", small)
    monkeypatch.setattr(P, "CHUNK", chunk)
    rnd = random.Random(radius + layout[1])
    flip = lambda v, n: v ^ sum(1 << b for b in rnd.sample(range(128), n))
    values = set()
    for _ in range(25):
        values.add(base := rnd.getrandbits(128))
        values |= {flip(base, rnd.randint(1, radius + 3)) for _ in range(5)}
    base = rnd.getrandbits(128)
    values |= {flip(base, rnd.randint(0, radius)) for _ in range(90)}
    link = base
    for _ in range(15):
        values.add(link := flip(link, radius))
    ids = {v: k + 100 for k, v in enumerate(sorted(values, key=lambda v: v * 7919 % 10007))}
    count = {v: rnd.randint(1, 4) for v in values}
    df = spark.createDataFrame([(signed(v >> 64), signed(v & (2**64 - 1)), count[v], ids[v]) for v in values], "high long, low long, documents long, least_id long")
    got = {(r.high % 2**64) << 64 | (r.low % 2**64): (r.near_class, r.near_docs) for r in P.near_classes(df, radius, layout).collect()}
    groups = plain_classes(values, radius)
    want = {}
    for v in values:
        same = [w for w in values if groups[w] == groups[v]]
        want[v] = (min(ids[w] for w in same), sum(count[w] for w in same) - 1)
    assert got == want


def broadcast_sides(plan):
    """The build sides of a physical plan's broadcast joins."""
    children = [plan.children().apply(k) for k in range(plan.children().size())]
    found = [x for c in children for x in broadcast_sides(c)]
    if plan.nodeName().startswith("Broadcast") and len(children) == 2:
        found.append(children[plan.buildSide().toString() == "BuildRight"].toString())
    return found


def test_exploded_tables_and_members_are_never_broadcast(spark, monkeypatch):
    """Spark takes 3 000 fingerprints for small, and so their rows in all tables; the bucket's members come in chunks."""
    monkeypatch.setattr(P, "SMALL_BUCKET", 2)
    monkeypatch.setattr(P, "CHUNK", 5)
    monkeypatch.setattr(P, "cut", lambda df, keep=P.cut, **k: plans.append(df._jdf.queryExecution().sparkPlan()) or keep(df, **k))
    plans = []
    one_bucket = spark.range(40).select(F.xxhash64("id").alias("high"), F.lit(1).cast("long").alias("low"))
    others = spark.range(3000).select(F.xxhash64(F.col("id") + 40).alias("high"), F.xxhash64("id", F.lit(1)).alias("low"))
    P.near_links(cut(one_bucket.union(others)), 3, (2, 2)).count()
    assert len(plans) == 4  # members of shared buckets, their links, large buckets' rows, all links
    assert sum("Generate" in p.toString() for p in plans) == 4
    sides = [side for p in plans for side in broadcast_sides(p)]
    assert not [side for side in sides if "Generate" in side]
    assert not broadcast_sides(plans[1])


def test_layouts_follow_the_number_of_fingerprints():
    assert P.layout_for(0) == P.layout_for(1000) == (4, 4)
    lengths = [P.key_bits(*P.layout_for(10**k)) for k in range(1, 10)]
    assert lengths == sorted(lengths) and P.layout_for(10**30) == P.LAYOUTS[-1]
    assert all(lengths[k - 1] >= 3.32 * k for k in range(1, 9))


def test_recall_of_planted_near_copies(spark):
    """Copies of similarity 0.9 (five-word shingles) and closer: at least nine in ten share a class with their original."""
    from test_near_dedup import plain_shingles, plain_similarity

    rnd = random.Random(12)
    rows, pairs = [], []
    for k in range(120):
        words = [f"w{rnd.randint(0, 3000)}" for _ in range(rnd.choice([200, 400, 1000]))]
        copy = list(words)
        for i in rnd.sample(range(len(words)), len(words) // 100):
            copy[i] = f"x{rnd.randint(0, 10**6)}"
        similarity = plain_similarity(plain_shingles(" ".join(words)), plain_shingles(" ".join(copy)))
        assert similarity > 0.88
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(copy))]
        pairs.append((2 * k, 2 * k + 1))
    of = {r.doc_id: r.near_class for r in P.compare_edited(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(of[a] == of[b] for a, b in pairs) >= 0.9 * len(pairs)
    assert all(of[a] in (a, b) and of[b] in (a, b) for a, b in pairs)  # unlike texts stay apart


def test_edge_cases(spark):
    rows = [(5, None), (4, ""), (3, "?!"), (2, "word"), (9, "é漢😀 " * 5000), (-7, "a b c d e f g")]
    df = spark.createDataFrame([(i, t, "x", 2) for i, t in rows], "doc_id long, text string, next_id string, key int")
    out = P.compare_edited(df).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in out) == plain_edited(rows)
    prints = {r.doc_id: r.fingerprint for r in out}
    assert prints[5] == prints[4] == "0" * 32 != prints[3]


def test_repeated_and_missing_ids(spark):
    rows = [(1, "one two three four"), (1, "one two three four"), (2, "alpha beta gamma delta"), (2, "other text under this id"), (None, "no id"), (3, "last of them all")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = P.compare_edited(df).collect()
    assert Counter(r.doc_id for r in out) == {1: 2, 2: 2, 3: 1, None: 1}
    (nameless,) = [r for r in out if r.doc_id is None]
    assert nameless.edited_sha256 == hashlib.sha256(b"no il").hexdigest()  # the largest id's text follows
    assert nameless.near_class is None and nameless.near_docs == 0
    assert len({r.edited_sha256 for r in out if r.doc_id == 1}) == 1


def test_one_row_and_no_rows(spark):
    df = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    (r,) = P.compare_edited(df).collect()
    assert r.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and r.near_next == 1.0 and r.near_docs == 0
    assert P.compare_edited(df.limit(0)).count() == 0


def test_only_native_operators(spark):
    plan = P.compare_edited(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
