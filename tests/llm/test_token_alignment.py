"""Alignment against a plain walk over both tokenizers' ends, corpus counts, and the bound on id pairs."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradescope.llm import token_alignment
from tradescope.llm.token_alignment import TokenizerPair, align, align_texts, alignment_digest, coalesce, most_pairs, pair_counts

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
BOTH = TokenizerPair(*FILES)


def library_tokens(text):
    """[(id, end)] of A and of B, straight from the libraries; nothing where either does not spell out the text."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    global LIBRARY
    if "LIBRARY" not in globals():
        a = Tokenizer.from_file(FILES[0])
        a.encode_special_tokens = True
        LIBRARY = a, sentencepiece.SentencePieceProcessor(model_file=FILES[1]), decoders.ByteLevel()
    a, b, _ = LIBRARY
    found = []
    whole = (" " + (text or "")).encode()
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(x): x for x in printable} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in printable)}
    for ids, data in (
        (a.encode(" " + (text or ""), add_special_tokens=False).ids, lambda i: bytes(table[ch] for ch in a.id_to_token(i))),
        (b.encode(text or ""), lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()),
    ):
        rows, at, said = [], 0, b""
        for i in ids:
            said += data(i)
            rows.append((i, len(said)))
        found.append(rows if said == whole else None)
    return ([], []) if not text or None in found else found


def plain(text):
    """Written form and links of one text, by walking both lists of ends."""
    a, b = library_tokens(text)
    cuts = sorted({e for _, e in a} & {e for _, e in b})
    groups, last = [], 0
    for c in cuts:
        groups.append("|".join(",".join(str(i) for i, e in rows if last < e <= c) for rows in (a, b)))
        last = c
    links = [(i, j) for i, e in a for j, f in b if e == f] if len(a) < 300 else [(dict((e, i) for i, e in a)[c], dict((e, i) for i, e in b)[c]) for c in cuts]
    return len(a), len(b), ";".join(groups), links


TEXTS = [
    None,
    "",
    " ",
    "Hello world, hello tokens.",
    "two  blanks   three\n\nlines\t\ttabs",
    "naïve café déjà vu Straße",
    "漢字かな交じり文 العربية 😀😀 ‍",
    "with ▁ inside",
    "<|endoftext|> and <s> </s> <unk> <0x41>",
    "\x00\x01 control \x7f",
    "a" * 400,
    "the same row",
    "the same row",
    "word " * 2000,
]


def expected(rows):
    found = [(i, *plain(t)) for i, t in rows]
    count = Counter(p for *_, links in found for p in links)
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for i, a, b, groups, links in found:
        sha = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        n_groups = groups.count(";") + 1 if groups else 0
        out.append((i, a, b, n_groups, len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), sha))
    return sorted(out, key=str)


def digests(df):
    names = "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_against_a_plain_walk(spark):
    rows = [*enumerate(TEXTS), (None, "no id"), (3, "repeated id"), (3, "repeated id")]
    df = frame(spark, rows).withColumn("pairs", F.lit("x")).withColumn("groups", F.lit(1)).withColumn("n_a", F.lit(-1))
    assert digests(alignment_digest(df, *FILES)) == expected(rows)


def test_empty_tables_and_tables_without_tokens(spark):
    assert alignment_digest(frame(spark, []), *FILES).collect() == []
    rows = [(1, None), (2, ""), (3, "▁")]
    assert digests(alignment_digest(frame(spark, rows), *FILES)) == [(k, 0, 0, 0, 0, 0, 0, "") for k in (1, 2, 3)]


def test_written_groups_and_pairs(spark):
    (row,) = align(frame(spark, [(1, "Hello  world")]), *FILES).collect()
    _, _, groups, links = plain("Hello  world")
    assert row.groups == groups
    assert dict(zip(row.pairs, row.times, strict=True)) == {(a << 32) | b: n for (a, b), n in Counter(links).items()}


ALPHABET = st.one_of(st.sampled_from("aabcdethe  'sST \t\n\r.,-_09Éüß漢한😀́▁<>|"), st.characters(exclude_categories=("Cs",)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=5))
def test_random_texts(texts):
    got = align_texts(BOTH, texts)
    for k, t in enumerate(texts):
        a, b, groups, links = plain(t)
        assert (got.n_a[k], got.n_b[k], got.groups[k], got.n_links[k]) == (a, b, groups, len(links))
        assert got.n_groups[k] == (groups.count(";") + 1 if groups else 0)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=30), st.lists(st.integers(1, 5), min_size=1, max_size=30))
def test_coalesced_intervals(a, b):
    """Groups are the connected parts of overlapping ranges, also where the two lists do not end together."""
    ends = np.r_[np.cumsum(a), np.cumsum(b)]
    starts = ends - np.r_[a, b]
    group, group_ends = coalesce(starts, ends, np.repeat([0, 1], [len(a), len(b)]))
    covered = sorted({x for s, e in zip(starts.tolist(), ends.tolist(), strict=True) for x in range(s, e)})
    # A boundary between two bytes that no range spans starts a new group.
    spanned = {x for s, e in zip(starts.tolist(), ends.tolist(), strict=True) for x in range(s + 1, e)}
    number, part = {}, -1
    for x in covered:
        part += x not in spanned
        number[x] = part
    assert group.tolist() == [number[s] for s in starts.tolist()]
    assert group_ends.tolist() == [max(e for e, g in zip(ends.tolist(), group.tolist(), strict=True) if g == k) for k in range(part + 1)]


def test_pairs_are_bounded_by_the_vocabularies(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for pair, _ in pair_counts(align(docs, *FILES)).collect():
        a, b = BOTH.bytes_a[pair >> 32], BOTH.bytes_b[pair & 0xFFFFFFFF]
        assert a.endswith(b) or b.endswith(a)
    assert most_pairs(BOTH) < 1_000_000


def test_small_chunks_of_texts(spark, monkeypatch):
    rows = list(enumerate(TEXTS))
    got = [align_texts(BOTH, [t or "" for t in TEXTS[x:y]]) for x, y in ((0, 1), (1, 5), (5, len(TEXTS)))]
    whole = align_texts(BOTH, [t or "" for t in TEXTS])
    assert [g for part in got for g in part.groups] == whole.groups
    assert np.concatenate([part.pairs for part in got]).tolist() == whole.pairs.tolist()
    assert len(rows) == len(whole.n_a)
    assert token_alignment.CHARS_AT_ONCE > 0
