"""The pipeline against a plain version of its stages, and odd rows through every stage."""

import random
from collections import Counter

import corpus_pipeline
from test_near_dedup import brute_classes
from test_packing import check as check_packing

from tradescope.llm import language_id
from tradescope.llm.pii import find_spans, mask


def plain_run(rows):
    """Texts that reach packing: those with a letter, one of each class by all pairs, masked."""
    kept = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    classes = dict(brute_classes(kept))
    return {i: mask(t, find_spans(t)) for i, t in kept if classes[i] == i}


def test_run_against_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = plain_run(docs)
    out = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in out} == set(want)
    check_packing(out, want.values())


def test_stages_keep_columns_and_odd_rows(spark):
    rnd = random.Random(1)
    rows = [(k, " ".join(rnd.choice(["the", "cat", "sat", "on", "a", "mat", "dog"]) for _ in range(30)), "en", "s", 1) for k in range(12)]
    rows += [(20, None, "en", "s", 0), (21, "", None, None, 0), (22, "12 34", "en", "s", 5), (None, "no id at all here", None, "s", None), (23, "mail a@b.co now", "en", None, 15), (24, "mail a@b.co now", "en", None, 15), (25, "x " * 50_000, "en", "s", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        for table in (docs, docs.limit(0)):
            out = stage(spark, table, "")
            if k + 1 < len(corpus_pipeline.STAGES):
                assert out.columns == columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType, name
            got = out.collect()
            assert bool(got) == (table is docs)
    kept = corpus_pipeline.language(spark, docs, "")
    assert Counter(r.doc_id for r in kept.collect()) == Counter([*range(12), None, 23, 24, 25])
    once = corpus_pipeline.near_duplicates(spark, kept, "")
    assert {r.doc_id for r in once.collect()} == {*range(12), None, 23, 25}
    masked = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.personal_data(spark, once, "").collect()}
    assert masked[23] == ("mail [EMAIL] now", 16) and masked[None] == ("no id at all here", 17)


def test_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert corpus_pipeline.language(spark, docs, sf).count() == docs.where("text RLIKE '[A-Za-zÀ-ÿ]'").count()
    assert language_id.UNKNOWN == "und"
