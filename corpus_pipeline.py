"""Corpus preparation: identify languages, drop near duplicates, mask personal data, pack into sequences.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows that its
predecessor kept, and returns a DataFrame; all but the last return the columns
of ``documents``. ``run`` chains them, each stage's rows written as a table and read
again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradescope.llm.common import cut, read_table
from tradescope.llm.language_id import keep_identified
from tradescope.llm.near_dedup import keep_one
from tradescope.llm.packing import pack_documents
from tradescope.llm.pii import redact


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; null texts and texts without a letter go."""
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one with the least id."""
    return keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in the text replaced by its kind and ``n_chars`` counted anew."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("packing", packing)]

#: Expectation-maximisation, signatures and packing have no SQL form; tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs)
    return docs
