"""The registered ``opN_<name>`` queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tradescope.llm.common import read_table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradescope.llm.fingerprints import compare_edited

    return compare_edited(read_table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradescope.llm.pii import report

    return report(read_table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradescope.llm.url_filter import judge_urls

    return judge_urls(read_table(spark, sf_dir, "pages"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradescope.llm.packing import pack_documents

    return pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradescope.llm.topk import top_k, usable

    vectors = usable(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return top_k(vectors.where("vec_id % 100 = 0"), vectors, 10)


def op6_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradescope.llm.chat import rotate

    return rotate(read_table(spark, sf_dir, "conversations"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradescope.llm.secret_scan import report

    return report(read_table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradescope.llm.near_dedup import near_duplicates

    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradescope.llm.sentencepiece_bpe import round_trip

    return round_trip(read_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradescope.llm.language_id import identify

    return identify(read_table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradescope.llm.line_dedup import line_digest

    return line_digest(read_table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradescope.llm.lexical_search import search

    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), 20)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tradescope.llm.token_alignment import alignment_digest

    return alignment_digest(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_pii,
        op3_url_filter,
        op4_best_fit_packing,
        op5_topk,
        op6_chat_rotation,
        op7_secrets,
        op8_near_dedup,
        op9_sentencepiece,
        op10_language_id,
        op11_line_dedup,
        op12_lexical_search,
        op13_token_alignment,
    )
} | {"pipeline": corpus_pipeline.run}

#: DuckDB SQL of the queries that SQL can express on whole tables.
ORACLE_SQL: dict[str, str] = {
    "op5_topk": """
        WITH usable AS (
            SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM usable q JOIN usable c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 100 = 0
        ), ranked AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op6_chat_rotation": """
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '< |') AS body FROM conversations
        ), speakers AS (
            SELECT DISTINCT conv_id, role AS perspective FROM turns WHERE role <> 'system'
        ), seen AS (
            SELECT t.conv_id, s.perspective, t.turn, t.role, t.body,
                '<|im_start|>' || CASE WHEN t.role = s.perspective THEN 'assistant' WHEN t.role = 'system' THEN t.role
                    ELSE 'user name=' || regexp_replace(t.role, '[^A-Za-z0-9_.-]', '_', 'g') END || chr(10) AS header
            FROM turns t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id
        ), sized AS (
            SELECT *, header || body || '<|im_end|>' || chr(10) AS segment FROM seen
        ), placed AS (
            SELECT *, coalesce(sum(length(segment)) OVER (
                PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, role, body ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
            FROM sized
        )
        SELECT conv_id, perspective, turn, role, segment, start, start + length(segment) AS stop,
            CASE WHEN role = perspective THEN start + length(header) END AS train_start,
            CASE WHEN role = perspective THEN start + length(segment) - 1 END AS train_stop
        FROM placed
    """,
    "op11_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, i, line,
                translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM (
                SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS i
                FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
            )
        ), repeated AS (
            SELECT key, max(doc_id) AS top FROM lines WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
        ), judged AS (
            SELECT l.*, r.key IS NOT NULL AND l.doc_id <> r.top AS dropped FROM lines l LEFT JOIN repeated r ON l.key = r.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
        FROM judged GROUP BY doc_id
    """,
    "op12_lexical_search": r"""
        WITH words AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents
        ), asked AS (
            SELECT item_id, term, count(*) AS times FROM (
                SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                FROM benchmark)
            GROUP BY item_id, term
        ), counted AS (
            SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term
        ), sized AS (
            SELECT doc_id, sum(tf)::BIGINT AS n FROM counted GROUP BY doc_id
        ), total AS (
            SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sized
        ), normed AS (
            SELECT doc_id, 100 - 25 + (25 * n * n_docs) // n_terms AS m FROM sized, total
        ), weighed AS (
            SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM counted, total GROUP BY term, n_docs
        ), scored AS (
            SELECT a.item_id, c.doc_id, sum(a.times * w.w * ((1000000000 * c.tf) // (1000 * c.tf + 12 * d.m)))::BIGINT AS score
            FROM asked a JOIN weighed w ON a.term = w.term JOIN counted c ON c.term = a.term JOIN normed d ON d.doc_id = c.doc_id
            GROUP BY a.item_id, c.doc_id
        ), ranked AS (
            SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
    """,
}
