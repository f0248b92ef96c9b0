"""The registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import crc_remainder, given

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


@query
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    from llm.quality import judge_documents

    return judge_documents(given(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_rate")


@query
def op2_context_tree(spark: SparkSession, folder: str) -> DataFrame:
    from llm.ctw import score_texts

    return score_texts(given(spark, folder, "documents"), crc_remainder("doc_id", 7) != 2)


@query
def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Every text encoded and decoded; the digests of ids and decoded text, and whether the text came back."""
    from llm.pieces import encode, lossless

    return lossless(encode(given(spark, folder, "documents"), carry={
        "doc_id": F.col("doc_id"), "given_crc32": F.crc32(F.coalesce("text", F.lit("")).cast("binary"))}))


@query
def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    from llm.pii import find_personal_data

    return find_personal_data(given(spark, folder, "documents"))


@query
def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    from llm.packing import pack_documents

    return pack_documents(given(spark, folder, "documents"))


@query
def op6_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    from llm.licences import scan_licences

    return scan_licences(given(spark, folder, "documents"))


@query
def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from llm.chunks import find_repeats

    return find_repeats(given(spark, folder, "documents"))


@query
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    from llm.langid import fit, identify

    docs = given(spark, folder, "documents")
    learned = crc_remainder("doc_id", 5) != 0
    langs, probability = fit(docs.where(learned))
    return identify(docs, langs, probability, extra={"held_out": ~learned}).select("doc_id", "held_out", "lang_pred", "score")


@query
def op9_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    from llm.topk import top_k

    return top_k(given(spark, folder, "embeddings"), F.coalesce(F.col("vec_id") % 20 == 0, F.lit(False)))


@query
def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    from llm.simhash import near_duplicates

    return near_duplicates(given(spark, folder, "documents"))


@query
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    from llm.manifest import manifest

    return manifest(given(spark, folder, "documents"))


@query
def op12_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    from llm.secrets import scan_secrets

    return scan_secrets(given(spark, folder, "documents"))


@query
def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    from llm.trie import trie

    return trie(given(spark, folder, "conversations"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


TOP_K_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint AS score
  FROM whole q JOIN whole c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::integer AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20"""


def oracle_sql() -> dict[str, str]:
    from llm.manifest import manifest_sql
    from llm.trie import trie_sql

    return {"op11_merkle_manifest": manifest_sql(), "op13_conversation_trie": trie_sql(), "op9_topk_search": TOP_K_SQL}
