"""One query per operator over its whole table, and the SQL that checks it where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .bpe import encode_digests
from .conversation_repair import repair_damaged
from .exact_dedup import exact_dedup
from .html_text import extract_text
from .language_model import score_texts
from .licences import oracle as licence_oracle
from .licences import scan_licences
from .minhash import near_duplicates
from .mixing import mix
from .pii import replace_pii
from .prefix_trie import oracle as trie_oracle
from .prefix_trie import rebuilt_trie
from .quality import judge_quality
from .shared import documents
from .token_counts import count_tokens
from .url_filter import filter_urls


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """The place of a public vocabulary file, which every executor has."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_pii(documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(documents(spark, sf_dir))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(documents(spark, sf_dir))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir), vocabulary())


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op7_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(documents(spark, sf_dir), vocabulary())


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(documents(spark, sf_dir))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rebuilt_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES = {f.__name__: f for f in (op1_minhash_near_dedup, op2_pii_surrogates, op3_quality_rules, op4_license_scan, op5_token_counts, op6_url_filter, op7_bpe_encode_decode, op8_lm_scoring, op9_mix_sources, op10_exact_dedup, op11_conversation_repair, op12_prefix_trie, op13_html_extraction)}

ORACLE = {
    "op4_license_scan": licence_oracle(),
    "op12_prefix_trie": trie_oracle(),
    "op10_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
}
