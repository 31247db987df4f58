"""Documents to training tokens: the stages, each on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm.bpe import encode_digests
from loadlens.llm.exact_dedup import drop_copies
from loadlens.llm.minhash import drop_near_copies
from loadlens.llm.mixing import mix_texts
from loadlens.llm.quality import keep_good
from loadlens.llm.queries import vocabulary
from loadlens.llm.shared import documents, stored


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules do not reject."""
    return keep_good(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by four-word shingles of similarity 0.8 or more, the one with the smallest doc_id."""
    return drop_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, a row per document and epoch; n_chars is that of the new text."""
    mixed = mix_texts(docs)
    size = F.length("text").cast(docs.schema["n_chars"].dataType)
    return mixed.select(*[size.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row of the mix: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encode_digests(docs, vocabulary())


STAGES = [
    ("quality rules", good_texts),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("mixing", mixture),
    ("bpe", tokens),
]

#: Near-duplicate search, block draws and token ids are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result stored before the next reads it."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
