"""From raw documents to encoded training text, in five stages.

Each stage takes all that the one before it kept, and what it decides takes effect: the
quality classifier drops what it rejects, exact deduplication keeps one of equal texts,
near-deduplication one document of each group, decontamination drops documents with a
benchmark passage, and the tokenizer encodes the rest. The stages before the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from atlasweave.llm import bpe, decontaminate, exact_dedup, quality, simhash
from atlasweave.llm.catalog import table
from atlasweave.llm.stored import stored
from atlasweave.session import configure


def trusted_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under the trusted model is not beyond their language's threshold."""
    return quality.accepted(docs, table(configure(spark), sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each set of equal texts, the one with the smallest doc_id."""
    configure(spark)
    return exact_dedup.deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of linked fingerprints, the one with the smallest doc_id."""
    configure(spark)
    return simhash.one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of the benchmark occurs."""
    return decontaminate.clean(docs, table(configure(spark), sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document and the text they decode to, as digests."""
    configure(spark)
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality_classifier", trusted_quality),
    ("exact_dedup", exact_duplicates),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

# The model, the fingerprints and the merges are beyond SQL; a brute-force version in the tests stands in.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
