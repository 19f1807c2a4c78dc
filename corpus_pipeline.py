"""Training-corpus pipeline over ``documents``.

Five stages, each over all that the one before kept: documents without a language go, of
equal texts and of near copies one stays, documents that hold a benchmark item go, and the
rest is encoded to token ids.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starmart.llm import bpe_prefix, decontaminate, exact_dedup, language_id, simhash_dedup
from starmart.session import stage

TOKENIZER = "byte_bpe_50k.json"
#: Five stages follow one another in the same executors: what they hand to Python at a time is small, since texts are
#: long, and all of it goes to workers of one kind (where tracebacks are cut, Spark keeps others beside them for rows that
#: come from Python lists, as in language_id).
SMALL = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    "spark.sql.execution.pyspark.udf.simplifiedTraceback.enabled": "false",
}

Step = Callable[[SparkSession, DataFrame, str], DataFrame]


def small(step: Step) -> Step:
    """The step with the settings of ``SMALL``, whoever calls it; they stay, since its rows are made later."""

    def run_small(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for key, value in SMALL.items():
            spark.conf.set(key, value)
        return step(spark, docs, sf_dir)

    return run_small


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language can be told and names it where it is missing; texts without a letter go."""
    return language_id.keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal up to white space the document with the smallest id stays."""
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (linked by operator 3, or five-word shingles at least 0.8 similar) the smallest id stays."""
    return simhash_dedup.keep_one(docs, radius=simhash_dedup.RADIUS)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and the token ids of every document."""
    return bpe_prefix.encode_decode(docs, public_tokenizers.path(TOKENIZER), ids=True, remember=False)


STAGES = [(name, small(step)) for name, step in (
    ("language_id", language), ("exact_dedup", exact), ("near_dedup", near), ("decontamination", clean), ("bpe_tokens", tokens),
)]

#: Language machines, fingerprints and tokenizers are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; what each keeps is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
