"""From raw documents to packed training sequences: five stages over the corpus operators.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet and read again as the next one's input.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ctspark.llm import compression_classifier, dc3_dedup, jaccard_join, pii_bootstrap, ss_packing
from ctspark.llm.common import Temporary, prepare, release, settle, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the compression classifier rejects (score below 0.5)."""
    prepare(spark)
    model = compression_classifier.train(docs, table(spark, sf_dir, "labels"))
    return compression_classifier.keep(docs, model, 0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more over five-word shingles, the smallest id stays."""
    prepare(spark)
    return jaccard_join.keep_one(docs, width=5, num=80, den=100)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out every string of 200 bytes that also occurs elsewhere."""
    prepare(spark)
    return dc3_dedup.without_repeats(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by the name of its kind in angle brackets."""
    return pii_bootstrap.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a training sequence."""
    prepare(spark)
    return ss_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), remember=False)


STAGES = [
    ("quality_classifier", quality),
    ("jaccard_join", near_duplicates),
    ("suffix_dedup", repeated_strings),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: Not expressible in SQL: the trained classifier, bootstrapping and online packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again.

    What a stage has written besides its result, and the result of the stage before, go once it is there.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = docs
        with Temporary() as tables:
            docs = tables.keep(settle(stage(spark, before, sf_dir), f"stage-{name}"))
        release(before)
    return docs
