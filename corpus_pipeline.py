"""Training-corpus pipeline: quality filter, exact dedup, near dedup, masking, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which `run` writes as
Parquet to the shared folder and reads again as the next stage's docs. All stages but the
last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vigil.llm import common, exact, packing, pii, quality, simhash
from vigil.session import materialize


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts (score of at least 0.3).

    It learns from the labelled rows of the `documents` table, whatever `docs` are.
    """
    labelled, labels = (common.table(spark, sf_dir, t) for t in ("documents", "labels"))
    return quality.accepted(docs, quality.train(labelled, labels))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    common.tune(spark)
    return exact.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: 3-word shingles, 3 bits."""
    common.tune(spark)
    return simhash.one_of_each(docs)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    common.tune(spark)
    return pii.mask(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 ids."""
    common.tune(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_filter),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("pii", mask_pii),
    ("packing", pack_windows),
]

#: Neither compression, nor SimHash over words, nor tokenizers are SQL; tests hold the
#: stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on all of `documents`; the last stage's rows."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
