"""The corpus pipeline: language, exact copies, near copies, mix, packing.

Each stage is a function of (spark, docs, sf_dir) that returns a DataFrame,
which is written as Parquet and read again as the next stage's docs. All but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from tessera.llm import exact_dedup, language, mixing, near, packing, queries
from tessera.llm.common import documents, scratch_path


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those of no clear language."""
    return language.accepted(docs, language.fit(language.labelled_sample(docs)))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one of each group of equal texts, that of the largest doc_id: two
    batches go through the index, the later against what the earlier has left."""
    with exact_dedup.DigestIndex.temporary(spark) as index:
        return exact_dedup.kept_documents(docs, index, batches=2)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one of each group of near copies (five-word shingles, Jaccard 0.8 or
    more), that of the least doc_id."""
    return near.one_of_each_group(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences with their ids."""
    return packing.pack(docs, queries.TOKENIZER)


STAGES = [
    ("language ID", language_stage),
    ("exact dedup", exact_stage),
    ("SimHash near-dedup", near_stage),
    ("mixing sources", mix_stage),
    ("packing", pack_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written to the shared folder and read
    again, so that a lost executor costs one stage at most."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name.split()[0].lower()}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The language model, fingerprints and tokens are beyond SQL; tests hold the
#: stages against brute force.
ORACLE_SQL = None
