"""The corpus pipeline: five stages over `documents`, each over all that its predecessor kept.

All stages but the last return the columns of `documents`; the last adds token ids. SQL cannot
express language identification, so the rows are tested against brute-force versions of the
stages instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm import bpe, decontaminate, language, near, substrings
from slotwise.llm.common import stored
from slotwise.plans.registry import query, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language is found go; `lang` becomes the language found. Learns from
    three of four documents that state their language."""
    return language.with_language(docs, F.crc32(F.col("doc_id").cast("string")) % 4 != 2)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 of its five-word shingles stays."""
    return near.one_of_each(docs, size=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words and more that stand earlier too are cut out of the texts."""
    return substrings.drop_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages are 5 % or more go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the token ids, their number and the digest of what they decode to."""
    coded = bpe.encoded(docs, proof=True)
    return coded.select("row.*", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded_sha256")


STAGES = [
    ("language_id", language_id),
    ("minhash_near_dedup", minhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe),
]
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
