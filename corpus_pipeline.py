"""Corpus pipeline: five operators of ``loadcast.llm`` in a row over documents.

Each stage takes what its predecessor kept, as a table of documents with all its
columns, and its decisions take effect: toxic documents go; one document of each
near-duplicate group stays; passages that an earlier document has are cut out
(and documents of which nothing else is left go); documents that hold a benchmark
item go; what is left is replicated to the target mix of sources and shuffled.

There is no oracle SQL: the trained classifier, MinHash and suffix arrays have no
SQL form. The tests compare the stages with brute-force versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loadcast.llm.common import prepare, stored, table
from loadcast.llm.decontaminate import drop_contaminated
from loadcast.llm.mixing import mix_sources
from loadcast.llm.near_dups import drop_near_duplicates
from loadcast.llm.repeats import remove_repeats
from loadcast.llm.toxicity import drop_toxic

# Near duplicates: five-word shingles, similarity 0.8 or more.
SHINGLE, PERCENT = 5, 80
# Passages repeated across documents are cut out from this many bytes on, which
# is under fifty words; shorter agreements are ordinary language.
MIN_PASSAGE = 200
MIX_POWER = 0.5


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, k=SHINGLE, percent=PERCENT)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_repeats(docs, min_len=MIN_PASSAGE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), percent=PERCENT)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs, power=MIX_POWER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("minhash_dedup", minhash_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet in the
    shared folder and read again as the next stage's input."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs)
    return docs
