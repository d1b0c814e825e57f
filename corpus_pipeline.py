"""The corpus pipeline: from raw documents to places in packed training sequences, stage by stage.

Each stage takes what its predecessor kept, written as Parquet and read again. The stages are
quality rules, exact deduplication, near-deduplication, mixing and packing.

In every stage null text counts as empty, very long texts are taken whole, null and repeated ids are
allowed, an empty table gives an empty one, and further columns of the documents are carried along
under whatever names; see the operators for ties and repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxmill.llm import exact, minhash, mixing, packing, rules
from voxmill.llm.common import documents, keeping, stored

#: Sources not named have weight 1: every source comes to the same share of the text.
MIX_WEIGHTS: dict[str, float] = {}


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the quality rules; null and empty texts, which have no words, do not."""
    return keeping(docs, lambda d: rules.quality_rules(d).where("kept"), "text")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal text, the one with the largest id."""
    return exact.deduplicate(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by a similarity of 0.8 or more on shingles of five words, the one with the
    smallest id."""
    return minhash.deduplicate(docs, size=5, percent=80)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as their Poisson draw says, in random order; null sources are one source."""
    return keeping(docs, lambda d: mixing.mix(d, weights=MIX_WEIGHTS), "doc_id", "source", "text")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces of all rows in sequences of at most 2048 tokens."""
    return packing.packed_placements(docs)


STAGES = [
    ("quality rules", good_documents),
    ("exact dedup", without_copies),
    ("MinHash near-dedup", without_near_copies),
    ("mixing sources to target weights", mixed_sources),
    ("best-fit packing", packed),
]

#: Shingle components and token ids are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
