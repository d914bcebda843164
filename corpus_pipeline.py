"""Documents to packed training sequences, stage by stage.

Each stage takes all that its predecessor kept and returns the columns of documents;
the last returns the packed pieces. Stages run one after the other, each written to
the shared folder, so a lost executor repeats tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from verdance.llm import mixing, packing, quality, simhash, toxicity
from verdance.llm.common import materialize, ship, table


def toxic_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with toxic passages go."""
    ship(spark)
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of low quality go."""
    ship(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    ship(spark)
    return simhash.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    ship(spark)
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, packed into sequences."""
    ship(spark)
    return packing.packed_sequences(docs)


STAGES = [("toxicity", toxic_stage), ("quality", quality_stage), ("simhash_dedup", dedup_stage), ("mixing", mixing_stage), ("packing", packing_stage)]
#: SQL can't express the models and fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
