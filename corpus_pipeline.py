"""The corpus pipeline: five stages over documents, each taking what the one before kept.

Every stage is a function (spark, docs, sf_dir) -> DataFrame; all but the last return the columns
of documents, the last adds mix_topic, mix_prob and mix_weight. Rows without a doc_id or text pass
the filtering stages; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadbay.llm import decontaminate, line_dedup, minhash, mixing, toxicity
from loadbay.llm.ship import ship
from loadbay.session import cut

MIX_RATE = 1.0      # before weighting; documents of under-represented cells carry weights above 1


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go."""
    return toxicity.without_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in many documents stay in one; n_chars follows the text."""
    ship(spark)
    return line_dedup.without_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    ship(spark)
    return minhash.one_per_class(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents holding a window of a benchmark item go."""
    return decontaminate.without_leaks(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights of source, language and topic."""
    ship(spark)
    return mixing.mixed(docs, rate=MIX_RATE)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix),
]

# A trained network and a signature index are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
