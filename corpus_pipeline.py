"""From raw documents to encoded training text: each stage works on what the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paylake.llm import decontaminate, hyperminhash, piece_encoding, pii, toxicity
from paylake.llm.common import read_table, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity machine does not reject; it learns from the stage's input."""
    model = toxicity.learn(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at a similarity of 0.8 or more on five-word shingles."""
    return hyperminhash.one_of_each(docs, width=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, give or take a fifth of its words."""
    return decontaminate.without_passages(docs, read_table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their SentencePiece ids, and whether these decode to the text again."""
    return piece_encoding.with_pieces(docs, piece_encoding.public_model())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("pii", redact_personal_data),
    ("pieces", encode),
]

# Kernel machine, sketches, random walks and merges have no SQL; tests hold each stage
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared scratch folder and read by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
