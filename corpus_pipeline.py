"""A training corpus from raw documents: five operators in a row, each on what the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import minhash, mixing, quality, secrets, tiling
from rollbook.llm.common import settle, table


def _sized(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs``, with n_chars as the text has it now."""
    return docs.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail a rule go, and documents that are rejected."""
    return _sized(quality.judged(docs, cleaned="text").filter("kept"), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return minhash.near_deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return tiling.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def scan_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return _sized(secrets.redacted(docs, secrets.train(secrets.labelled_tokens(docs))), docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with their words (``size``), the words taken and how often the document is taken."""
    mixed = mixing.mix_rows(docs).filter("taken > 0")
    return mixed.withColumn("repeats", (F.col("taken") / F.col("size")).cast("long"))


STAGES = [
    ("quality rules", quality_rules), ("near-duplicates", near_dedup), ("benchmark decontamination", decontaminate),
    ("secret scan", scan_secrets), ("source mix", mix_sources),
]

#: The classes of near-duplicates and the tiles of passages are not SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
