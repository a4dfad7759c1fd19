"""The corpus pipeline: documents to packed training sequences.

Each stage takes the documents that its predecessor kept, with all their
columns, and is written to the shared folder before the next one reads them.
The last returns the pieces of the texts with their places in sequences.

In every stage a null text counts as an empty one, rows repeated in the table
are judged one by one, extra columns go through as they are, and an empty
table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tramline.llm.common import stored
from tramline.llm.decontaminate import drop_contaminated
from tramline.llm.minhash import drop_near_duplicates
from tramline.llm.packing import pack
from tramline.llm.pii import redact
from tramline.llm.quality_rules import drop_low_quality
from tramline.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or repeat themselves too much go."""
    return drop_low_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with too large a share of benchmark passages go."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets are replaced by the names of their kinds."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 2048."""
    from public_tokenizers import path
    return pack(docs, path("word_bpe_49k.json"))


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("personal_data", personal_data), ("packing", packing)]

# No SQL: the packing depends on a tokenizer. Tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; an empty table gives no pieces."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
