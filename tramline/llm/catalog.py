"""The queries of this subpackage: ``opN_<name>`` -> (callable, DuckDB SQL or none).

Each takes its whole tables. A null text counts as an empty one (a null lang
as the empty name), rows repeated in a table count one by one, and an empty
table gives no rows, unless the operator that a query calls says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tramline.llm import oracle
from tramline.sources.tables import read_table


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", "doc_id", "text")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition counts and verdict of every document."""
    from tramline.llm.quality_rules import quality_rules
    return quality_rules(_documents(spark, sf_dir))


def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, noise and draw of every document; all are drawn if no label is known."""
    from tramline.llm.importance import importance_resample
    return importance_resample(_documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op3_license_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licence sentences and the licences of every document."""
    from tramline.llm.licenses import scan_licenses
    return scan_licenses(_documents(spark, sf_dir))


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of near-duplicates of every document; one without words is alone."""
    from tramline.llm.minhash import near_duplicates
    return near_duplicates(_documents(spark, sf_dir))


def op5_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by the model of those not held out; an empty text is its end token."""
    from tramline.llm.lm_ppm import score_texts
    return score_texts(_documents(spark, sf_dir))


def op6_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    from tramline.llm.pii import find_personal_data
    return find_personal_data(_documents(spark, sf_dir))


def op7_shard_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    from tramline.llm.sharding import shard_table
    return shard_table(_documents(spark, sf_dir))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document and their places; an empty text is its end id."""
    from public_tokenizers import path

    from tramline.llm.packing import pack
    return pack(_documents(spark, sf_dir), path("word_bpe_49k.json"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that a smaller doc_id has too."""
    from tramline.llm.suffix_dedup import remove_repeats
    return remove_repeats(_documents(spark, sf_dir))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that test items have; an empty benchmark hits nothing."""
    from tramline.llm.decontaminate import contamination
    return contamination(_documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by their ids and turns, and their cheapest repairs."""
    from tramline.llm.turn_repair import damage, repair
    return repair(damage(read_table(spark, sf_dir, "conversations")))


def op12_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every whole text, as digests; a null text is empty."""
    from public_tokenizers import path

    from tramline.llm.sentencepieces import encode_texts
    return encode_texts(_documents(spark, sf_dir), path("piece_bpe_32k.model"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all 120 orders over all documents, by language; a null text is empty."""
    from tramline.llm.filter_audit import audit_filters
    return audit_filters(read_table(spark, sf_dir, "documents", "doc_id", "text", "lang"),
                         read_table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_quality_rules, op2_importance_resampling, op3_license_sentences, op4_minhash_dedup, op5_ppm_scores, op6_bootstrapped_pii,
        op7_shard_shuffle, op8_best_fit_packing, op9_suffix_array_dedup, op10_decontaminate, op11_turn_repair,
        op12_sentencepieces, op13_filter_audit)}


def oracle_sql() -> dict[str, str]:
    return oracle.SQL
