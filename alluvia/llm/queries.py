"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from alluvia.llm.storage import ship_package

    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from alluvia.llm.licences import known_digests, license_scan

    return license_scan(_table(spark, sf_dir, "documents"), known_digests(spark))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from alluvia.llm.near_duplicates import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from alluvia.llm.secret_scan import secret_scan

    return secret_scan(_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from alluvia.llm.language_id import language_id

    return language_id(_table(spark, sf_dir, "documents"))


def op5_flac_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from alluvia.llm.flac import media_digests

    return media_digests(_table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from alluvia.llm.decontamination import contaminated

    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from alluvia.llm.line_dedup import line_dedup

    return line_dedup(_table(spark, sf_dir, "documents"))


def op8_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from alluvia.llm.sentence_pieces import encoding_digests

    return encoding_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from alluvia.llm.maxent_lm import lm_scores

    return lm_scores(_table(spark, sf_dir, "documents"))


def op10_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from alluvia.llm.html_wrappers import main_texts

    return main_texts(_table(spark, sf_dir, "pages"))


QUERIES = {f.__name__: f for f in (op1_license_scan, op2_near_duplicates, op3_secret_scan, op4_language_id, op5_flac_media, op6_decontamination, op7_line_dedup, op8_sentence_pieces, op9_maxent_scores, op10_html_wrappers)}


def _oracles() -> dict[str, str]:
    from alluvia.llm import decontamination, licences

    return {"op1_license_scan": licences.oracle(), "op6_decontamination": decontamination.oracle()}


ORACLES = _oracles()
