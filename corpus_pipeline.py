"""A training-data pipeline over documents: language, repeated lines, near duplicates, benchmark leaks, token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; all but the last return the columns of
documents. run() applies them in order, each result written in the shared folder and read again. A stage's result must be
written before the next stage is called: the next one deletes the tables that it was made from. Other columns of the documents
may have any names that don't begin with two underscores; they are kept. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alluvia.llm.decontamination import contaminated
from alluvia.llm.language_id import fit, identify, is_held_out
from alluvia.llm.line_dedup import without_repeats
from alluvia.llm.near_duplicates import one_of_each_class
from alluvia.llm.sentence_pieces import encode_texts
from alluvia.llm.storage import materialise, owned, release, ship_package

LEAST_SCORE = 0.5
ORACLE_SQL = None  # language model, edit join, sampling and token ids have no SQL; the operators' tests compare with brute force


def _stage(f):
    """A stage as (spark, docs, sf_dir): the tables that the stage before made on its way for this folder go first, as its result has been written."""

    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        owner = f"pipeline:{sf_dir}"
        release(spark, owner)
        with owned(owner):
            return f(spark, docs, sf_dir)

    return run_stage


@_stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learnt languages: those without a letter, or with a score under LEAST_SCORE, go; so do all if there are no labelled ones to learn from."""
    model = fit(docs.where(~is_held_out(F.col("doc_id"))))
    told = identify(docs, model, lang_pred="__language_pred", score="__language_score")
    return told.where((F.col("__language_pred") != "und") & (F.col("__language_score") >= LEAST_SCORE)).select(*docs.columns)


@_stage
def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier line of the corpus; n_chars follows; documents that this empties go, other empty ones stay."""
    return without_repeats(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one read first; documents without a text are one class, and so are those with an empty one."""
    return one_of_each_class(docs)


@_stage
def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that matches a benchmark item; a document without a doc_id goes if any such document leaks."""
    found = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(F.col("doc_id").alias("__leaked")).distinct()
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col("__leaked")), "left_anti")


@_stage
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids of every document left, and whether decoding gave the text back; null texts are empty."""
    import public_tokenizers

    coded = encode_texts(docs.withColumn("text", F.coalesce("text", F.lit(""))), public_tokenizers.path("piece_bpe_32k.model"), keep=("doc_id", "lang", "source", "text"))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == F.col("text")).alias("same"))


STAGES = [
    ("language", language),
    ("repeated_lines", repeated_lines),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder of tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name, keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
