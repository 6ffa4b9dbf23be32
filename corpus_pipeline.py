"""The corpus pipeline: documents to token files, in five stages.

Each stage takes (spark, docs, sf_dir) and gives the documents it keeps; the last one gives one
row for each document of the token files. `run` writes the result of each stage as Parquet and
reads it again for the next, so a lost executor never costs more than a stage.

Nulls, empty texts, repeated rows, empty tables and other columns fare as each operator's module
says: a document without text does not pass the quality rules; rows with the same id are one
document for the near-duplicate stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sedimenta.llm.decontaminate import without_leaks
from sedimenta.llm.line_quality import keep_clean
from sedimenta.llm.minhash_dedup import keep_one_of_each
from sedimenta.llm.queries import tokenizer_path
from sedimenta.llm.scratch import Scratch
from sedimenta.llm.source_mix import take_mix
from sedimenta.llm.token_files import read_token_files, write_token_files


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, then documents that fail the rules or lost too much."""
    return keep_clean(docs)


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles, similarity 0.8 or more, one stays."""
    return keep_one_of_each(docs, words=5, percent=80)


def benchmark_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark go; so do documents that consist of them by more than half."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights; a document can come up to three times."""
    return take_mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files; one row a document as read back from them."""
    scratch = Scratch(spark, "corpus-tokens")
    files = write_token_files(docs, scratch.path("files"), tokenizer_path(), end_id=2)
    return read_token_files(scratch.keep(files, "manifest"))


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicate removal", near_duplicate_removal),
    ("benchmark decontamination", benchmark_removal),
    ("source mixing", source_mixing),
    ("token output", token_output),
]

#: MinHash candidates and the tokenizer cannot be said in SQL; tests hold each stage against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
