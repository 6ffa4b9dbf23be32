"""One query for each operator, over its whole table, with the parameters it is meant for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.collocations import mine_collocations
from sedimenta.llm.conversation_trie import prefix_trie
from sedimenta.llm.decontaminate import find_leaks, leak_report
from sedimenta.llm.license_scan import scan_licences
from sedimenta.llm.line_quality import judge_lines
from sedimenta.llm.minhash_dedup import near_duplicates
from sedimenta.llm.personal_data import find_personal, personal_report
from sedimenta.llm.scratch import Scratch
from sedimenta.llm.secret_scan import find_secrets
from sedimenta.llm.site_quality import judge_quality
from sedimenta.llm.source_mix import mix_report, mix_sources
from sedimenta.llm.substring_dedup import remove_repeats
from sedimenta.llm.token_counts import count_tokens
from sedimenta.llm.token_files import read_token_files, write_token_files


def tokenizer_path() -> str:
    """The vocabulary file the queries use; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), words=4, percent=80)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"), window=13).drop("kept_text")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "tokens")
    files = write_token_files(_table(spark, sf_dir, "documents"), scratch.path("files"), tokenizer_path(), end_id=2)
    return read_token_files(scratch.keep(files, "manifest"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(_table(spark, sf_dir, "documents"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(mix_sources(_table(spark, sf_dir, "documents")))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"), tokenizer_path())


def op7_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels").select(
        "doc_id", ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good")
    )
    return judge_quality(_table(spark, sf_dir, "documents"), labels)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return leak_report(find_leaks(documents, _table(spark, sf_dir, "benchmark"), window=10))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(_table(spark, sf_dir, "documents")).drop("n_linked")


def op10_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_lines(_table(spark, sf_dir, "documents")).drop("n_lost_words")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_collocations(_table(spark, sf_dir, "documents"), most=4, least=30, top=2000)


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_report(find_personal(_table(spark, sf_dir, "documents")))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(_table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_dedup,
        op2_substring_dedup,
        op3_token_files,
        op4_license_scan,
        op5_source_mix,
        op6_token_counts,
        op7_site_quality,
        op8_decontaminate,
        op9_secret_scan,
        op10_line_quality,
        op11_collocations,
        op12_personal_data,
        op13_conversation_trie,
        pipeline,
    )
}
