"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sessionloom.llm.collocations import collocations
from sessionloom.llm.collocations_sql import collocations_sql
from sessionloom.llm.decontamination import leaks
from sessionloom.llm.fingerprints import edit_report
from sessionloom.llm.lm_scoring import score_documents
from sessionloom.llm.mixing import mix_report
from sessionloom.llm.mixing_sql import mix_sql
from sessionloom.llm.periodic_runs import run_digests
from sessionloom.llm.quality import fit, scored
from sessionloom.llm.secrets import secret_digests
from sessionloom.llm.sharding import shard_documents
from sessionloom.llm.simhash import near_duplicates
from sessionloom.llm.substring_dedup import repeat_digests
from sessionloom.llm.suffix_dedup import repeated_byte_digests
from sessionloom.llm.token_files import TokenFormat, token_digests, write_tokens
from sessionloom.llm.windows_sql import byte_repeats_sql, word_repeats_sql
from sessionloom.session import work_folder


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(documents(spark, sf_dir))


def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(documents(spark, sf_dir), benchmark(spark, sf_dir)).drop("text_key")


def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(documents(spark, sf_dir))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return scored(docs, fit(docs, labels(spark, sf_dir)))


def tokenizer_path() -> str:
    """The public tokenizer the queries encode with."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "tokens")
    write_tokens(documents(spark, sf_dir), path, TokenFormat(tokenizer_path()))
    return token_digests(spark, path)


def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir))


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_report(documents(spark, sf_dir))


def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_byte_digests(documents(spark, sf_dir))


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).drop("text_key")


def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(documents(spark, sf_dir))


def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(documents(spark, sf_dir))


def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": _op1,
        "op2_benchmark_leaks": _op2,
        "op3_mix_sources": _op3,
        "op4_quality_classifier": _op4,
        "op5_token_files": _op5,
        "op6_gru_scores": _op6,
        "op7_balanced_sharding": _op7,
        "op8_fingerprints": _op8,
        "op9_suffix_array_dedup": _op9,
        "op10_simhash_near_dedup": _op10,
        "op11_secret_scan": _op11,
        "op12_periodic_runs": _op12,
        "op13_collocations": _op13,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": word_repeats_sql(),
        "op3_mix_sources": mix_sql(),
        "op9_suffix_array_dedup": byte_repeats_sql(),
        "op13_collocations": collocations_sql(),
    }
