"""Documents to training tokens: each stage works on what the one before it has kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sessionloom.llm import quality
from sessionloom.llm.decontamination import leaks, without_leaks
from sessionloom.llm.mixing import mix_documents
from sessionloom.llm.queries import benchmark, documents, labels, tokenizer_path
from sessionloom.llm.simhash import one_of_each
from sessionloom.llm.token_files import TokenFormat, token_digests, write_tokens
from sessionloom.session import work_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. It learns from the given documents' labels."""
    model = quality.fit(docs, labels(spark, sf_dir))
    return quality.accepted(docs, model)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_leaks(docs, leaks(docs, benchmark(spark, sf_dir)))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bring the sources to their target weights."""
    return mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token files and return what they hold, one row per document of the mixture."""
    path = work_folder(spark, "tokens")
    write_tokens(docs, path, TokenFormat(tokenizer_path()))
    return token_digests(spark, path)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", classify),
    ("simhash near-dedup", deduplicate),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix),
    ("token files", encode),
]

#: A learned classifier, fingerprints of byte hashes and a tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each written as Parquet and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = work_folder(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
