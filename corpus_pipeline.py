"""From documents to token files: language, near copies, benchmark passages,
source mixture, token ids. Each stage's rows are written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorlake.llm.common import Scratch, table
from sensorlake.llm.decontaminate import clean_documents
from sensorlake.llm.language import keep_identified
from sensorlake.llm.mixing import mixed_documents
from sensorlake.llm.simhash import keep_one
from sensorlake.llm.tokenfile import token_documents


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter (null and empty ones too) and those whose
    language is in doubt. Repeated rows go or stay together; without any label
    in ``lang`` all rows stay."""
    return keep_identified(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of SimHash near copies: its smallest
    doc_id (null last), of equal ids that with the smaller text hash, of equal
    rows one. Null and wordless texts share a fingerprint, so they are a group."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that overlap a benchmark item."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and drops documents until sources have their target weights."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes token files and returns each document's place in them."""
    return token_documents(docs)


STAGES = [("language", language), ("near_copies", near_copies), ("decontaminate", decontaminate), ("mixture", mixture), ("tokens", tokens)]

#: The language model, the fingerprints and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from the documents table."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.stage(stage(spark, docs, sf_dir), name)
    return docs
