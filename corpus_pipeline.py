"""From raw documents to token files, in five stages.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; its result is written as Parquet and read again. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from thermoloom.llm.additive import keep_quality
from thermoloom.llm.common import new_path, running, stored, table
from thermoloom.llm.decontam import drop_leaks
from thermoloom.llm.mixing import mix
from thermoloom.llm.ngram_join import one_of_each
from thermoloom.llm.queries import tokenizer_file
from thermoloom.llm.tokens import token_documents, write_tokens


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (operator 5) accepts."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (operator 10), and one of
    repeated rows."""
    return one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (operator 2)."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the schedule of the mix (operator 9) takes them."""
    return mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files (operator 1) of the documents, and what they say of each."""
    path = new_path(spark, "tokens")
    with running(spark):
        write_tokens(docs, path, tokenizer_file())
        return stored(token_documents(spark, path), "token-documents")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", one_of_each_group),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("tokens", tokens),
]

#: SQL has no twin of the classifier's boosting or of the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
