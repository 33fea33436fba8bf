"""The operators as named queries over the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .additive import quality_scores
from .alignment import align_tokenizers
from .common import new_path, running, stored, table
from .decontam import leaks
from .kneser_ney import model_scores
from .line_winnowing import WORDS, drop_repeated_lines
from .mixing import mix_plan
from .ngram_join import ngram_jaccard
from .projection_forest import near_duplicates
from .secret_forest import scan_secrets
from .spelling import spelling_variants
from .suffix_dedup import removal_digest
from .surrogates import replace_entities
from .tokens import token_documents, write_tokens


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    with running(spark):
        write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_file())
        return stored(token_documents(spark, path), "token-documents")


def op2_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(table(spark, sf_dir, "documents"), key="thermoloom")


def op4_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op5_quality_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digest(table(spark, sf_dir, "documents"))


def op8_line_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(table(spark, sf_dir, "documents"), words=WORDS)


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(table(spark, sf_dir, "documents"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard(table(spark, sf_dir, "documents"))


def op11_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_scores(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_token_output, op2_template_decontamination, op3_surrogates, op4_secret_forest, op5_quality_additive, op6_projection_forest, op7_suffix_dedup, op8_line_winnowing, op9_source_mix, op10_ngram_jaccard, op11_kneser_ney, op12_alignment, op13_spelling_variants)}


def oracle_sql() -> dict[str, str]:
    return {}
