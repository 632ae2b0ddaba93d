"""The registered queries of this subpackage, and the SQL for those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import oracles
from millrace.llm.chunks import repeated_passages
from millrace.llm.conversations import repair_conversations
from millrace.llm.decontamination import contaminated_passages
from millrace.llm.extraction import main_text
from millrace.llm.interactions import filter_interactions
from millrace.llm.jaccard import similar_groups
from millrace.llm.language import identify_language
from millrace.llm.packing import pack_documents
from millrace.llm.personal import find_personal_data
from millrace.llm.quality import quality_rules
from millrace.llm.secrets import find_secrets
from millrace.llm.sharding import feistel_shards
from millrace.llm.toxicity import score_toxicity
from millrace.sources.files import table

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op3_sharding": oracles.SHARDING,
    "op4_ngram_jaccard_join": oracles.NGRAM_JACCARD,
    "op11_conversation_repair": oracles.CONVERSATION_REPAIR,
    "op13_filter_interactions": oracles.FILTER_INTERACTIONS,
}


def register(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


@register
def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return main_text(table(spark, folder, "pages"))


@register
def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), vocabulary=WORD_VOCABULARY)


@register
def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return feistel_shards(table(spark, folder, "documents"))


@register
def op4_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return similar_groups(table(spark, folder, "documents"))


@register
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(
        table(spark, folder, "documents"), vocabulary=PIECE_VOCABULARY, keep=["doc_id"]
    )


@register
def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return identify_language(table(spark, folder, "documents"), vocabulary=PIECE_VOCABULARY)


@register
def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(table(spark, folder, "documents"))


@register
def op8_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return find_secrets(table(spark, folder, "documents"), keep=["doc_id"])


@register
def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return find_personal_data(table(spark, folder, "documents"), keep=["doc_id"])


@register
def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated_passages(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


@register
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair_conversations(table(spark, folder, "conversations"))


@register
def op12_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(
        table(spark, folder, "documents"), table(spark, folder, "labels"), keep=["doc_id"]
    )


@register
def op13_filter_interactions(spark: SparkSession, folder: str) -> DataFrame:
    return filter_interactions(table(spark, folder, "documents"), table(spark, folder, "labels"))
