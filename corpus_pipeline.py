"""From raw documents to packed sequences: five stages over whole tables.

Each stage takes what the one before it kept. All but the last return the columns
of documents, with ``n_chars`` brought up to date where a text has changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.decontamination import without_contaminated
from millrace.llm.jaccard import one_of_each_group
from millrace.llm.packing import pack_documents
from millrace.llm.quality import quality_rules
from millrace.llm.queries import PIECE_VOCABULARY, WORD_VOCABULARY
from millrace.llm.secrets import find_secrets, mask_secrets
from millrace.scratch import fresh_path
from millrace.sources.files import table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fertility bands."""
    judged = quality_rules(docs, vocabulary=PIECE_VOCABULARY)
    return judged.where("kept").select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_of_each_group(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with live-looking secrets masked."""
    masked = mask_secrets(find_secrets(docs)).select(*docs.columns)
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return pack_documents(docs, vocabulary=WORD_VOCABULARY)


STAGES = [
    ("quality rules", good_quality),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("packing", packed),
]

#: Neither tokenization nor similarity components over whole tables suit SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents in ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
