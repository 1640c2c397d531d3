"""From raw documents to encoded training data: five stages, each one operator.

Every stage takes (spark, docs, sf_dir) and reads all that the stage before it kept; the
result is written as Parquet and read again for the next one. All but the last return the
columns of ``documents``. A stage that gives texts to Python stages its result, so that the small
batches of ``Staging.put`` hold whoever evaluates it.

1. ``language``    rows whose language the identifier rejects go
2. ``exact_dedup`` of texts equal but for the case of A-Z, the row with the largest doc_id stays
3. ``near_dedup``  of documents linked at a similarity of 0.8 on five-word shingles, the smallest doc_id stays
4. ``mix``         documents come as often as the source mix takes their words
5. ``encode``      byte-level BPE ids of every document

Defined results for nulls, empty and long texts, ties, repeated rows, empty tables and extra
columns are those of the operators (see their modules). The identifier learns from rows that
this stage is given, in a bounded sample.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sessionloom.llm import bpe, dedup_exact, language, mixing, near_dedup
from sessionloom.llm.common import WORD, whole_text
from sessionloom.llm.queries import BYTE_BPE
from sessionloom.session import Staging


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return Staging(spark, "pipeline-language").put("accepted", language.accepted(docs, language.learned(docs)))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup_exact.dedup(docs, Staging(spark, "pipeline-exact"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.dedup(docs, Staging(spark, "pipeline-near"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    words = F.regexp_count(whole_text(), F.lit(WORD)).cast("long")
    return mixing.mixed(docs, words, Staging(spark, "pipeline-mix"))


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    made = bpe.encode(docs.select("doc_id", "source", "text"), BYTE_BPE, keep=False)
    return Staging(spark, "pipeline-encode").put(
        "encoded", made.select("doc_id", "source", F.expr("octet_length(ids) div 4").alias("n_tokens"), "ids"))


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("encode", encode_documents),
]

#: Language identification and near-duplicate search cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    stage = Staging(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage.put(name, step(spark, docs, sf_dir))
    return docs
