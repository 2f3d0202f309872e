"""The corpus pipeline: five stages over the documents table, each by one of the training-data operators.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which `run`
writes as Parquet in the shared folder and rereads as the next stage's docs.
All but the last return the columns of documents. Each stage reads all rows
that the one before it has kept; null and empty texts go in the first stage,
as no language can be told.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpstat.llm import decontaminate, jaccard_join, langid, mixing, token_dac
from chirpstat.llm.common import id_remainder, land, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language is told with confidence (operator 2); models are learned from `docs`."""
    rest = id_remainder(F.col("doc_id"), 4)
    model = langid.learn(docs.select("doc_id", "text", "lang").where(rest != 2), rest == 3)
    return docs.where(~langid.verdicts(spark, model)(F.col("text"))["rejected"])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near duplicates, the one of smallest id (operator 9)."""
    return jaccard_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that leak a benchmark item (operator 3)."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents so that the sources get their target weights; none is dropped (operator 7)."""
    return mixing.mix_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token files and read them back, one row per document (operator 1)."""
    import public_tokenizers

    return token_dac.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("token_files", token_files),
]

#: The stages hold learned models, hashed sketches and a tokenizer, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
