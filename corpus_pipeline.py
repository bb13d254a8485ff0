"""A corpus pipeline: each stage is written as Parquet and reread as the next one's documents.

Language identification, near-duplicates, benchmark passages, personal data, token ids. All stages but the last keep
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortrail.llm import bpe, decontaminate, language, pii, simhash
from cohortrail.llm.common import ship, table, without
from cohortrail.operators.skew import materialize


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of the labelled ones; texts without letters or likeness to any go."""
    del sf_dir
    ship(spark)
    return language.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints link: three-word shingles, at most two differing bits."""
    del sf_dir
    ship(spark)
    return simhash.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data."""
    del spark, sf_dir
    kinds = dict(docs.dtypes)
    counted = f"CAST(coalesce(char_length(text), n_chars) AS {kinds.get('n_chars')}) AS n_chars"
    return pii.replace(docs).selectExpr(*[counted if c == "n_chars" else f"`{c}`" for c in docs.columns])


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, their number, and whether they decode to the text."""
    del sf_dir
    ship(spark)
    coded = bpe.decode(bpe.encode(without(docs, "n_tokens", "round_trip")))
    return coded.selectExpr(
        *[f"`{c}`" for c in coded.columns if c not in ("ids", "decoded")],
        "CAST(octet_length(ids) / 4 AS bigint) AS n_tokens",
        "ids",
        "decoded <=> CAST(coalesce(text, '') AS binary) AS round_trip",
    )


STAGES = [
    ("languages", languages),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
