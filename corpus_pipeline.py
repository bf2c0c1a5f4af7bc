"""Training-data pipeline over ``documents``: rules, near duplicates, decontamination, personal data, packing.

Each stage works on what its predecessor kept, returns the columns of
``documents`` (the last one packed pieces), and is written before the next reads it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import quality_rules
from millrace.llm.common import prepare
from millrace.llm.decontaminate import drop_contaminated
from millrace.llm.ngram_join import drop_near_duplicates
from millrace.llm.packing import pack
from millrace.llm.pii import redact
from millrace.llm.queries import table, vocabulary
from millrace.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; measured once, beside their columns, for both steps."""
    measured = stage(quality_rules.measure(_ready(spark, docs)), "measured", "zstd")
    judged = quality_rules.judge(measured, quality_rules.references(measured))
    return judged.filter("rule_kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at 0.8 on 5-word shingles."""
    return drop_near_duplicates(_ready(spark, docs), n=5, num=80, den=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage."""
    return drop_contaminated(_ready(spark, docs), table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked; ``n_chars`` follows the text."""
    masked = redact(_ready(spark, docs))
    return masked.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"]))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    return pack(_ready(spark, docs), vocabulary(), window=4096)


def _ready(spark: SparkSession, docs: DataFrame) -> DataFrame:
    prepare(spark)
    return docs


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", rules),
    ("ngram_jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

# Token ids and hashed scores have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, build in STAGES:
        docs = stage(build(spark, docs, sf_dir), name)
    return docs
