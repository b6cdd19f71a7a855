"""From raw documents to packed sequences: one stage after another, each a written table.

Every stage takes (spark, docs, sf_dir) and works on all rows of the stage before it. All but the
last return the rows they keep with the columns of documents; the last returns the place of every
piece of every document that is left. Empty tables pass through as they are; columns that a stage
does not know are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyledger.llm.common import table, written
from skyledger.llm.decontaminate import decontaminate
from skyledger.llm.packing import pack
from skyledger.llm.quality_rules import drop_low_quality
from skyledger.llm.secrets import redact_secrets
from skyledger.llm.simhash import one_per_group


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or their host's rates reject go.

    Null and empty texts have no words and go. Rows without source are judged by their own rules,
    rows without id like any other, and equal rows alike.
    """
    return drop_low_quality(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays.

    Rows that share this id stay together; rows without id stay where no row of the group has one.
    """
    return one_per_group(docs, shingle=3, distance=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; the others lose the words that test items share.

    Texts without words are clean, and null texts stay null. Each row is judged for itself.
    """
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; no document goes, and null and empty texts stay as they are."""
    return redact_secrets(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece in sequences of 4096 tokens.

    A null or empty text has its end token only; each row is packed, repeated ones too.
    """
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: SQL has no XXH64, trained network or tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
