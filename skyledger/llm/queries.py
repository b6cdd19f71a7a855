"""The contract queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.alignment import align
from skyledger.llm.bpe import bpe_decode, bpe_encode
from skyledger.llm.brown import class_scores
from skyledger.llm.common import scratch_path, table
from skyledger.llm.decontaminate import contamination, is_contaminated
from skyledger.llm.filter_audit import filter_interactions, mask_cells
from skyledger.llm.oracles import ORACLES as ORACLES
from skyledger.llm.packing import pack
from skyledger.llm.pii import KINDS as PII_KINDS
from skyledger.llm.pii import pii_spans
from skyledger.llm.quality_model import quality_scores
from skyledger.llm.quality_rules import quality_verdicts
from skyledger.llm.secrets import KINDS as SECRET_KINDS
from skyledger.llm.secrets import secret_spans
from skyledger.llm.simhash import simhash_groups
from skyledger.llm.substring_dedup import dedup_substrings
from skyledger.llm.token_files import read_token_files, write_token_files


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def _spelled(spans) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def _span_digest(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    def of(*wanted: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*wanted))

    return found.select(
        "doc_id",
        *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds),
        F.sha2(_spelled(of(*kinds)), 256).alias("base_sha256"),
        _spelled(F.col("spans")).alias("spans"),
    )


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digest(secret_spans(table(spark, sf_dir, "documents")), SECRET_KINDS)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = dedup_substrings(table(spark, sf_dir, "documents"))
    return result.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digest(pii_spans(table(spark, sf_dir, "documents")), PII_KINDS)


def op7_class_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_scores(table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), path)
    read = read_token_files(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.select("doc_id", "held_out", "score", "predicted")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality_verdicts(table(spark, sf_dir, "documents"))
    return verdicts.select(
        "doc_id",
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
        *("base_failed", "kept"),
    )


def op11_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bpe_decode(bpe_encode(table(spark, sf_dir, "documents")))
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return filter_interactions(mask_cells(docs, labels))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_secret_scan": op2_secret_scan,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_pii": op6_pii,
    "op7_class_bigrams": op7_class_bigrams,
    "op8_token_files": op8_token_files,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_quality_rules": op10_quality_rules,
    "op11_bpe_round_trip": op11_bpe_round_trip,
    "op12_alignment": op12_alignment,
    "op13_filter_audit": op13_filter_audit,
}
