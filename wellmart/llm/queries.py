"""Registered queries: one per operator over its whole table, with production settings."""

from __future__ import annotations

from .common import read_table
from .conversations import repair_digest
from .decontam import decontam_digest
from .divergence import divergence_audit
from .langid import language_id
from .licenses import license_digest
from .mixing import mix_digest
from .oracle import ORACLE  # noqa: F401
from .quality import MEASURES, V2, apply_policy, failed, ledger, BASE
from .secrets import secret_digest
from .sharding import shard_digest
from .simhash import near_duplicates
from .substrings import substring_digest
from .suffixes import suffix_digest
from .tokencount import token_counts


def op1_simhash_near_dedup(spark, sf_dir):
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_token_counts(spark, sf_dir):
    return token_counts(read_table(spark, sf_dir, "documents"))


def op3_quality_rules(spark, sf_dir):
    rows = apply_policy(ledger(read_table(spark, sf_dir, "documents").select("doc_id", "text")), V2)
    base = [c for c in MEASURES if c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return rows.select("row.doc_id", *base, failed(BASE).alias("base_failed"), "kept")


def op4_license_scan(spark, sf_dir):
    return license_digest(read_table(spark, sf_dir, "documents"))


def op5_language_id(spark, sf_dir):
    return language_id(read_table(spark, sf_dir, "documents"))


def op6_secret_scan(spark, sf_dir):
    return secret_digest(read_table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark, sf_dir):
    return substring_digest(read_table(spark, sf_dir, "documents"))


def op8_source_mix(spark, sf_dir):
    return mix_digest(read_table(spark, sf_dir, "documents"))


def op9_decontamination(spark, sf_dir):
    return decontam_digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_sharding(spark, sf_dir):
    return shard_digest(read_table(spark, sf_dir, "documents"))


def op11_suffix_array_dedup(spark, sf_dir):
    return suffix_digest(read_table(spark, sf_dir, "documents"))


def op12_source_divergence(spark, sf_dir):
    return divergence_audit(read_table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark, sf_dir):
    return repair_digest(read_table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_simhash_near_dedup, op2_token_counts, op3_quality_rules, op4_license_scan, op5_language_id, op6_secret_scan,
    op7_substring_dedup, op8_source_mix, op9_decontamination, op10_sharding, op11_suffix_array_dedup, op12_source_divergence, op13_conversation_repair)}


