"""The operators' queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers

from sparkmart.llm import bpe, decontaminate, exact_dedup, filter_audit, language_id, line_dedup, merkle, near_dedup, secrets, substring_dedup, suffix_dedup, token_counts, toxicity
from sparkmart.llm.common import table

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

QUERIES = {
    "op1_token_counts": lambda spark, sf_dir: token_counts.token_report(table(spark, sf_dir), PIECES),
    "op2_minhash_near_dedup": lambda spark, sf_dir: near_dedup.near_copies_report(table(spark, sf_dir)),
    "op3_decontamination": lambda spark, sf_dir: decontaminate.contamination_report(
        table(spark, sf_dir), table(spark, sf_dir, "benchmark")
    ),
    "op4_language_id": lambda spark, sf_dir: language_id.language_report(table(spark, sf_dir)),
    "op5_suffix_array_dedup": lambda spark, sf_dir: suffix_dedup.repeated_passages(table(spark, sf_dir)),
    "op6_bpe_encoding": lambda spark, sf_dir: bpe.encoding_digests(table(spark, sf_dir), BYTE_BPE),
    "op7_exact_dedup": lambda spark, sf_dir: exact_dedup.exact_dedup(table(spark, sf_dir)),
    "op8_substring_dedup": lambda spark, sf_dir: substring_dedup.substring_report(table(spark, sf_dir)),
    "op9_secret_scan": lambda spark, sf_dir: secrets.secret_report(table(spark, sf_dir)),
    "op10_line_dedup": lambda spark, sf_dir: line_dedup.line_dedup_digests(table(spark, sf_dir)),
    "op11_merkle_manifest": lambda spark, sf_dir: merkle.manifest_report(table(spark, sf_dir)),
    "op12_toxicity": lambda spark, sf_dir: toxicity.toxicity_report(table(spark, sf_dir), table(spark, sf_dir, "labels")),
    "op13_filter_audit": lambda spark, sf_dir: filter_audit.audit_report(table(spark, sf_dir), table(spark, sf_dir, "labels")),
}

SQL = {
    "op2_minhash_near_dedup": near_dedup.SQL,
    "op3_decontamination": decontaminate.SQL,
    "op5_suffix_array_dedup": suffix_dedup.SQL,
    "op7_exact_dedup": exact_dedup.SQL,
    "op8_substring_dedup": substring_dedup.SQL,
    "op10_line_dedup": line_dedup.SQL,
    "op11_merkle_manifest": merkle.SQL,
    "op13_filter_audit": filter_audit.SQL,
}
