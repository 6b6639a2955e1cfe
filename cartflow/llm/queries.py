"""Registered queries of the subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartflow.llm import (
    alignment,
    byte_bpe,
    credentials,
    decontaminate,
    fill_middle,
    identifiers,
    jump_shards,
    merge_automaton,
    quality,
    repeats,
    simhash,
    url_lists,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": warc.op1_warc,
    "op2_url_filters": url_lists.op2_url_filters,
    "op3_byte_bpe": byte_bpe.op3_byte_bpe,
    "op4_sharding": jump_shards.op4_sharding,
    "op5_secret_scan": credentials.op5_secret_scan,
    "op6_decontamination": decontaminate.op6_decontamination,
    "op7_substring_dedup": repeats.op7_substring_dedup,
    "op8_pii": identifiers.op8_pii,
    "op9_simhash": simhash.op9_simhash,
    "op10_quality_rules": quality.op10_quality_rules,
    "op11_merge_automaton": merge_automaton.op11_merge_automaton,
    "op12_alignment": alignment.op12_alignment,
    "op13_fill_middle": fill_middle.op13_fill_middle,
}

ORACLE_SQL: dict[str, str] = {
    "op1_warc": warc.oracle_sql(),
    "op2_url_filters": url_lists.oracle_sql(),
    "op6_decontamination": decontaminate.oracle_sql(),
    "op7_substring_dedup": repeats.oracle_sql(),
    "op10_quality_rules": quality.oracle_sql(),
    "op13_fill_middle": fill_middle.oracle_sql(),
}
