"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import shipped
from . import benchmark_decontam, dom_extraction, ftrl_quality, language_id, license_scan, pareto_mixing, ring_sharding, rule_cascade, simhash_neardup, suffix_tree_lm


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "op1_ftrl_quality": ftrl_quality.op1_ftrl_quality,
        "op2_benchmark_decontam": benchmark_decontam.op2_benchmark_decontam,
        "op3_pareto_mixing": pareto_mixing.op3_pareto_mixing,
        "op4_ring_sharding": ring_sharding.op4_ring_sharding,
        "op5_rule_cascade": rule_cascade.op5_rule_cascade,
        "op6_dom_extraction": dom_extraction.op6_dom_extraction,
        "op7_language_id": language_id.op7_language_id,
        "op8_simhash_neardup": simhash_neardup.op8_simhash_neardup,
        "op9_license_scan": license_scan.op9_license_scan,
        "op10_suffix_tree_lm": suffix_tree_lm.op10_suffix_tree_lm,
    }
    return {name: shipped(f) for name, f in found.items()}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_benchmark_decontam": benchmark_decontam.ORACLE_OP2,
        "op3_pareto_mixing": pareto_mixing.ORACLE_OP3,
        "op5_rule_cascade": rule_cascade.ORACLE_OP5,
        "op9_license_scan": license_scan.ORACLE_OP9,
    }
