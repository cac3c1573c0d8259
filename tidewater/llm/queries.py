"""Registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import collocations, compression, decontaminate, line_dedup, mixing, periodic_runs, quality_rules, simhash, substring_dedup, suffix_dedup, surrogates, token_counts, toxicity
from tidewater.llm.common import small_batches, table
from tidewater.session import configure

Query = Callable[[SparkSession, str], DataFrame]


def _over(op: Callable[..., DataFrame], *names: str) -> Query:
    """The operator applied to the whole tables of these names."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(configure(spark))
        return op(*[table(spark, sf_dir, name) for name in names])

    return run


def queries() -> dict[str, Query]:
    return {
        "op1_pii_surrogates": _over(surrogates.op1_pii_surrogates, "documents"),
        "op2_toxicity": _over(toxicity.op2_toxicity, "documents", "labels"),
        "op3_token_counts": _over(token_counts.op3_token_counts, "documents"),
        "op4_substring_dedup": _over(substring_dedup.op4_substring_dedup, "documents"),
        "op5_compression_quality": _over(compression.op5_compression_quality, "documents", "labels"),
        "op6_line_dedup": _over(line_dedup.op6_line_dedup, "documents"),
        "op7_simhash_near_dedup": _over(simhash.op7_simhash_near_dedup, "documents"),
        "op8_decontaminate": _over(decontaminate.op8_decontaminate, "documents", "benchmark"),
        "op9_quality_rules": _over(quality_rules.op9_quality_rules, "documents"),
        "op10_source_mix": _over(mixing.op10_source_mix, "documents"),
        "op11_collocations": _over(collocations.op11_collocations, "documents"),
        "op12_periodic_runs": _over(periodic_runs.op12_periodic_runs, "documents"),
        "op13_suffix_dedup": _over(suffix_dedup.op13_suffix_dedup, "documents"),
    }
