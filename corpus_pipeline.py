"""The corpus pipeline: documents in, the training mix out.

Every stage takes (spark, docs, sf_dir) and works on all documents that the
stage before it kept.  ``run`` writes each stage's result as Parquet to the
shared scratch folder and reads it again for the next.  All stages but the last
return the columns of documents; the last adds copy_no, one row per copy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import decontaminate, line_dedup, mixing, quality_rules, simhash
from tidewater.llm.common import scratch, small_batches, table
from tidewater.session import configure

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality_rules.quality_filter(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines held by an earlier document go; n_chars follows the text."""
    small_batches(configure(spark))
    done = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    small_batches(configure(spark))
    return simhash.drop_near_duplicates(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark items go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents for the target weights of their sources."""
    return mixing.draw_mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_copies),
    ("decontamination", benchmark_passages),
    ("source_mix", source_mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the mix."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


#: SimHash components and the sampling of the mix are not SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None
